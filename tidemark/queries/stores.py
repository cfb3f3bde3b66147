"""Readers and writers: each query writes whole tables and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.functions.dates import month_of
from tidemark.operators import profile, quality
from tidemark.plans import monitoring
from tidemark.queries import standins as st
from tidemark.queries.alerting import ALERTS, MONITOR_SUMMARIES, RECOMMENDATIONS
from tidemark.queries.base import present, query, table
from tidemark.queries.jobs import monitoring_run
from tidemark.queries.preparation import _IMPORTANCE_SQL, importance_table
from tidemark.queries.sqltext import d, r
from tidemark.session import shared_dir
from tidemark.sources import readers, writers


def _orders_by_month(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", month_of(F.col("o_orderdate")).alias("snapshot_date"))


@query("roundtrip_snapshots", f"""
SELECT {d("date_trunc('month', o_orderdate)")} AS snapshot_date, count(*) AS n_rows,
       {r("sum(CASE WHEN date_trunc('month', o_orderdate) = DATE '1996-03-01' THEN 0 ELSE o_totalprice END)", 1)} AS total
FROM orders GROUP BY 1""")
def roundtrip_snapshots(spark, sf):
    """Write all months, write one month again with other values, read the store back."""
    orders = _orders_by_month(spark, sf)
    root = writers.write_snapshots(orders, shared_dir(spark, "orders"))
    again = readers.snapshot(orders, "snapshot_date", "1996-03-01").withColumn("o_totalprice", F.lit(0.0))
    writers.write_snapshots(again, root)
    return present(readers.read_store(spark, root).groupBy("snapshot_date").agg(
        F.count("*").alias("n_rows"), F.sum("o_totalprice").alias("total")), digits=1)


@query("partition_scan", f"""
SELECT o_orderkey, {r('o_totalprice', 2)} AS o_totalprice FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1997-05-01'""")
def partition_scan(spark, sf):
    """One snapshot of a partitioned store: only its folder is read."""
    root = writers.write_snapshots(_orders_by_month(spark, sf), shared_dir(spark, "orders"))
    one = readers.snapshot(readers.read_store(spark, root, False), "snapshot_date", "1997-05-01")
    return present(one.select("o_orderkey", "o_totalprice"), digits=2)


@query("csv_snapshots", f"""
SELECT {d("date_trunc('month', o_orderdate)")} AS snapshot_date, count(*) AS n_rows, {r('sum(o_totalprice)', 1)} AS total FROM orders GROUP BY 1""")
def csv_snapshots(spark, sf):
    """Text round trip: CSV with a header, read as text, typed leniently."""
    root = writers.write_snapshots(_orders_by_month(spark, sf), shared_dir(spark, "orders-csv"), fmt="csv")
    text = readers.read_csv_text(spark, root)
    return present(text.groupBy(F.col("snapshot_date").try_cast("date").alias("snapshot_date")).agg(
        F.count("*").alias("n_rows"), F.sum(F.col("o_totalprice").try_cast("double")).alias("total")), digits=1)


_TARGET = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_totalprice", DoubleType()), StructField("o_shippriority", IntegerType()),
    StructField("o_orderpriority", StringType()), StructField("snapshot_date", DateType()),
])


def _drifting_store(spark, sf) -> list[str]:
    """Orders in three folders whose column types and columns differ."""
    orders = table(spark, sf, "orders").withColumn("snapshot_date", F.col("o_orderdate").cast("date"))
    year = F.year("snapshot_date")
    early = orders.where(year < 1997).select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_custkey").cast("int").alias("o_custkey"),
        "o_totalprice", "snapshot_date")
    middle = orders.where((year >= 1997) & (year < 1999)).select(
        "snapshot_date", "o_orderkey", F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("o_custkey"),
        "o_totalprice", F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0")).alias("o_shippriority"), "o_orderpriority")
    late = orders.where(year >= 1999).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "snapshot_date")
    root = shared_dir(spark, "drifting")
    paths = []
    for name, part in (("a", early), ("b", middle), ("c", late)):
        part.write.parquet(f"{root}/{name}")
        paths.append(f"{root}/{name}")
    return paths


@query("reconcile_partitions", f"""
SELECT year(o_orderdate) AS year, count(*) AS n, count(CASE WHEN year(o_orderdate) BETWEEN 1997 AND 1998 THEN NULL ELSE o_custkey END) AS n_custkey_typed,
       CAST(sum(CAST(o_orderkey AS HUGEINT)) AS BIGINT) AS keys, {r('sum(o_totalprice)', 1)} AS total,
       CAST(count(CASE WHEN year(o_orderdate) BETWEEN 1997 AND 1998 THEN 1 END) AS BIGINT) AS n_shippriority,
       count(CASE WHEN year(o_orderdate) >= 1997 THEN o_orderpriority END) AS n_priority
FROM orders GROUP BY 1""")
def reconcile_partitions(spark, sf):
    store = readers.read_reconciled(spark, _drifting_store(spark, sf), _TARGET)
    return present(store.groupBy(F.year("snapshot_date").alias("year")).agg(
        F.count("*").alias("n"), F.count("o_custkey").alias("n_custkey_typed"), F.sum("o_orderkey").alias("keys"),
        F.sum("o_totalprice").alias("total"), F.count("o_shippriority").alias("n_shippriority"),
        F.count("o_orderpriority").alias("n_priority")), digits=1)


_FOUND = {
    "a": {"o_orderkey": "int", "o_custkey": "int", "o_totalprice": "double", "snapshot_date": "date"},
    "b": {"snapshot_date": "date", "o_orderkey": "bigint", "o_custkey": "string", "o_totalprice": "double",
          "o_shippriority": "string", "o_orderpriority": "string"},
    "c": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderpriority": "string",
          "snapshot_date": "date"},
}


def _conformance_sql() -> str:
    rows = []
    for partition, types in _FOUND.items():
        for field in _TARGET.fields:
            want, have = field.dataType.simpleString(), types.get(field.name)
            shown = f"'{have}'" if have else "NULL"
            rows.append(f"('{partition}', '{field.name}', {shown}, '{want}', {str(have == want).lower()})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) t(partition, column_name, found_type, expected_type, ok)"


@query("schema_conformance", _conformance_sql())
def schema_conformance(spark, sf):
    """Found and expected types come from file footers, not from rows."""
    found = readers.partition_schemas(spark, _drifting_store(spark, sf))
    named = {path.rsplit("/", 1)[-1]: schema for path, schema in found.items()}
    return profile.schema_conformance(named, _TARGET, spark)


@query("prediction_store", f"""
WITH {st.SCORES}
SELECT {d('inference_date')} AS inference_date, risk_category, count(*) AS n, CAST(sum(predicted_default) AS BIGINT) AS n_predicted,
       {r('avg(CAST(CAST(default_probability AS FLOAT) AS DOUBLE))')} AS avg_probability
FROM scores GROUP BY ALL""")
def prediction_store(spark, sf):
    root = writers.write_predictions(st.scores(spark, sf), shared_dir(spark, "prediction_store"))
    return present(readers.read_store(spark, root).groupBy("inference_date", "risk_category").agg(
        F.count("*").alias("n"), F.sum("predicted_default").alias("n_predicted"),
        F.avg(F.col("default_probability").cast("double")).alias("avg_probability")))


@query("prediction_csv", f"""
WITH {st.SCORES}
SELECT {d('inference_date')} AS inference_date, count(*) AS n, {r('avg(default_probability)')} AS avg_probability, count(risk_category) AS n_banded
FROM scores GROUP BY 1""")
def prediction_csv(spark, sf):
    path = writers.write_predictions_csv(st.scores(spark, sf), shared_dir(spark, "predictions-csv"))
    return present(readers.read_predictions_csv(spark, path).groupBy("inference_date").agg(
        F.count("*").alias("n"), F.avg("default_probability").alias("avg_probability"),
        F.count("risk_category").alias("n_banded")))


@query("latest_run", f"""
SELECT event_type, count(*) AS n, {r('avg(value)')} AS avg_value, 'run_2' AS run_ts FROM events GROUP BY 1""")
def latest_run(spark, sf):
    """Two runs appended to one store; the newest is picked."""
    stats = table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.avg("value").alias("avg_value"))
    root = shared_dir(spark, "runs")
    writers.write_run_result(stats.withColumn("n", F.lit(0).cast("long")), root, "run_1")
    writers.write_run_result(stats, root, "run_2")
    return present(quality.latest_run(readers.read_store(spark, root)))


@query("importance_roundtrip", f"""
WITH {_IMPORTANCE_SQL} SELECT feature, {r('importance')} AS importance FROM ranked""")
def importance_roundtrip(spark, sf):
    path = writers.write_table_csv(importance_table(spark, sf), shared_dir(spark, "importance"))
    return present(readers.read_importance_csv(spark, path))


_RATES = ("actual_default_rate", "predicted_default_rate", "false_negative_rate", "false_positive_rate")
_METRICS = ("auc", "accuracy", "precision", "recall", "f1_score")
#: Every leaf of the document: its path, and the same in SQL.
_LEAVES = [
    *[(f"psi_summary.{c}", r(c)) for c in ("avg_psi", "max_psi", "min_psi")],
    *[(f"psi_summary.{c}", f"CAST({c} AS VARCHAR)") for c in ("n_stable", "n_moderate", "n_significant")],
    *[(f"psi_summary.{c}", d(c)) for c in ("max_psi_date", "min_psi_date")],
    ("performance_summary.evaluation_available", "CAST(evaluation_available AS VARCHAR)"),
    ("performance_summary.evaluation_period.start", d("period_start")), ("performance_summary.evaluation_period.end", d("period_end")),
    ("performance_summary.total_samples_evaluated", "CAST(total_samples_evaluated AS VARCHAR)"),
    *[(f"performance_summary.avg_metrics.{m}", r(f"avg_{m}")) for m in _METRICS],
    *[(f"performance_summary.metric_ranges.{m}", r(m)) for m in ("auc_min", "auc_max")],
    *[(f"performance_summary.business_metrics.avg_{m}", r(f"avg_{m}")) for m in _RATES],
    ("performance_summary.training_comparison.training_test_auc", r("training_test_auc")),
    ("performance_summary.training_comparison.production_avg_auc", r("avg_auc")),
    ("performance_summary.training_comparison.auc_difference", r("auc_difference")),
    ("performance_summary.training_comparison.performance_status", "performance_status"),
    ("feature_drift_summary.n_features_monitored", "CAST(n_features_monitored AS VARCHAR)"),
    ("feature_drift_summary.avg_feature_psi", r("avg_feature_psi")),
    ("feature_drift_summary.n_features_high_drift", "CAST(n_features_high_drift AS VARCHAR)"),
    *[(f"data_quality_summary.{c}", r(c)) for c in ("avg_missing_rate_pct", "max_missing_rate_pct", "avg_rows_per_month")],
    ("data_quality_summary.max_missing_rate_date", d("max_missing_rate_date")),
    ("data_quality_summary.total_duplicates", "CAST(total_duplicates AS VARCHAR)"),
]


def _six(sql: str) -> str:
    return f"CAST(CAST({r(sql)} AS DECIMAL(20, 6)) AS VARCHAR)"


def _leaf_sql(sql: str) -> str:
    return f"CAST(CAST({sql} AS DECIMAL(20, 6)) AS VARCHAR)" if sql.startswith("(round(") else sql


@query("summary_document", f"""
WITH {MONITOR_SUMMARIES},{ALERTS},{RECOMMENDATIONS},
whole AS (SELECT * FROM psi_summary, performance, drift_summary, quality_summary)
{" UNION ALL ".join(f"SELECT '{path}' AS leaf, {_leaf_sql(sql)} AS value FROM whole" for path, sql in _LEAVES)}
UNION ALL SELECT 'recommendations', string_agg(recommendation, ' | ' ORDER BY o) FROM advice
UNION ALL SELECT 'alert ' || category, severity || ' | ' || message || ' | ' || recommendation FROM alerts
UNION ALL SELECT 'alert metrics ' || category,
  CASE WHEN category = 'population_drift' AND severity = 'critical' THEN 'max_psi=' || {_six('max_psi')} || ',avg_psi=' || {_six('avg_psi')}
       WHEN category = 'performance_degradation' THEN 'auc_drop=' || {_six('auc_difference')}
       WHEN category = 'feature_drift' THEN 'features=' || features_high_drift ELSE '' END FROM alerts, whole
UNION ALL SELECT 'feature_drift_summary.features_high_drift', features_high_drift FROM whole
UNION ALL SELECT 'feature_drift_summary.top_drifting_features', string_agg(feature || '=' || {_six('avg_psi')}, ',' ORDER BY feature)
FROM (SELECT feature, avg(psi) AS avg_psi FROM drift GROUP BY feature ORDER BY avg_psi DESC, feature LIMIT 5)""")
def summary_document(spark, sf):
    """The stored JSON summary of a monitoring run, read back leaf by leaf."""
    result = monitoring_run(spark, sf)
    root = monitoring.store(result, spark, shared_dir(spark, "monitoring_store"), "2024-02-01T00:00:00")
    back = readers.read_summary_documents(spark, f"{root}/monitoring_summary/*", monitoring.summary_document(result, spark, "").schema)
    leaves = []
    for path, sql in _LEAVES:
        c = F.col(path)
        shown = c.cast("decimal(20,6)").cast("string") if sql.startswith("(round(") else F.substring(c.cast("string"), 1, 10) if sql.startswith("strftime") else c.cast("string")
        leaves.append(F.struct(F.lit(path).alias("leaf"), shown.alias("value")))
    leaves.append(F.struct(F.lit("recommendations").alias("leaf"), F.array_join("recommendations", " | ").alias("value")))
    raised = F.transform("alerts", lambda a: F.struct(
        F.concat(F.lit("alert "), a["category"]).alias("leaf"), F.concat_ws(" | ", a["severity"], a["message"], a["recommendation"]).alias("value")))
    six = lambda c: F.round(c, 6).cast("decimal(20,6)").cast("string")

    def shown(m):
        parts = [F.concat(F.lit(f"{k}="), six(m[k])) for k in ("max_psi", "avg_psi", "auc_drop")]
        return F.array_join(F.array_compact(F.array(*parts, F.concat(F.lit("features="), F.array_join(m["features"], ",")))), ",")

    metrics = F.transform("alerts", lambda a: F.struct(
        F.concat(F.lit("alert metrics "), a["category"]).alias("leaf"), F.coalesce(shown(a["metrics"]), F.lit("")).alias("value")))
    drift = back["feature_drift_summary"]
    leaves.append(F.struct(F.lit("feature_drift_summary.features_high_drift").alias("leaf"), F.array_join(drift["features_high_drift"], ",").alias("value")))
    top = F.transform(F.array_sort(F.map_entries(drift["top_drifting_features"])), lambda e: F.concat(e["key"], F.lit("="), six(e["value"])))
    leaves.append(F.struct(F.lit("feature_drift_summary.top_drifting_features").alias("leaf"), F.array_join(top, ",").alias("value")))
    return back.select(F.explode(F.concat(F.array(*leaves), raised, metrics)).alias("x")).select("x.leaf", "x.value")
