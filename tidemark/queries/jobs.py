"""Whole jobs: bronze, silver, gold and monitoring on the stand-in tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tidemark.functions.bands import band_right_closed
from tidemark.operators import features, model
from tidemark.plans import acceptance, monitoring, period_state, rules, tables
from tidemark.queries import standins as st
from tidemark.queries.alerting import MONITOR_SQL, TRAINING_AUC
from tidemark.queries.base import present, query, table
from tidemark.queries.cleaning import LABEL_SELECT, LOAN_SELECT
from tidemark.queries.sqltext import d, r
from tidemark.session import shared_dir
from tidemark.sources import readers, writers


def _floats(columns, digits=4):
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns)


def _nullable_ints(columns):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


@query("job_bronze", f"""
WITH {st.RAW_ATTRIBUTES}
SELECT {d('snapshot_date')} AS snapshot_date, count(*) AS n_rows, count(Age) AS n_age, count(Occupation) AS n_occupation,
       count(*) FILTER (WHERE SSN LIKE '#%') AS n_junk_ssn
FROM raw_attributes WHERE snapshot_date BETWEEN DATE '2023-03-01' AND DATE '2024-06-01' GROUP BY 1""")
def job_bronze(spark, sf):
    """Raw CSV to the partitioned bronze table for sixteen requested dates."""
    source = shared_dir(spark, "source")
    st.raw_attributes(spark, sf).write.option("header", True).csv(source)
    root = tables.ingest(spark, "attributes", source, shared_dir(spark, "bronze"),
                         [f"{2023 + m // 12}-{m % 12 + 1:02d}-01" for m in range(2, 18)])
    return present(readers.read_store(spark, root).groupBy("snapshot_date").agg(
        F.count("*").alias("n_rows"), F.count("Age").alias("n_age"), F.count("Occupation").alias("n_occupation"),
        F.count_if(F.col("SSN").startswith("#")).alias("n_junk_ssn")))


@query("job_silver_attributes", f"""
WITH {st.ATTRIBUTES}
SELECT Customer_ID, Name, CAST(Age AS DOUBLE) AS Age, SSN, Occupation, {d('snapshot_date')} AS snapshot_date, SSN_is_valid, SSN_clean, age_group, occupation_category
FROM attributes""")
def job_silver_attributes(spark, sf):
    return present(tables.clean_attributes(st.raw_attributes(spark, sf)), as_double=["Age"])


@query("job_silver_clickstream", f"""
WITH {st.CLICKSTREAM}
SELECT {_nullable_ints(rules.CLICK_FEATURES)}, Customer_ID, {d('snapshot_date')} AS snapshot_date,
       {_nullable_ints(['total_activity', 'activity_intensity'])}, active_features_count
FROM clickstream""")
def job_silver_clickstream(spark, sf):
    return present(tables.clean_clickstream(st.raw_clickstream(spark, sf)),
                   as_double=[*rules.CLICK_FEATURES, "total_activity", "activity_intensity"])


_FIN_FLOATS = [c for c, t in rules.FINANCIAL_TYPES.items() if t == "float"] + ["Debt_to_income_ratio"]
_FIN_INTS = [c for c, t in rules.FINANCIAL_TYPES.items() if t == "int"] + ["Credit_history_total_months"]


@query("job_silver_financials", f"""
WITH {st.FINANCIALS}
SELECT Customer_ID, Type_of_Loan, Credit_Mix, Credit_History_Age, Payment_of_Min_Amount, Payment_Behaviour, {d('snapshot_date')} AS snapshot_date,
       credit_risk_level, {_floats(_FIN_FLOATS)}, {_nullable_ints(_FIN_INTS)}
FROM financials""")
def job_silver_financials(spark, sf):
    return present(tables.clean_financials(st.raw_financials(spark, sf)), digits=4, as_double=_FIN_INTS)


@query("job_silver_loans", f"WITH {st.LOANS}{LOAN_SELECT}")
def job_silver_loans(spark, sf):
    return present(tables.clean_loans(st.raw_loans(spark, sf)), digits=4, as_double=["dpd"])


_GOLD_FLOATS = [c for c in _FIN_FLOATS if c not in rules.FEATURE_STORE_DROPPED]
_GOLD_INTS = [*_FIN_INTS, "Age", "visit_frequency", "recent_total_activity", "total_active_features"]


@query("job_gold_features", f"""
WITH {st.ATTRIBUTES},{st.FINANCIALS},{st.CLICKSTREAM},
activity AS (
  SELECT Customer_ID, snapshot_date, count(*) AS visit_frequency, max(snapshot_date) AS last_activity_date, sum(total_activity) AS recent_total_activity,
         avg(activity_intensity) AS avg_activity_intensity, sum(active_features_count) AS total_active_features FROM clickstream GROUP BY 1, 2),
months AS (SELECT DISTINCT snapshot_date FROM clickstream),
gold AS (
  SELECT a.Customer_ID, a.snapshot_date, a.Age, a.occupation_category, f.* EXCLUDE (Customer_ID, snapshot_date),
         CASE WHEN m.snapshot_date IS NOT NULL THEN coalesce(c.visit_frequency, 0) END AS visit_frequency, c.last_activity_date,
         CASE WHEN m.snapshot_date IS NOT NULL THEN coalesce(c.recent_total_activity, 0) END AS recent_total_activity,
         CASE WHEN m.snapshot_date IS NOT NULL THEN coalesce(c.avg_activity_intensity, 0) END AS avg_activity_intensity,
         CASE WHEN m.snapshot_date IS NOT NULL THEN coalesce(c.total_active_features, 0) END AS total_active_features,
         CASE WHEN f.Debt_to_income_ratio < 3e-1 THEN 3 WHEN f.Debt_to_income_ratio < 5e-1 THEN 2 ELSE 1 END
           + CASE WHEN f.Credit_Utilization_Ratio < 30 THEN 2 WHEN f.Credit_Utilization_Ratio < 70 THEN 1 ELSE 0 END AS financial_health_score
  FROM attributes a LEFT JOIN financials f ON f.Customer_ID = a.Customer_ID AND f.snapshot_date = a.snapshot_date
  LEFT JOIN months m ON m.snapshot_date = CAST(a.snapshot_date - INTERVAL 1 MONTH AS DATE)
  LEFT JOIN activity c ON c.Customer_ID = a.Customer_ID AND c.snapshot_date = CAST(a.snapshot_date - INTERVAL 1 MONTH AS DATE))
SELECT Customer_ID, {d('snapshot_date')} AS snapshot_date, occupation_category, Type_of_Loan, Credit_Mix, Payment_of_Min_Amount, Payment_Behaviour,
       {_floats(_GOLD_FLOATS)}, {_nullable_ints(_GOLD_INTS)}, {d('last_activity_date')} AS last_activity_date,
       {r('avg_activity_intensity', 4)} AS avg_activity_intensity, financial_health_score
FROM gold""")
def job_gold_features(spark, sf):
    clicks = tables.clean_clickstream(st.raw_clickstream(spark, sf))
    store = tables.feature_store(
        tables.clean_attributes(st.raw_attributes(spark, sf)),
        tables.clean_financials(st.raw_financials(spark, sf)),
        clicks, clicks.select("snapshot_date"),
    )
    return present(store, digits=4, as_double=_GOLD_INTS)


@query("job_gold_labels", f"WITH {st.LOANS}{LABEL_SELECT}")
def job_gold_labels(spark, sf):
    return present(tables.label_store(tables.clean_loans(st.raw_loans(spark, sf))))


@query("job_tables", f"""
WITH {st.LOANS},{st.ATTRIBUTES}
SELECT 'feature_store' AS store, {d('snapshot_date')} AS snapshot_date, count(*) AS n_rows FROM attributes GROUP BY ALL
UNION ALL SELECT 'label_store', {d("date_trunc('month', snapshot_date)")}, count(*) FROM loans WHERE mob = 6 GROUP BY ALL""")
def job_tables(spark, sf):
    """Raw files through bronze and silver to both gold stores, all dates at once."""
    sources = {
        "attributes": st.raw_attributes, "clickstream": st.raw_clickstream,
        "financials": st.raw_financials, "lms": partial(st.raw_loans, monthly=True),
    }
    bronze, silver, gold = (shared_dir(spark, x) for x in ("bronze", "silver", "gold"))
    for name, make in sources.items():
        source = shared_dir(spark, f"source-{name}")
        make(spark, sf).write.option("header", True).option("compression", "gzip").csv(source)
        tables.ingest(spark, name, source, bronze)
        tables.refine(spark, name, bronze, silver)
    roots = tables.build_gold(spark, silver, gold, tables.ingested(spark, bronze, "clickstream"))
    parts = [
        readers.read_store(spark, root).groupBy("snapshot_date").agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("store"), "snapshot_date", "n_rows")
        for name, root in roots.items()
    ]
    return present(parts[0].unionByName(parts[1]))


def _month_sql(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


@query("ingest_empty_snapshot", f"""
WITH orders_of AS (SELECT o_custkey, count(*) AS n FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1996-03-01' GROUP BY 1)
SELECT 'C' || c_custkey AS Customer_ID, '1996-04-01' AS snapshot_date, CAST(coalesce(n, 0) AS BIGINT) AS visit_frequency FROM customer LEFT JOIN orders_of ON o_custkey = c_custkey
UNION ALL SELECT 'C' || c_custkey, '1996-05-01', 0 FROM customer
UNION ALL SELECT 'C' || c_custkey, '1996-06-01', NULL FROM customer""")
def ingest_empty_snapshot(spark, sf):
    """The source has clicks of every month but April; March and April are ingested, May never was."""
    customer = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    month = F.trunc("o_orderdate", "month")
    clicks = table(spark, sf, "orders").where(month != F.lit("1996-04-01").cast("date")).select(
        *[F.lit("1").alias(c) for c in rules.CLICK_FEATURES], customer.alias("Customer_ID"), month.cast("string").alias("snapshot_date"))
    source, bronze, silver = (shared_dir(spark, x) for x in ("source", "bronze", "silver"))
    clicks.select(*rules.RAW_LAYOUTS["clickstream"]).write.option("header", True).csv(source)
    tables.ingest(spark, "clickstream", source, bronze, ["1996-03-01", "1996-04-01"])
    tables.refine(spark, "clickstream", bronze, silver)
    store = readers.read_store(spark, f"{silver}/clickstream", schema=tables.silver_schema(spark, "clickstream"))
    months = F.explode(F.array(*[F.lit(m).cast("date") for m in ("1996-04-01", "1996-05-01", "1996-06-01")]))
    spine = table(spark, sf, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("Customer_ID"), months.alias("snapshot_date"))
    joined = features.lagged_join(
        spine, features.activity_rollup(store), tables.ingested(spark, bronze, "clickstream"), ["visit_frequency"], ["visit_frequency"])
    return present(joined.select("Customer_ID", "snapshot_date", "visit_frequency"))


@query("rewrite_to_empty", f"""
SELECT {d(_month_sql('o_orderdate'))} AS snapshot_date, count(*) AS n_rows FROM orders
WHERE date_trunc('month', o_orderdate) NOT IN (DATE '1996-03-01', DATE '1997-05-01') GROUP BY 1""")
def rewrite_to_empty(spark, sf):
    """Two months are written again: one without rows, one that is then withdrawn."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("snapshot_date"))
    root = writers.write_snapshots(rows, shared_dir(spark, "rewrite"))
    for day in ("1996-03-01", "1997-05-01"):
        writers.write_snapshots(rows.where("false"), root, days=[day])
    return present(readers.read_store(spark, root).groupBy("snapshot_date").agg(F.count("*").alias("n_rows")))


def _acceptance_sql() -> str:
    parts = [
        f"""SELECT 'null_rate' AS check, '{c}' AS column_name, {r(f'count(*) FILTER (WHERE {c} IS NULL) * 100e0 / count(*)')} AS measure,
       CASE WHEN count(*) FILTER (WHERE {c} IS NULL) * 100e0 / count(*) < {low} THEN 'PASS'
            WHEN count(*) FILTER (WHERE {c} IS NULL) * 100e0 / count(*) >= {high} THEN 'FAIL' ELSE 'PARTIAL' END AS status FROM financials"""
        for c, (low, high) in rules.ACCEPTED_NULLS.items()]
    for check, bounds in (("bounds", rules.ACCEPTED_BOUNDS), ("sanity", rules.SANITY_BOUNDS)):
        parts += [
            f"""SELECT '{check}', '{c}', {r(f'count(*) FILTER (WHERE {c} < {low} OR {c} > {high})')},
       CASE WHEN count({c}) = 0 THEN 'ALL NULL' WHEN count(*) FILTER (WHERE {c} < {low} OR {c} > {high}) = 0 THEN 'PASS' ELSE 'FAIL' END FROM financials"""
            for c, (low, high) in bounds.items()]
    return " UNION ALL ".join(parts)


@query("job_acceptance", f"WITH {st.FINANCIALS} {_acceptance_sql()}")
def job_acceptance(spark, sf):
    """The acceptance rules over the cleaned financials."""
    return present(acceptance.accept(tables.clean_financials(st.raw_financials(spark, sf))))


def monitoring_run(spark, sf):
    store = st.line_store(spark, sf, scaled=True)
    return monitoring.monitor(
        st.predictions(spark, sf), st.outcomes(spark, sf), store, st.STORE_FEATURES, training_auc=TRAINING_AUC)


def _monitored(spark, result):
    document = monitoring.summary_document(result, spark, "2024-02-01T00:00:00")
    return present(document.select(
        "psi_summary.avg_psi", "psi_summary.n_significant",
        F.col("performance_summary.avg_metrics.auc").alias("avg_auc"), "performance_summary.total_samples_evaluated",
        "performance_summary.training_comparison.performance_status",
        "feature_drift_summary.n_features_monitored", "feature_drift_summary.avg_feature_psi",
        "data_quality_summary.max_missing_rate_pct", "data_quality_summary.total_duplicates",
        F.size("alerts").alias("n_alerts"),
        result.decision.select("should_retrain").scalar().alias("should_retrain"),
    ))


@query("job_monitor", MONITOR_SQL)
def job_monitor(spark, sf):
    return _monitored(spark, monitoring_run(spark, sf))


def _partitioned(spark, sf) -> dict[str, str]:
    """Predictions, outcomes and features as stores partitioned by their date."""
    frames = {
        "predictions": (st.predictions(spark, sf), "inference_date"),
        "outcomes": (st.outcomes(spark, sf), "label_date"),
        "features": (st.line_store(spark, sf, scaled=True), "snapshot_date"),
    }
    return {name: writers.write_snapshots(df, shared_dir(spark, name), date=date) for name, (df, date) in frames.items()}


#: Periods and labels up to here make the first state; the rest arrives later.
_FIRST_STATE = "1997-06-30"


@query("job_monitor_incremental", MONITOR_SQL)
def job_monitor_incremental(spark, sf):
    """Two updates of the stored state, later labels changing earlier periods, give what the full run gives."""
    roots = _partitioned(spark, sf)
    predictions, outcomes, store = (readers.read_store(spark, roots[n], False) for n in ("predictions", "outcomes", "features"))
    calendar = lambda df, c: df.select(F.col(c).alias("d")).distinct()
    dates = calendar(predictions, "inference_date").unionByName(calendar(store, "snapshot_date")).distinct()
    days = sorted(r["d"].isoformat() for r in dates.collect())
    label_days = sorted(r["d"].isoformat() for r in calendar(outcomes, "label_date").collect())
    state = shared_dir(spark, "state")
    early = outcomes.where(F.col("label_date") <= F.lit(_FIRST_STATE).cast("date"))
    period_state.update(spark, state, predictions, early, store, st.STORE_FEATURES, [x for x in days if x <= _FIRST_STATE])
    period_state.update(
        spark, state, predictions, outcomes, store, st.STORE_FEATURES,
        [x for x in days if x > _FIRST_STATE], [x for x in label_days if x > _FIRST_STATE])
    return _monitored(spark, period_state.result(spark, state, TRAINING_AUC))


#: The prediction store holds probabilities as 32-bit floats.
_STORED_SQL = MONITOR_SQL.replace(
    "(o_totalprice % 1000) / 1000 AS default_probability", "CAST(CAST((o_totalprice % 1000) / 1000 AS FLOAT) AS DOUBLE) AS default_probability")


@query("job_monitor_stores", _STORED_SQL)
def job_monitor_stores(spark, sf):
    """A run from paths alone: stores, importance table and model metadata are read, results written."""
    banded = st.predictions(spark, sf).withColumn(
        "risk_category", band_right_closed(F.col("default_probability"), rules.RISK_EDGES, rules.RISK_NAMES))
    importance = spark.createDataFrame([(c, 1.0 / (i + 1)) for i, c in enumerate(st.STORE_FEATURES)], "feature string, importance double")
    root = shared_dir(spark, "model")
    spark.createDataFrame([("trees", "", {}, {"test_auc": TRAINING_AUC}, st.STORE_FEATURES, [])], model.METADATA_TYPE).write.json(f"{root}/metadata")
    stores = monitoring.Stores(
        predictions=writers.write_predictions(banded, shared_dir(spark, "predictions")),
        labels=writers.write_snapshots(st.outcomes(spark, sf).withColumnRenamed("label_date", "snapshot_date"), shared_dir(spark, "labels")),
        features=writers.write_snapshots(st.line_store(spark, sf, scaled=True), shared_dir(spark, "features")),
        importance=writers.write_table_csv(importance, f"{root}/feature_importance"),
        model=root,
        results=shared_dir(spark, "monitoring_store"),
    )
    return _monitored(spark, monitoring.monitor_stores(spark, stores, "2024-02-01T00:00:00"))
