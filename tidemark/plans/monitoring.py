"""The monitoring job: stability, drift, evaluation, quality, alerts, summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.numbers import numeric_columns
from tidemark.operators import alerts, evaluate, match, model, quality, stability
from tidemark.session import cut_lineage
from tidemark.sources import readers, writers


@dataclass
class Thresholds:
    psi: float = 0.2
    auc_drop: float = 0.05
    missing_rate: float = 5.0


@dataclass
class MonitoringResult:
    psi: DataFrame
    drift: DataFrame
    performance: DataFrame
    quality: DataFrame
    psi_summary: DataFrame
    drift_summary: DataFrame
    performance_summary: DataFrame
    quality_summary: DataFrame
    alerts: DataFrame
    recommendations: DataFrame
    decision: DataFrame


def monitor(
    predictions: DataFrame,
    labels: DataFrame,
    feature_store: DataFrame,
    features: Sequence[str],
    training_auc: float | None = None,
    thresholds: Thresholds = Thresholds(),
    store_results: bool = True,
) -> MonitoringResult:
    """All monitors over whole stores.

    ``predictions``: Customer_ID, inference_date, predicted_default, default_probability;
    ``labels``: Customer_ID, label_date, loan_id, label, label_def;
    ``feature_store``: Customer_ID, snapshot_date and the features.

    The four result tables hold a row per period (and feature).  The
    summaries, alerts and decision read each several times, so they are
    written to the shared folder first.
    """
    keep = (lambda df, name: cut_lineage(df, name)) if store_results else (lambda df, name: df)
    psi = keep(stability.psi_over_time(predictions, "default_probability", "inference_date"), "psi")
    drift = keep(stability.feature_drift(feature_store, "snapshot_date", features), "drift")
    matched = match.nearest_label(predictions, labels)
    performance = keep(evaluate.evaluate_by_period(matched, "inference_date"), "performance")
    checked = keep(quality.quality_by_period(feature_store, "snapshot_date", "Customer_ID"), "quality")

    return conclude(psi, drift, performance, checked, training_auc, thresholds)


def conclude(
    psi: DataFrame,
    drift: DataFrame,
    performance: DataFrame,
    checked: DataFrame,
    training_auc: float | None = None,
    thresholds: Thresholds = Thresholds(),
) -> MonitoringResult:
    """Summaries, alerts, advice and the decision from the four result tables."""
    psi_summary = stability.psi_summary(psi, significant=thresholds.psi)
    drift_summary = stability.drift_summary(drift)
    performance_summary = evaluate.performance_summary(performance, training_auc)
    quality_summary = quality.quality_summary(checked)
    raised = alerts.alerts(
        psi_summary, performance_summary, drift_summary, quality_summary,
        thresholds.psi, thresholds.auc_drop, thresholds.missing_rate,
    )
    return MonitoringResult(
        psi, drift, performance, checked,
        psi_summary, drift_summary, performance_summary, quality_summary,
        raised,
        alerts.recommendations(raised),
        alerts.retrain_decision(raised, psi_summary, performance_summary),
    )


def _value(entries: Column, key: str) -> Column:
    """The value of a map at a key, null without it."""
    return F.get(F.map_values(F.map_filter(entries, lambda k, _: k == key)), F.lit(0))


def summary_document(result: MonitoringResult, spark: SparkSession, timestamp: str) -> DataFrame:
    """One nested row with every summary, the alerts with their metrics, and the advice.

    The parts are one-row tables, taken in as scalar subqueries.  Keys that a
    part leaves out are null.
    """
    def whole(df: DataFrame):
        return df.select(F.struct(*df.columns).alias("s")).scalar()

    p = whole(result.performance_summary)
    # Without an evaluated period only that is said.
    evaluated = lambda c: F.when(p["evaluation_available"], c)
    performance = F.struct(
        p["evaluation_available"].alias("evaluation_available"),
        evaluated(F.struct(p["period_start"].alias("start"), p["period_end"].alias("end"))).alias("evaluation_period"),
        p["total_samples_evaluated"].alias("total_samples_evaluated"),
        evaluated(F.struct(*[p[f"avg_{m}"].alias(m) for m in ("auc", "accuracy", "precision", "recall", "f1_score")])).alias("avg_metrics"),
        evaluated(F.struct(p["auc_min"].alias("auc_min"), p["auc_max"].alias("auc_max"))).alias("metric_ranges"),
        evaluated(F.struct(*[p[f"avg_{m}"].alias(f"avg_{m}") for m in (
            "actual_default_rate", "predicted_default_rate", "false_negative_rate", "false_positive_rate")])).alias("business_metrics"),
        F.when(p["training_test_auc"].isNotNull(), evaluated(F.struct(
            p["training_test_auc"].alias("training_test_auc"), p["avg_auc"].alias("production_avg_auc"),
            p["auc_difference"].alias("auc_difference"), p["performance_status"].alias("performance_status")))).alias("training_comparison"),
    )
    f = whole(result.drift_summary.withColumn("top_drifting_features", F.map_from_entries(
        F.transform("top_drifting_features", lambda x: F.struct(x["feature"], x["avg_psi"])))))
    drift = F.struct(
        f["n_features_monitored"].alias("n_features_monitored"),
        f["avg_feature_psi"].alias("avg_feature_psi"),
        f["top_drifting_features"].alias("top_drifting_features"),
        f["features_high_drift"].alias("features_high_drift"),
        f["n_features_high_drift"].alias("n_features_high_drift"),
    )
    # At most one alert per rule.  Its features are among its metrics; JSON leaves out what is null.
    def measured(a):
        found = F.from_json(a["metrics"], "map<string,double>")
        return F.when(found.isNotNull() | a["features"].isNotNull(), F.struct(
            *[_value(found, m).alias(m) for m in ("max_psi", "avg_psi", "auc_drop")],
            a["features"].alias("features"))).alias("metrics")

    raised = result.alerts.agg(F.transform(
        F.array_sort(F.collect_list(F.struct(
            "priority", "severity", "category", "message", "recommendation", F.to_json("metrics").alias("metrics"), "features"))),
        lambda a: F.struct(a["severity"], a["category"], a["message"], a["recommendation"], measured(a)),
    ).alias("a")).scalar()
    advice = result.recommendations.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", "recommendation"))),
            lambda a: a["recommendation"],
        ).alias("r")
    ).scalar()
    return spark.range(1).select(
        F.lit(timestamp).alias("timestamp"),
        whole(result.psi_summary).alias("psi_summary"),
        performance.alias("performance_summary"),
        drift.alias("feature_drift_summary"),
        whole(result.quality_summary).alias("data_quality_summary"),
        raised.alias("alerts"),
        advice.alias("recommendations"),
    )


def store(result: MonitoringResult, spark: SparkSession, root: str, run_ts: str) -> str:
    """Append the run's four tables and its summary under ``root``."""
    base = root.rstrip("/")
    for name, df in (
        ("psi_results", result.psi),
        ("feature_drift", result.drift),
        ("performance_metrics", result.performance),
        ("data_quality", result.quality),
    ):
        writers.write_run_result(df, f"{base}/{name}", run_ts)
    folder = run_ts.replace(":", "")  # a colon is no part of a Hadoop path
    writers.write_summary(summary_document(result, spark, run_ts), f"{base}/monitoring_summary/{folder}")
    return base


# What the stores hold (fixed values).
PREDICTION_TYPE = "Customer_ID string, predicted_default int, default_probability float, risk_category string, inference_date date"
LABEL_TYPE = "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"


@dataclass
class Stores:
    """Where a run reads and writes; all stores are partitioned by their date."""

    predictions: str
    labels: str
    features: str
    #: Table of (feature, importance) as CSV, and of the model's metadata; without them all
    #: numeric features are monitored and no training AUC is compared.
    importance: str | None = None
    model: str | None = None
    #: Where results go.
    results: str | None = None


def read_labels(spark: SparkSession, root: str) -> DataFrame:
    """The label store as the match wants it."""
    return readers.read_store(spark, root, schema=LABEL_TYPE).select(
        "Customer_ID", F.col("snapshot_date").alias("label_date"), "loan_id", "label", "label_def")


def monitored_features(spark: SparkSession, stores: Stores, feature_store: DataFrame, top_n: int = 10) -> list[str]:
    """The numeric ones of the most important features, or all numeric columns."""
    if stores.importance is None:
        return numeric_columns(feature_store.schema)
    return stability.top_numeric_features(readers.read_importance_csv(spark, stores.importance), feature_store.schema, top_n)


def training_auc(spark: SparkSession, stores: Stores) -> float | None:
    """The test AUC that training noted."""
    if stores.model is None:
        return None
    row = model.load_metadata(spark, stores.model).select(_value(F.col("metrics"), "test_auc")).first()
    return row[0] if row else None


def monitor_stores(
    spark: SparkSession,
    stores: Stores,
    run_ts: str,
    since: str | None = None,
    until: str | None = None,
    top_n: int = 10,
    thresholds: Thresholds = Thresholds(),
) -> MonitoringResult:
    """A whole run from paths: read, choose the features, monitor, store the results.

    ``since`` and ``until`` bound the monitored periods, both included; they reach the
    scans as partition filters.  Labels are read as far as a monitored prediction can match them.
    """
    def window(df: DataFrame, date: str, back: int = 0, ahead: int = 0) -> DataFrame:
        if since is not None:
            df = df.where(F.col(date) >= F.add_months(F.trunc(F.lit(since).cast("date"), "month"), -back) if back else F.col(date) >= F.lit(since).cast("date"))
        if until is not None:
            df = df.where(F.col(date) <= (F.last_day(F.add_months(F.lit(until).cast("date"), ahead)) if ahead else F.lit(until).cast("date")))
        return df

    predictions = window(readers.read_store(spark, stores.predictions, schema=PREDICTION_TYPE), "inference_date")
    labels = window(read_labels(spark, stores.labels), "label_date", match.BACK, match.AHEAD)
    feature_store = window(readers.read_store(spark, stores.features), "snapshot_date")
    features = monitored_features(spark, stores, feature_store, top_n)
    result = monitor(predictions, labels, feature_store, features, training_auc(spark, stores), thresholds)
    if stores.results is not None:
        store(result, spark, stores.results, run_ts)
    return result
