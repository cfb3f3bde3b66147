"""Alert rules and decisions on hand-made summaries."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, evaluate


def summaries(spark, significant=0, moderate=0, auc=0.8, training=0.8, high_drift=(), missing=1.0):
    psi = spark.createDataFrame(
        [(0.21858, 0.5217, significant, moderate)], "avg_psi double, max_psi double, n_significant long, n_moderate long")
    metrics = spark.createDataFrame([(1, auc)], "m int, auc double").select(
        F.lit("2024-01-01").cast("date").alias("month"), F.lit(10).cast("long").alias("n_samples"), "auc",
        *[F.lit(0.5).alias(c) for c in ("accuracy", "precision", "recall", "f1_score", "actual_default_rate",
                                        "predicted_default_rate", "false_negative_rate", "false_positive_rate")])
    drift = spark.createDataFrame([(len(high_drift), list(high_drift))], "n_features_high_drift long, features_high_drift array<string>")
    checked = spark.createDataFrame([(missing,)], "max_missing_rate_pct double")
    return psi, evaluate.performance_summary(metrics, training), drift, checked


def raised(spark, **kw):
    return alerts.alerts(*summaries(spark, **kw))


def test_shipped_case(spark):
    """Seven drifted periods and 20.41 % missing give these two alerts and this advice."""
    rows = raised(spark, significant=7, auc=0.8245, training=0.7993, missing=20.411).orderBy("priority").collect()
    assert [(r.severity, r.category, r.message) for r in rows] == [
        ("critical", "population_drift", alerts.DRIFT_SIGNIFICANT.format(threshold=0.2) % 7),
        ("warning", "data_quality", alerts.MISSING_VALUES.format(limit=5.0) % 20.411),
    ]
    assert rows[0].metrics["max_psi"] == 0.5217
    advice = [r.recommendation for r in alerts.recommendations(
        raised(spark, significant=7, auc=0.8245, training=0.7993, missing=20.411)).orderBy("position").collect()]
    assert advice == [
        alerts.URGENT % 1,
        alerts.DRIFT_SIGNIFICANT_ADVICE,
        alerts.MISSING_VALUES_ADVICE,
        *alerts.STANDING_ADVICE,
    ]


def test_moderate_only_without_significant(spark):
    assert [r.severity for r in raised(spark, moderate=2).collect()] == ["warning"]
    assert [r.severity for r in raised(spark, moderate=2, significant=1).collect()] == ["critical"]


def test_nothing_wrong(spark):
    assert raised(spark).count() == 0
    psi, performance, *_ = summaries(spark)
    assert [r.recommendation for r in alerts.recommendations(raised(spark)).orderBy("position").collect()] == list(alerts.STANDING_ADVICE)
    row = alerts.retrain_decision(raised(spark), psi, performance).first()
    assert (row.should_retrain, row.reasons, row.recommendation) == (False, [], alerts.NO_RETRAIN)


def test_retrain_reasons_in_order(spark):
    kw = dict(significant=3, auc=0.70, training=0.80, high_drift=("x",))
    psi, performance, *_ = summaries(spark, **kw)
    row = alerts.retrain_decision(raised(spark, **kw), psi, performance).first()
    assert row.reasons == [
        alerts.DRIFT_SIGNIFICANT.format(threshold=0.2) % 3,
        alerts.DEGRADED % (0.7, 0.8),
        alerts.RETRAIN_DRIFT % 3,
        alerts.RETRAIN_DROP % 0.1,
    ]


@pytest.mark.parametrize("auc,status", [(0.82, "better"), (0.805, "similar"), (0.78, "degraded")])
def test_performance_status(spark, auc, status):
    _, performance, *_ = summaries(spark, auc=auc, training=0.8)
    assert performance.first().performance_status == status


def test_no_evaluation(spark):
    empty = spark.createDataFrame([], "month date, n_samples long, auc double, accuracy double, precision double, "
                                  "recall double, f1_score double, actual_default_rate double, predicted_default_rate double, "
                                  "false_negative_rate double, false_positive_rate double")
    row = evaluate.performance_summary(empty, 0.8).first()
    assert (row.evaluation_available, row.total_samples_evaluated, row.performance_status) == (False, 0, None)
