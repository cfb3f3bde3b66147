"""Alert rows, recommendations and the retraining decision.

Every rule reads a one-row summary and gives a row or none, so alerts are a
table like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

ALERT_SCHEMA = "priority int, severity string, category string, message string, recommendation string, metrics map<string,double>, features array<string>"

# Sentences of stored monitoring summaries.
DRIFT_SIGNIFICANT = "Significant population drift detected in %d periods (PSI >= {threshold})"
DRIFT_SIGNIFICANT_ADVICE = "Model retraining strongly recommended"
MISSING_VALUES = "Missing value rate exceeds {limit}%% (max: %.2f%%)"
MISSING_VALUES_ADVICE = "Review data pipeline and investigate missing data sources"
URGENT = "URGENT: %d critical issue(s) detected - immediate action required"
STANDING_ADVICE = (
    "Continue monitoring model performance monthly",
    "Set up automated alerts for PSI > 0.2 or feature drift > 0.2",
    "Schedule quarterly model performance reviews",
)

# Sentences of this library.
DRIFT_MODERATE = "Scores moved between the two drift limits; periods concerned: %d"
DRIFT_MODERATE_ADVICE = "Compare the drifted periods with the first one, source by source"
DEGRADED = "AUC is %.4f on labelled predictions and was %.4f in training: more is lost than accepted"
DEGRADED_ADVICE = "Check labels and inputs of the weakest periods, then fit anew"
FEATURES_DRIFTED = "Features beyond the drift limit: %d"
FEATURES_DRIFTED_ADVICE = "Trace each feature listed to its table and load date"
RETRAIN_DRIFT = "Periods beyond the drift limit: %d"
RETRAIN_DROP = "AUC lost since training: %.4f"
RETRAIN = "Fit the model anew"
NO_RETRAIN = "Keep the model"


def _alert(
    priority: int,
    severity: Column | str,
    category: str,
    message: Column,
    recommendation: Column | str,
    metrics: Column | None = None,
    features: Column | None = None,
) -> list[Column]:
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return [
        F.lit(priority).alias("priority"),
        text(severity).alias("severity"),
        F.lit(category).alias("category"),
        message.alias("message"),
        text(recommendation).alias("recommendation"),
        (metrics if metrics is not None else F.lit(None)).cast("map<string,double>").alias("metrics"),
        (features if features is not None else F.lit(None)).cast("array<string>").alias("features"),
    ]


def drift_alert(psi_summary: DataFrame, psi_threshold: float = 0.2) -> DataFrame:
    """Critical if any period drifted significantly, else a warning for moderate drift.

    ``psi_summary`` must have been counted with the same threshold.
    """
    significant = F.col("n_significant") > 0
    return psi_summary.where(significant | (F.col("n_moderate") > 0)).select(
        *_alert(
            1,
            F.when(significant, "critical").otherwise("warning"),
            "population_drift",
            F.when(
                significant,
                F.format_string(DRIFT_SIGNIFICANT.format(threshold=psi_threshold), "n_significant"),
            ).otherwise(F.format_string(DRIFT_MODERATE, "n_moderate")),
            F.when(significant, DRIFT_SIGNIFICANT_ADVICE).otherwise(DRIFT_MODERATE_ADVICE),
            F.when(
                significant,
                F.create_map(F.lit("max_psi"), F.col("max_psi"), F.lit("avg_psi"), F.col("avg_psi")),
            ),
        )
    )


def degradation_alert(performance: DataFrame, auc_drop: float = 0.05) -> DataFrame:
    return performance.where(
        (F.col("performance_status") == "degraded") & (F.col("auc_difference") < -auc_drop)
    ).select(
        *_alert(
            2,
            "critical",
            "performance_degradation",
            F.format_string(DEGRADED, "avg_auc", "training_test_auc"),
            DEGRADED_ADVICE,
            F.create_map(F.lit("auc_drop"), F.col("auc_difference")),
        )
    )


def feature_drift_alert(drift_summary: DataFrame) -> DataFrame:
    return drift_summary.where(F.col("n_features_high_drift") > 0).select(
        *_alert(
            3,
            "high",
            "feature_drift",
            F.format_string(FEATURES_DRIFTED, "n_features_high_drift"),
            FEATURES_DRIFTED_ADVICE,
            features=F.col("features_high_drift"),
        )
    )


def quality_alert(quality_summary: DataFrame, missing_rate: float = 5.0) -> DataFrame:
    return quality_summary.where(F.col("max_missing_rate_pct") > missing_rate).select(
        *_alert(
            4,
            "warning",
            "data_quality",
            F.format_string(MISSING_VALUES.format(limit=missing_rate), "max_missing_rate_pct"),
            MISSING_VALUES_ADVICE,
        )
    )


def alerts(
    psi_summary: DataFrame,
    performance: DataFrame,
    drift_summary: DataFrame,
    quality_summary: DataFrame,
    psi_threshold: float = 0.2,
    auc_drop: float = 0.05,
    missing_rate: float = 5.0,
) -> DataFrame:
    """All alerts, ``priority`` giving the order of the rules."""
    return reduce(
        DataFrame.unionByName,
        [
            drift_alert(psi_summary, psi_threshold),
            degradation_alert(performance, auc_drop),
            feature_drift_alert(drift_summary),
            quality_alert(quality_summary, missing_rate),
        ],
    )


def recommendations(alert_rows: DataFrame) -> DataFrame:
    """Ordered advice ``(position, recommendation)``.

    An urgent header if anything is critical, the distinct advice of the
    alerts in rule order, then the standing advice.  At most one row per rule
    comes in, so the arrays are short.
    """
    gathered = alert_rows.agg(
        F.count_if(F.col("severity") == "critical").alias("n"),
        F.array_sort(F.collect_list(F.struct("priority", "recommendation"))).alias("advice"),
    )
    header = F.when(
        F.col("n") > 0,
        F.array(F.format_string(URGENT, "n")),
    ).otherwise(F.array().cast("array<string>"))
    specific = F.array_distinct(F.transform("advice", lambda a: a["recommendation"]))
    standing = F.array(*[F.lit(s) for s in STANDING_ADVICE])
    return gathered.select(
        F.posexplode(F.concat(header, specific, standing)).alias("position", "recommendation")
    )


def retrain_decision(
    alert_rows: DataFrame,
    psi_summary: DataFrame,
    performance: DataFrame,
    periods: int = 3,
    auc_drop: float = 0.05,
) -> DataFrame:
    """One row: whether to retrain, the reasons in rule order, the advice."""
    critical = alert_rows.where(F.col("severity") == "critical").select(
        F.lit(1).alias("rule"), "priority", F.col("message").alias("reason")
    )
    drifted = psi_summary.where(F.col("n_significant") >= periods).select(
        F.lit(2).alias("rule"), F.lit(0).alias("priority"),
        F.format_string(RETRAIN_DRIFT, "n_significant").alias("reason"),
    )
    dropped = performance.where(
        (F.col("performance_status") == "degraded") & (F.col("auc_difference") < -auc_drop)
    ).select(
        F.lit(3).alias("rule"), F.lit(0).alias("priority"),
        F.format_string(RETRAIN_DROP, F.abs(F.col("auc_difference"))).alias("reason"),
    )
    reasons = F.array_sort(F.collect_list(F.struct("rule", "priority", "reason")))
    return (
        critical.unionByName(drifted)
        .unionByName(dropped)
        .agg(F.transform(reasons, lambda r: r["reason"]).alias("reasons"))
        .select(
            (F.size("reasons") > 0).alias("should_retrain"),
            "reasons",
            F.when(F.size("reasons") > 0, RETRAIN)
            .otherwise(NO_RETRAIN)
            .alias("recommendation"),
        )
    )


#: The standing points of the longer report; the second-last one asks for an evaluation.
STANDING_RULES = ("monthly_review", "drift_alarm", "auc_alarm", "quarterly_review")


def extended_recommendations(
    psi_summary: DataFrame,
    performance: DataFrame,
    trend: DataFrame,
    drift_summary: DataFrame,
    quality_summary: DataFrame,
    variability: DataFrame,
    auc_drop: float = 0.05,
    trend_drop: float = 0.03,
    missing_rate: float = 5.0,
) -> DataFrame:
    """The longer report: degradation, falling trend, drift, quality, variability, standing points.

    ``(position, rule, level, values, recommendation)``; the text is made from the
    other columns, values with four digits in the order of their names.
    """
    def rows(position: int, df: DataFrame, rule: str, level: Column | str, test: Column | None = None, **values: Column) -> DataFrame:
        kept = df if test is None else df.where(test)
        entries = [x for k, v in values.items() for x in (F.lit(k), v.cast("double"))]
        return kept.select(
            F.lit(position).alias("position"), F.lit(rule).alias("rule"),
            (F.lit(level) if isinstance(level, str) else level).alias("level"),
            (F.create_map(*entries) if entries else F.create_map()).cast("map<string,double>").alias("values"),
        )

    parts = [
        rows(1, performance, "auc_against_training", "critical", F.col("avg_auc") < F.col("training_test_auc") - auc_drop,
             production=F.col("avg_auc"), training=F.col("training_test_auc")),
        rows(2, trend, "auc_trend", "warning", (F.col("n_periods") >= 3) & (F.col("change") < -trend_drop),
             first_periods=F.col("early"), last_periods=F.col("recent")),
        rows(3, psi_summary, "score_drift", F.when(F.col("n_significant") > 0, "critical").when(F.col("n_moderate") > 0, "caution").otherwise("ok"),
             moderate=F.col("n_moderate"), significant=F.col("n_significant")),
        rows(4, drift_summary, "feature_drift", "critical", F.col("n_features_high_drift") > 0, features=F.col("n_features_high_drift")),
        rows(5, quality_summary, "missing_values", "caution", F.col("max_missing_rate_pct") > missing_rate,
             limit_pct=F.lit(missing_rate), max_pct=F.col("max_missing_rate_pct")),
        rows(6, variability, "predicted_rate_varies", "caution", F.col("high_variability")),
    ]
    for i, rule in enumerate(STANDING_RULES):
        parts.append(rows(7 + i, performance, rule, "standing", F.col("evaluation_available") if rule == "auc_alarm" else None))
    shown = F.transform(
        F.array_sort(F.map_entries("values")), lambda e: F.format_string(" %s=%.4f", e["key"], e["value"]))
    return reduce(DataFrame.unionByName, parts).withColumn(
        "recommendation", F.concat("level", F.lit(": "), "rule", F.array_join(shown, "")))
