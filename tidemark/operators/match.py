"""Predictions matched to the nearest outcome within a window of months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.dates import month_number


#: Months from a prediction back and ahead to a label (fixed values).
BACK, AHEAD = 6, 12


def _least(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps one row per key and task before the shuffle (a window group
    limit), so a frequent key is reduced where it is read.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")


def nearest_label(
    predictions: DataFrame,
    labels: DataFrame,
    key: str = "Customer_ID",
    back: int = BACK,
    ahead: int = AHEAD,
) -> DataFrame:
    """One row per (key, inference_date): the prediction and its closest label.

    ``predictions``: key, inference_date, predicted_default, default_probability.
    ``labels``: key, label_date, loan_id, label, label_def.

    Distance is counted in calendar months, from ``back`` months before the
    prediction to ``ahead`` after it.  Among equal distances the least
    (label_date, loan_id) wins, so the earlier side beats the later one.

    No pairs are formed.  Both sides are first reduced to one row per key and
    date or month, which leaves a key with a third of all rows at most one row
    per calendar month, and then merged in month order: the closest label
    before and the closest after are the last and the next one seen.
    """
    p = _least(
        predictions.where(F.col(key).isNotNull() & F.col("inference_date").isNotNull()),
        [key, "inference_date"],
        ["default_probability", "predicted_default"],
    ).select(
        key,
        month_number(F.col("inference_date")).alias("__m"),
        "inference_date",
        F.struct("default_probability", "predicted_default").alias("__p"),
    )
    by_month = _least(
        labels.where(F.col(key).isNotNull() & F.col("label_date").isNotNull()).withColumn(
            "__m", month_number(F.col("label_date"))
        ),
        [key, "__m"],
        ["label_date", "loan_id", "label", "label_def"],
    ).select(
        key,
        "__m",
        F.struct(F.col("__m").alias("m"), "label_date", "loan_id", "label", "label_def").alias("__l"),
    )
    timeline = p.unionByName(by_month, allowMissingColumns=True)
    forward = Window.partitionBy(key).orderBy("__m").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    backward = Window.partitionBy(key).orderBy(F.desc("__m")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before, after = F.col("__before"), F.col("__after")
    gap_before = F.col("__m") - before["m"]
    gap_after = after["m"] - F.col("__m")
    ok_before = gap_before <= back
    ok_after = gap_after <= ahead
    chosen = (
        F.when(ok_before & (~F.coalesce(ok_after, F.lit(False)) | (gap_before <= gap_after)), before)
        .when(ok_after, after)
    )
    return (
        timeline.withColumn("__before", F.last("__l", ignorenulls=True).over(forward))
        .withColumn("__after", F.last("__l", ignorenulls=True).over(backward))
        .where(F.col("inference_date").isNotNull())
        .withColumn("__c", chosen)
        .where(F.col("__c").isNotNull())
        .select(
            key,
            "inference_date",
            F.col("__p.predicted_default").alias("predicted_default"),
            F.col("__p.default_probability").alias("default_probability"),
            F.col("__c.label_date").alias("label_date"),
            F.col("__c.loan_id").alias("loan_id"),
            F.col("__c.label").alias("label"),
            F.col("__c.label_def").alias("label_def"),
            (F.col("__c.m") - F.col("__m")).alias("date_diff_months"),
        )
    )


def match_quality(matched: DataFrame, predictions: DataFrame) -> DataFrame:
    """Per inference date: matched rows, time to label, share of that date's predictions."""
    hits = matched.groupBy("inference_date").agg(
        F.count("*").alias("n_matched"),
        F.avg("date_diff_months").alias("avg_time_to_label"),
        F.min("date_diff_months").alias("min_time"),
        F.max("date_diff_months").alias("max_time"),
    )
    totals = predictions.groupBy("inference_date").agg(F.count("*").alias("n_predictions"))
    return hits.join(totals, "inference_date").withColumn(
        "coverage_pct", F.col("n_matched") / F.col("n_predictions") * 100
    )


def match_totals(matched: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row over all dates: matches, coverage and time to label."""
    total = predictions.agg(F.count("*").alias("n")).scalar()
    return matched.agg(
        F.count("*").alias("n_matched"),
        F.avg("date_diff_months").alias("avg_time_to_label"),
        F.min("date_diff_months").alias("min_time"),
        F.max("date_diff_months").alias("max_time"),
    ).select(
        "*",
        total.alias("n_predictions"),
        (F.col("n_matched") / F.nullif(total, F.lit(0)) * 100).alias("coverage_pct"),
    )
