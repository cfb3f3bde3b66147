"""Per-period data quality and score statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.numbers import is_missing, row_sum
from tidemark.operators.quantiles import exact_quantiles


def snapshot_counts(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(date).agg(F.count("*").alias("n_rows"))


def quality_state(df: DataFrame, period: str, entity: str) -> DataFrame:
    """Per period: rows, nulls of all columns, distinct entities, columns besides key and date.

    A null entity is one value.  Distinct entities don't add up over parts, so a period's
    state is taken from all its rows.
    """
    nulls = row_sum(
        [F.when(is_missing(F.col(f.name), f.dataType), 1).otherwise(0) for f in df.schema.fields]
    )
    # Per entity first: partial counts of a frequent entity meet before the shuffle.
    per_entity = df.where(F.col(period).isNotNull()).groupBy(period, entity).agg(
        F.count("*").alias("__n"), F.sum(nulls).alias("__nulls")
    )
    return per_entity.groupBy(F.col(period).alias("month")).agg(
        F.sum("__n").alias("n_rows"),
        F.sum("__nulls").alias("n_nulls"),
        F.count("*").alias("n_entities"),
        F.lit(len(df.columns) - 2).alias("n_features"),
    )


def quality_from_state(state: DataFrame) -> DataFrame:
    """Per period: rows, missing-rate percent, duplicate entities.

    Nulls of all columns are counted, but divided by the rows times the
    columns other than the key and the date.
    """
    return state.select(
        "month",
        "n_rows",
        (F.col("n_nulls") / (F.col("n_rows") * F.col("n_features")) * 100).alias("missing_rate_pct"),
        (F.col("n_rows") - F.col("n_entities")).alias("n_duplicates"),
    )


def quality_by_period(df: DataFrame, period: str, entity: str) -> DataFrame:
    """Per period: rows, missing-rate percent, duplicate entities."""
    return quality_from_state(quality_state(df, period, entity))


def quality_summary(quality: DataFrame) -> DataFrame:
    """One row; the earliest of equal maxima gives the date."""
    rank = F.struct(F.col("missing_rate_pct"), (-F.unix_date("month")).alias("d"))
    return quality.agg(
        F.coalesce(F.avg("missing_rate_pct"), F.lit(0.0)).alias("avg_missing_rate_pct"),
        F.coalesce(F.max("missing_rate_pct"), F.lit(0.0)).alias("max_missing_rate_pct"),
        F.max_by("month", rank).alias("max_missing_rate_date"),
        F.coalesce(F.avg("n_rows"), F.lit(0.0)).alias("avg_rows_per_month"),
        F.coalesce(F.sum("n_duplicates"), F.lit(0)).alias("total_duplicates"),
    )


def category_shares(df: DataFrame, period: str, category: str) -> DataFrame:
    """``(period, category, n, percent)``: every value found in a period, percent of its rows with a category.

    Any number of categories; rows are combined per value before the shuffle.
    """
    counted = (
        df.where(F.col(category).isNotNull() & F.col(period).isNotNull())
        .groupBy(period, F.col(category).cast("string").alias("category"))
        .agg(F.count("*").alias("n"))
    )
    totals = counted.groupBy(period).agg(F.sum("n").alias("__all"))
    return counted.join(totals, period).select(period, "category", "n", (F.col("n") / F.col("__all") * 100).alias("percent"))


#: Categories up to which each gets a column.
MAX_CATEGORIES = 1000


def category_shares_wide(df: DataFrame, period: str, category: str, prefix: str = "pct_") -> DataFrame:
    """Percent of each category per period, a column for each category found; one that is absent gives 0.

    Finding them takes a pass over the category alone.  A category of more than
    ``MAX_CATEGORIES`` values is returned in long form, as ``category_shares`` has it.
    """
    found = df.select(F.col(category).cast("string").alias("c")).where("c IS NOT NULL").distinct()
    values = sorted(r["c"] for r in found.limit(MAX_CATEGORIES + 1).collect())
    if len(values) > MAX_CATEGORIES:
        return category_shares(df, period, category)
    total = F.nullif(F.count(category), F.lit(0))
    return df.groupBy(period).agg(
        *[
            F.coalesce(F.count_if(F.col(category).cast("string") == v) / total * 100, F.lit(0.0)).alias(f"{prefix}{v}")
            for v in values
        ]
    )


def score_statistics(
    df: DataFrame,
    period: str,
    entity: str,
    score: str,
    predicted: str,
    category: str,
) -> DataFrame:
    """Per period: count, mean, std, min, max, exact median, predicted rate, category shares.

    ``category_percents`` maps every category that the period holds to its
    percent.  All but the median and the shares come from the pass that
    makes the median's sketch.
    """
    rows = df.where(F.col(period).isNotNull())
    basics = exact_quantiles(rows, [period], F.col(score), [0.5], also={
        "n_customers": F.count(entity),
        "avg_probability": F.avg(score),
        "std_probability": F.stddev_samp(score),
        "min_probability": F.min(score),
        "max_probability": F.max(score),
        "predicted_default_rate": F.avg(predicted),
    }).withColumnRenamed("q_0", "median_probability")
    # A row per period and category comes in.
    shares = category_shares(rows, period, category).groupBy(period).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "percent")))).alias("category_percents")
    )
    return basics.join(shares, period, "left")


def run_statistics(df: DataFrame, period: str, score: str, predicted: str) -> DataFrame:
    """One row over the whole run."""
    return df.agg(
        F.count("*").alias("n_scored"),
        F.avg(score).alias("avg_probability"),
        F.min(score).alias("min_probability"),
        F.max(score).alias("max_probability"),
        F.count_if(F.col(predicted) == 1).alias("n_predicted"),
        F.avg(predicted).alias("predicted_default_rate"),
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        F.countDistinct(period).alias("n_periods"),
    )


def latest_run(df: DataFrame, run: str = "run_ts") -> DataFrame:
    """Rows of the newest run; the value reaches the scan as a partition filter."""
    return df.where(F.col(run) == df.agg(F.max(run)).scalar())


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once with the number of rows beyond the first."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias("n_extra")).where(F.col("n_extra") > 0)
