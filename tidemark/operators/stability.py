"""Population stability (PSI) and feature drift against the first period.

One pass over the rows counts each bin per period; what follows works on one
row per period (and feature), so no period is filtered or scanned on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.bands import drift_status
from tidemark.functions.bins import bin_index, edges
from tidemark.functions.numbers import numeric_columns, percent_change

# Share given to an empty bin before the logarithm (fixed value).
EMPTY_SHARE = 0.0001


def bin_counts(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    bins: int = 10,
    low: Column | float = 0.0,
    high: Column | float = 1.0,
    moments: bool = False,
) -> DataFrame:
    """Per key: rows, non-null rows and an array of bin counts.

    The rows are grouped once, by key and bin; the arrays are made from that
    table of at most ``bins + 1`` rows per key.  With ``moments`` the mean and
    the population std are merged from those of the bins.
    """
    v = value.cast("double")
    tagged = df.select(
        *keys,
        F.when(~F.isnan(v), v).alias("__v"),
        bin_index(v, bins, low, high).alias("__b"),
    )
    per_bin = tagged.groupBy(*keys, "__b").agg(
        F.count("*").alias("__n"),
        F.count("__v").alias("__k"),
        *([F.avg("__v").alias("__mean"), F.var_pop("__v").alias("__var")] if moments else []),
    )
    out = [
        F.sum("__n").alias("n_rows"),
        F.sum("__k").alias("n_values"),
        F.array(
            *[F.coalesce(F.sum(F.when(F.col("__b") == i, F.col("__n"))), F.lit(0)) for i in range(bins)]
        ).alias("counts"),
    ]
    if moments:
        whole = Window.partitionBy(*keys)
        weight = F.when(F.col("__k") > 0, F.col("__k")).cast("double")
        per_bin = per_bin.withColumn(
            "__all", F.sum(weight * F.col("__mean")).over(whole) / F.sum(weight).over(whole)
        )
        spread = F.col("__var") + (F.col("__mean") - F.col("__all")) * (F.col("__mean") - F.col("__all"))
        out += [
            F.first("__all").alias("mean"),
            F.sqrt(F.sum(weight * spread) / F.sum(weight)).alias("std"),
        ]
    return per_bin.groupBy(*keys).agg(*out)


def floored_shares(counts: Column, total: Column) -> Column:
    """Shares of ``total`` with empty bins lifted to the fixed small share."""
    return F.transform(
        counts, lambda c: F.when(c == 0, F.lit(EMPTY_SHARE)).otherwise(c / total)
    )


def psi_of_shares(actual: Column, expected: Column) -> Column:
    parts = F.zip_with(actual, expected, lambda a, e: (a - e) * F.ln(a / e))
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def histogram_shares(
    df: DataFrame, keys: Sequence[str], value: Column, bins: int = 10
) -> DataFrame:
    """Long form of the fixed-grid histogram: every bin of every key is present."""
    counted = bin_counts(df, keys, value, bins)
    grid = edges(bins)
    return counted.select(*keys, "n_rows", F.posexplode("counts").alias("bin", "n")).select(
        *keys,
        "bin",
        F.element_at(F.array(*[F.lit(e) for e in grid[:-1]]), F.col("bin") + 1).alias("bin_low"),
        "n",
        F.when(F.col("n") == 0, F.lit(EMPTY_SHARE))
        .otherwise(F.col("n") / F.col("n_rows"))
        .alias("share"),
    )


def psi_between(
    expected: DataFrame, actual: DataFrame, value: str, bins: int = 10
) -> DataFrame:
    """PSI of two samples: one row with the edges and both share arrays.

    Null values stay in the denominator, as values outside the grid do.
    """
    both = expected.select(F.lit(0).alias("__side"), F.col(value)).unionAll(
        actual.select(F.lit(1).alias("__side"), F.col(value))
    )
    shares = bin_counts(both, ["__side"], F.col(value), bins).select(
        "__side", floored_shares(F.col("counts"), F.col("n_rows")).alias("shares")
    )
    sides = shares.agg(
        F.max(F.when(F.col("__side") == 0, F.col("shares"))).alias("expected_percents"),
        F.max(F.when(F.col("__side") == 1, F.col("shares"))).alias("actual_percents"),
    )
    return sides.select(
        psi_of_shares(F.col("actual_percents"), F.col("expected_percents")).alias("psi"),
        F.array(*[F.lit(e) for e in edges(bins)]).alias("breakpoints"),
        "expected_percents",
        "actual_percents",
    )


def score_state(df: DataFrame, score: str, period: str, bins: int = 10) -> DataFrame:
    """Per period what the PSI needs of its rows: ``(period, n_rows, n_values, counts)``.

    The states of two parts of a period add up (``merge_states``).
    """
    return bin_counts(df.where(F.col(period).isNotNull()), [period], F.col(score), bins)


def psi_from_state(state: DataFrame, period: str) -> DataFrame:
    """PSI of every later period against the first, from one row per period."""
    shares = state.select(period, floored_shares(F.col("counts"), F.col("n_rows")).alias("shares"))
    first = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        shares.select(
            F.col(period).alias("date"),
            psi_of_shares(F.col("shares"), F.first("shares").over(first)).alias("psi"),
            F.first(period).over(first).alias("baseline_date"),
        )
        .where(F.col("date") > F.col("baseline_date"))
    )


def psi_over_time(df: DataFrame, score: str, period: str, bins: int = 10) -> DataFrame:
    """PSI of every later period against the first: ``(date, psi, baseline_date)``."""
    return psi_from_state(score_state(df, score, period, bins), period)


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of parts, several rows per key, to one row per key.

    Counts add up; the mean and the sum of squared deviations, where there are
    any, are combined around the common mean.
    """
    width = F.max(F.size("counts"))
    counts = F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda i: F.aggregate(F.collect_list("counts"), F.lit(0).cast("long"), lambda total, c: total + c[i]),
    )
    out = [F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values")]
    if "mean" in states.columns:
        whole = Window.partitionBy(*keys)
        n = F.col("n_values").cast("double")
        states = states.withColumn("__all", F.sum(n * F.col("mean")).over(whole) / F.nullif(F.sum(n).over(whole), F.lit(0.0)))
        gap = F.col("mean") - F.col("__all")
        out += [F.first("__all").alias("mean"), F.sum(F.col("squares") + n * gap * gap).alias("squares")]
    return states.groupBy(*keys).agg(*out, counts.alias("counts"))


def psi_summary(psi: DataFrame, moderate: float = 0.1, significant: float = 0.2) -> DataFrame:
    """One row; ties of the extremes go to the earliest date, no rows give zeros."""
    by_psi = F.struct(F.col("psi"), (-F.unix_date("date")).alias("d"))
    by_low = F.struct(F.col("psi"), F.unix_date("date").alias("d"))
    status = drift_status(F.col("psi"), moderate, significant)
    return psi.agg(
        F.coalesce(F.avg("psi"), F.lit(0.0)).alias("avg_psi"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.coalesce(F.min("psi"), F.lit(0.0)).alias("min_psi"),
        F.max_by("date", by_psi).alias("max_psi_date"),
        F.min_by("date", by_low).alias("min_psi_date"),
        F.count_if(status == "stable").alias("n_stable"),
        F.count_if(status == "moderate").alias("n_moderate"),
        F.count_if(status == "significant").alias("n_significant"),
    )


def unpivot_numeric(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "feature"
) -> DataFrame:
    """Wide to long: one row per key and column, values as double, nulls kept."""
    doubles = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(keys), list(columns), name, "value")


def feature_state(df: DataFrame, period: str, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Per period and feature what the drift needs of its rows.

    ``(period, feature, n_rows, n_values, mean, squares, counts)``; ``squares`` is the
    sum of squared deviations from the mean.  The states of two parts of a
    period are combined by ``merge_states``.
    """
    long = unpivot_numeric(df.where(F.col(period).isNotNull()), [period], features)
    return bin_counts(long, [period, "feature"], F.col("value"), bins, moments=True).select(
        period, "feature", "n_rows", "n_values", "mean", (F.col("std") * F.col("std") * F.col("n_values")).alias("squares"), "counts"
    )


def drift_from_state(state: DataFrame, period: str) -> DataFrame:
    """Drift against each feature's first period, from one row per period and feature."""
    stats = state.select(
        period,
        "feature",
        "n_values",
        "mean",
        F.sqrt(F.col("squares") / F.nullif(F.col("n_values"), F.lit(0))).alias("std"),
        floored_shares(F.col("counts"), F.nullif(F.col("n_values"), F.lit(0))).alias("shares"),
    )
    first = Window.partitionBy("feature").orderBy(period).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    base = F.first(
        F.struct(period, "n_values", "mean", "std", "shares")
    ).over(first)
    return (
        stats.withColumn("__base", base)
        .where(
            (F.col(period) > F.col(f"__base.{period}"))
            & (F.col("__base.n_values") > 0)
            & (F.col("n_values") > 0)
        )
        .select(
            F.col(period).alias("date"),
            "feature",
            psi_of_shares(F.col("shares"), F.col("__base.shares")).alias("psi"),
            percent_change(F.col("mean"), F.col("__base.mean")).alias("mean_change_pct"),
            percent_change(F.col("std"), F.col("__base.std")).alias("std_change_pct"),
        )
    )


def feature_drift(
    df: DataFrame, period: str, features: Sequence[str], bins: int = 10
) -> DataFrame:
    """PSI, mean change and std change of each feature against the first period.

    Nulls are left out of the shares.  A feature without values in the first
    period, or in the period itself, gives no row.
    """
    return drift_from_state(feature_state(df, period, features, bins), period)


def top_numeric_features(
    importance: DataFrame, schema, top_n: int = 10
) -> list[str]:
    """The numeric ones among the ``top_n`` most important features.

    Reads at most ``top_n`` rows to the driver: they are column names, which
    the plan that uses them must know.
    """
    names = [r["feature"] for r in importance.orderBy(F.desc("importance"), "feature").limit(top_n).collect()]
    return numeric_columns(schema, among=names)


def drift_by_feature(drift: DataFrame, top_k: int = 5) -> DataFrame:
    """The ``top_k`` features by mean PSI."""
    return (
        drift.groupBy("feature")
        .agg(F.avg("psi").alias("avg_psi"))
        .orderBy(F.desc("avg_psi"), "feature")
        .limit(top_k)
    )


def drift_summary(drift: DataFrame, significant: float = 0.2, top_k: int = 5) -> DataFrame:
    """One row: features monitored, mean PSI, top features, features with high drift."""
    per_feature = drift.groupBy("feature").agg(
        F.avg("psi").alias("avg_psi"),
        F.sum("psi").alias("__sum"),
        F.count("psi").alias("__n"),
        F.max("psi").alias("__max"),
    )
    # One row per feature: the array below is as long as the feature list.
    ranked = F.array_sort(
        F.collect_list(F.struct((-F.col("avg_psi")).alias("o"), "feature", "avg_psi"))
    )
    high = F.array_sort(F.collect_list(F.when(F.col("__max") >= significant, F.col("feature"))))
    return per_feature.agg(
        F.count("*").alias("n_features_monitored"),
        F.coalesce(F.sum("__sum") / F.nullif(F.sum("__n"), F.lit(0)), F.lit(0.0)).alias("avg_feature_psi"),
        F.transform(
            F.slice(ranked, 1, top_k), lambda x: F.struct(x["feature"], x["avg_psi"])
        ).alias("top_drifting_features"),
        high.alias("features_high_drift"),
        F.size(high).cast("long").alias("n_features_high_drift"),
    )


def drift_matrix(drift: DataFrame, value: str = "psi") -> DataFrame:
    """Feature by date, a column for each date found; the dates are those of the calendar."""
    return drift.groupBy("feature").pivot("date").agg(F.first(value))


def rows_at_or_above(df: DataFrame, value: str, threshold: float) -> DataFrame:
    return df.where(F.col(value) >= threshold)
