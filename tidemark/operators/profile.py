"""Column profiles, key checks, bounds and correlation.

Everything about single columns comes from one grouped pass over the rows;
the long result is made afterwards from the one wide row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.numbers import is_missing
from tidemark.functions.text import non_numeric
from tidemark.operators.comoments import correlations
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.stability import unpivot_numeric


def _one_row_to_long(
    wide: DataFrame, columns: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """A row with ``<measure>__<i>`` fields to one row per column."""
    entries = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            *[F.col(f"{m}__{i}").alias(m) for m in measures],
        )
        for i, c in enumerate(columns)
    ])
    return wide.select("n_rows", F.explode(entries).alias("e")).select("e.*", "n_rows")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percent of every column, from one pass."""
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    wide = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(is_missing(F.col(c), types[c])).alias(f"missing_count__{i}")
          for i, c in enumerate(columns)],
    )
    return _one_row_to_long(wide, columns, ["missing_count"]).select(
        "column_name",
        "missing_count",
        (F.col("missing_count") / F.nullif(F.col("n_rows"), F.lit(0)) * 100).alias("missing_percent"),
    )


def columns_with_missing(profile: DataFrame, above_percent: float = 0.0) -> DataFrame:
    """Columns above a missing percentage, most missing first."""
    return profile.where(
        (F.col("missing_count") > 0) & (F.col("missing_percent") > above_percent)
    ).orderBy(F.desc("missing_count"), "column_name")


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max of each column."""
    long = unpivot_numeric(df, [], columns, "column_name")
    value = F.when(~F.isnan("value"), F.col("value"))
    return exact_quantiles(long, ["column_name"], F.col("value"), [0.25, 0.5, 0.75], also={
        "n": F.count(value), "mean": F.avg(value), "std": F.stddev_samp(value), "min": F.min(value), "max": F.max(value),
    }).select(
        "column_name", "n", "mean", "std", "min",
        F.col("q_0").alias("q25"), F.col("q_1").alias("q50"), F.col("q_2").alias("q75"), "max",
    )


def numeric_quality(df: DataFrame, columns: Sequence[str], reach: float = 3.0) -> DataFrame:
    """Nulls, non-numeric text, extreme outliers, min and max of each column.

    Text columns are read leniently.  Outliers lie more than ``reach`` times
    the interquartile range outside the quartiles.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    as_double = df.select(*[F.col(c).try_cast("double").alias(c) for c in columns])
    counted = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_count__{i}") for i, c in enumerate(columns)],
        *[
            (F.count_if(non_numeric(F.col(c))) if types[c] == "string" else F.lit(0).cast("long"))
            .alias(f"non_numeric__{i}")
            for i, c in enumerate(columns)
        ],
        *[F.min(F.col(c).try_cast("double")).alias(f"min__{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).try_cast("double")).alias(f"max__{i}") for i, c in enumerate(columns)],
    )
    facts = _one_row_to_long(counted, columns, ["null_count", "non_numeric", "min", "max"])
    long = as_double.unpivot([], list(columns), "column_name", "value")
    fences = exact_quantiles(long, ["column_name"], F.col("value"), [0.25, 0.75]).select(
        "column_name",
        (F.col("q_0") - reach * (F.col("q_1") - F.col("q_0"))).alias("__low"),
        (F.col("q_1") + reach * (F.col("q_1") - F.col("q_0"))).alias("__high"),
    )
    # One row per column.
    outliers = long.join(F.broadcast(fences), "column_name").groupBy("column_name").agg(
        F.count_if((F.col("value") < F.col("__low")) | (F.col("value") > F.col("__high"))).alias("extreme_outliers")
    )
    return facts.join(outliers, "column_name", "left").select(
        "column_name",
        "null_count",
        F.round(F.col("null_count") / F.nullif(F.col("n_rows"), F.lit(0)) * 100, 1).alias("null_percent"),
        "non_numeric",
        F.coalesce("extreme_outliers", F.lit(0)).alias("extreme_outliers"),
        "min",
        "max",
    )


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and exact distinct count of each column.

    Distinct values are counted per (column, value) with map-side combining,
    so a value held by a third of the rows costs one row per task.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    per_value = long.groupBy("column_name", "value").agg(F.count("*").alias("__n"))
    nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("__n"))), F.lit(0))
    return per_value.groupBy("column_name").agg(
        nulls.alias("null_count"),
        F.round(nulls / F.sum("__n") * 100, 1).alias("null_percent"),
        F.count("value").alias("n_unique"),
    )


#: A distinct sketch has 2**SKETCH_BITS registers.
SKETCH_BITS = 14


def distinct_error(bits: int = SKETCH_BITS) -> float:
    """Relative error that an estimate exceeds in about one of 400 cases."""
    return 3 * 1.04 / 2 ** (bits / 2)


def distinct_states(df: DataFrame, period: str, columns: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """``(period, column_name, n_rows, null_count, sketch)``: distinct counts that can be merged.

    A sketch has a fixed size (about 2**bits bytes at most), however many values there are.
    Store a row per snapshot and column; the profile of any set of snapshots follows without their rows.
    """
    long = df.select(period, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [period], list(columns), "column_name", "value"
    )
    return long.groupBy(period, "column_name").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.hll_sketch_agg("value", bits).alias("sketch"),
    )


def categorical_profile_from_states(states: DataFrame) -> DataFrame:
    """The approximate ``categorical_profile`` of all periods in ``states``."""
    nulls = F.sum("null_count")
    return states.groupBy("column_name").agg(
        nulls.alias("null_count"),
        F.round(nulls / F.sum("n_rows") * 100, 1).alias("null_percent"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_unique"),
    )


def key_checks(
    df: DataFrame, unique_key: str, entity_key: str, date: str
) -> DataFrame:
    """One row: is the key unique, entities, rows, snapshot days, first and last date.

    Three exact distinct counts in one aggregate would copy every row three
    times.  The entities and dates are counted from their distinct pairs, and
    the key in a pass of its own that reads nothing else.
    """
    keys = df.agg(
        (F.countDistinct(unique_key) + F.max(F.when(F.col(unique_key).isNull(), 1).otherwise(0))).alias("n")
    ).scalar()
    pairs = df.groupBy(entity_key, date).agg(F.count("*").alias("__n"))
    return pairs.agg(
        F.sum("__n").alias("n_rows"),
        F.countDistinct(entity_key).alias("n_entities"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        # At most one entry per snapshot date.
        F.collect_set(date).alias("__dates"),
    ).select(
        (keys == F.col("n_rows")).alias("key_is_unique"),
        "n_entities",
        "n_rows",
        F.size("__dates").cast("long").alias("n_dates"),
        "first_date",
        "last_date",
        F.array_sort(F.array_distinct(F.transform("__dates", lambda d: F.dayofmonth(d)))).alias("snapshot_days"),
    )


def domain_check(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Rows outside the allowed values; null counts as outside."""
    inside = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~inside).alias("n_outside"),
    ).withColumn("all_inside", F.col("n_outside") == 0)


def bounds_check(
    df: DataFrame, bounds: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """Per column: expected range, found range, violations, PASS / FAIL / ALL NULL / NOT FOUND."""
    found = [c for c in bounds if c in df.columns]
    absent = [c for c in bounds if c not in df.columns]
    value = {c: F.col(c).cast("double") for c in found}
    wide = df.agg(
        F.count("*").alias("n_rows"),
        *[F.min(value[c]).alias(f"actual_min__{i}") for i, c in enumerate(found)],
        *[F.max(value[c]).alias(f"actual_max__{i}") for i, c in enumerate(found)],
        *[
            F.count_if((value[c] < bounds[c][0]) | (value[c] > bounds[c][1])).alias(f"outside_bounds__{i}")
            for i, c in enumerate(found)
        ],
    )
    expected = F.create_map(*[
        x for c, (low, high) in bounds.items()
        for x in (F.lit(c), F.struct(F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high")))
    ])
    rows = _one_row_to_long(wide, found, ["actual_min", "actual_max", "outside_bounds"]).select(
        "column_name", "actual_min", "actual_max", "outside_bounds",
        F.when(F.col("actual_min").isNull(), "ALL NULL")
        .when(F.col("outside_bounds") == 0, "PASS")
        .otherwise("FAIL").alias("status"),
    )
    if absent:
        missing = wide.select(F.explode(F.array(*[F.lit(c) for c in absent])).alias("column_name")).select(
            "column_name",
            F.lit(None).cast("double").alias("actual_min"),
            F.lit(None).cast("double").alias("actual_max"),
            F.lit(0).cast("long").alias("outside_bounds"),
            F.lit("NOT FOUND").alias("status"),
        )
        rows = rows.unionByName(missing)
    return rows.select(
        "column_name",
        F.element_at(expected, F.col("column_name"))["low"].alias("expected_min"),
        F.element_at(expected, F.col("column_name"))["high"].alias("expected_max"),
        "actual_min", "actual_max", "outside_bounds", "status",
    )


def bounds_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(
        F.count_if(F.col("status") == "PASS").alias("n_passed"), F.count("*").alias("n_checked")
    ).withColumn("all_passed", F.col("n_passed") == F.col("n_checked"))


def type_check(
    df: DataFrame, column: str, accepted: Sequence[str], accuracy: int = 10000
) -> DataFrame:
    """One row: found type, verdict, nulls, min, max, mean, approximate median."""
    found = df.schema[column].dataType.typeName()
    status = "PASS" if found in accepted else "FAIL"
    value = F.col(column).try_cast("double")
    nulls = F.count_if(F.col(column).isNull())
    return df.agg(
        F.lit(column).alias("column_name"),
        F.lit(found).alias("found_type"),
        F.lit(status).alias("status"),
        nulls.alias("null_count"),
        (nulls / F.nullif(F.count("*"), F.lit(0)) * 100).alias("null_percent"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
        F.percentile_approx(value, 0.5, accuracy).alias("approx_median"),
    )


def schema_conformance(found: Mapping[str, StructType], expected: StructType, spark) -> DataFrame:
    """Per (partition, column): found and expected type and whether they agree.

    Works on schemas only, so its size is partitions times columns.
    """
    rows = []
    for partition, schema in sorted(found.items()):
        names = {f.name: f.dataType.simpleString() for f in schema.fields}
        for field in expected.fields:
            want = field.dataType.simpleString()
            have = names.get(field.name)
            rows.append((partition, field.name, have, want, have == want))
    return spark.createDataFrame(
        rows, "partition string, column_name string, found_type string, expected_type string, ok boolean"
    )


def null_rate_by_period(df: DataFrame, period: Column, column: str, name: str = "month") -> DataFrame:
    return df.groupBy(period.alias(name)).agg(
        F.round(F.avg(F.when(F.col(column).isNull(), 100.0).otherwise(0.0)), 1).alias("null_percent"),
        F.count("*").alias("n_rows"),
    )


def acceptance(profile: DataFrame, accept_below: float = 10.0) -> DataFrame:
    """PASS below the limit, FAIL when everything is null, PARTIAL in between."""
    return profile.withColumn(
        "verdict",
        F.when(F.col("missing_percent") < accept_below, "PASS")
        .when(F.col("missing_percent") == 100, "FAIL")
        .otherwise("PARTIAL"),
    )


def availability_verdict(rate: DataFrame, pass_below: float = 5.0, fail_above: float = 50.0) -> DataFrame:
    """Verdict on a null rate of columns that should have been filled."""
    return rate.withColumn(
        "verdict",
        F.when(F.col("null_percent") < pass_below, "PASS")
        .when(F.col("null_percent") > fail_above, "FAIL")
        .otherwise("PARTIAL"),
    )


def correlation_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, the full matrix in long form, for any number of columns."""
    return correlations(df, columns)


def high_correlations(
    matrix: DataFrame, columns: Sequence[str], threshold: float = 0.8
) -> DataFrame:
    """Each pair once, in column order, with ``|r|`` above the threshold, largest first."""
    order = F.array(*[F.lit(c) for c in columns])
    return matrix.where(
        (F.array_position(order, F.col("feature_1")) < F.array_position(order, F.col("feature_2")))
        & (F.abs("correlation") > threshold)
    ).orderBy(F.desc("correlation"), "feature_1", "feature_2")


def class_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each value, two decimals."""
    total = df.agg(F.count("*")).scalar()
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    return counted.withColumn("percentage", F.round(F.col("n") / total * 100, 2))
