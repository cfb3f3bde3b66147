"""Model data: temporal split, imputation, encoding, scaling, class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.ordering import numbered_in_strata
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.stability import unpivot_numeric
from tidemark.session import cut_lineage

UNKNOWN = "Unknown"


def split_dates(
    df: DataFrame, date: str, train_ratio: float = 0.70, val_ratio: float = 0.15
) -> DataFrame:
    """One row per distinct date with its split: train, val, test, and oot for the last."""
    dates = df.where(F.col(date).isNotNull()).select(date).distinct()
    # One row per snapshot date.
    ordinal = F.row_number().over(Window.orderBy(date)) - 1
    others = F.count("*").over(Window.partitionBy()) - 1
    return dates.select(date, ordinal.alias("__i"), others.alias("__n")).select(
        date,
        F.when(F.col("__i") == F.col("__n"), "oot")
        .when(F.col("__i") < F.floor(F.col("__n") * F.lit(train_ratio)), "train")
        .when(F.col("__i") < F.floor(F.col("__n") * F.lit(train_ratio + val_ratio)), "val")
        .otherwise("test")
        .alias("split"),
    )


def temporal_split(
    df: DataFrame, date: str, train_ratio: float = 0.70, val_ratio: float = 0.15
) -> DataFrame:
    """Add ``split`` to every row.  The date table has one row per snapshot date."""
    return df.join(F.broadcast(split_dates(df, date, train_ratio, val_ratio)), date)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: count, balanced weight ``n / (k * n_c)``, and the negative/positive ratio."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    # One row per class from here on.
    every = Window.partitionBy()
    total, classes = F.sum("n").over(every), F.count("*").over(every)
    negatives = F.sum(F.when(F.col(label) == 0, F.col("n"))).over(every)
    positives = F.sum(F.when(F.col(label) == 1, F.col("n"))).over(every)
    return counted.select(
        label,
        "n",
        (total / (classes * F.col("n"))).alias("balanced_weight"),
        (negatives / positives).alias("scale_pos_weight"),
    )


def fit_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column, ``(column_name, median)``."""
    long = unpivot_numeric(train, [], columns, "column_name")
    return exact_quantiles(long, ["column_name"], F.col("value"), [0.5]).select(
        "column_name", F.col("q_0").alias("median")
    )


def as_struct(params: DataFrame, value: str, columns: Sequence[str]) -> Column:
    """A ``(column_name, value)`` table as one scalar struct with a field per column.

    Spark evaluates it once and places the constants into the plan of the
    rows, so applying fitted parameters needs no join.
    """
    wide = params.agg(
        F.struct(*[
            F.max(F.when(F.col("column_name") == c, F.col(value))).alias(c) for c in columns
        ]).alias("s")
    )
    return wide.scalar()


def impute_medians(df: DataFrame, medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    fitted = as_struct(medians, "median", columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), fitted[c]) for c in columns})


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population std per column; a zero std becomes 1."""
    long = unpivot_numeric(train, [], columns, "column_name")
    std = F.stddev_pop("value")
    return long.groupBy("column_name").agg(
        F.avg("value").alias("mean"), F.when(std == 0, F.lit(1.0)).otherwise(std).alias("std")
    )


def scale(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    mean, std = as_struct(scaler, "mean", columns), as_struct(scaler, "std", columns)
    return df.withColumns({c: (F.col(c).cast("double") - mean[c]) / std[c] for c in columns})


def fit_encoder(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes of the sorted distinct values, null as ``Unknown``.

    ``(column_name, value, code)``.  Pass the training rows, or all rows for
    the variant that knows every category.  Spark samples the distinct values
    for range bounds, so a vocabulary of any size, however alike its values
    begin, is sorted in even parts; a value's code is its place in its part plus
    what the parts before hold.  The numbered values are stored.
    """
    values = (
        df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .distinct()
    )
    order = ["column_name", "value"]
    # The id's upper bits are the partition, its lower 33 bits the place in it.
    numbered = cut_lineage(
        values.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()),
        "encoder",
    ).withColumn("__part", F.shiftrightunsigned("__id", 33))
    # A row per column and partition.
    parts = numbered.groupBy("column_name", "__part").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("column_name").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "column_name", "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    return numbered.join(offsets, ["column_name", "__part"]).select(
        "column_name", "value", (F.col("__id") + F.col("__shift")).cast("int").alias("code")
    )


def encode(
    df: DataFrame, encoder: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None, seen: DataFrame | None = None
) -> DataFrame:
    """Categories as codes, in place or as the columns ``names``.

    A value unseen in fitting takes the code of ``Unknown``, or one past the
    last code where training had no unknowns.  Pass a stored encoder: each
    column reads it.

    Codes are looked up for the distinct combinations of the columns; the rows
    themselves are joined once, with the combinations, however many columns there are.
    ``seen`` is a table with the same combinations, if ``df`` takes work to evaluate.
    """
    if not columns:
        return df
    names = list(names or columns)
    asked = [f"__value_{i}" for i in range(len(columns))]
    texts = {a: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for a, c in zip(asked, columns)}
    valued = df.withColumns(texts)
    combinations = (df if seen is None else seen).select(*[c.alias(a) for a, c in texts.items()]).distinct()
    for i, c in enumerate(columns):
        own = encoder.where(F.col("column_name") == c)
        fallback = own.agg(
            F.coalesce(F.max(F.when(F.col("value") == UNKNOWN, F.col("code"))), F.max("code") + 1)
        ).scalar()
        codes = own.select(F.col("value").alias(asked[i]), F.col("code").alias(f"__code_{i}"))
        combinations = combinations.join(codes, asked[i], "left").withColumn(
            f"__code_{i}", F.coalesce(F.col(f"__code_{i}"), fallback))
    # Stored, so that their size is known before the rows are shuffled for the join.
    out = valued.join(cut_lineage(combinations, "encoder-combinations"), asked, "left")
    out = out.withColumns({n: F.col(f"__code_{i}") for i, n in enumerate(names)})
    kept = df.columns + [n for n in names if n not in df.columns]
    return out.select(*[F.col(f"`{c}`") for c in kept])


def feature_matrix(
    df: DataFrame, keep: Sequence[str], numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Keys, then the numeric and the categorical features in fixed order."""
    return df.select(*keep, *numeric, *categorical)


def category_vocabulary(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct values of a category over several splits, null as ``Unknown``."""
    out = None
    for frame in frames:
        values = frame.select(F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN)).alias("value"))
        out = values if out is None else out.unionByName(values)
    return out.distinct()


def cumulative_importance(importance: DataFrame, cutoff: float = 0.80) -> DataFrame:
    """Running share of importance, with a flag for the features up to the cutoff.

    One row per feature comes in.
    """
    order = Window.orderBy(F.desc("importance"), "feature").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.sum("importance").over(Window.partitionBy())
    ranked = importance.select(
        "feature",
        "importance",
        F.row_number().over(Window.orderBy(F.desc("importance"), "feature")).alias("position"),
        (F.sum("importance").over(order) / total).alias("cumulative_importance"),
    )
    return ranked.withColumn("within_cutoff", F.col("cumulative_importance") <= cutoff)


def stratified_folds(
    df: DataFrame, label: str, key: Sequence[str], folds: int = 3, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Folds of equal class mix: per class, rows in the order of their key's hash take turns.

    Fold sizes of a class differ by one at most.  A key that is unique per row gives the same
    folds whenever it is evaluated; rows that share one are lined up in one task.
    """
    shuffled = F.xxhash64(F.lit(seed), *[F.col(c) for c in key])
    numbered = numbered_in_strata(df, label, shuffled, "__number")
    return numbered.withColumn(name, F.pmod("__number", F.lit(folds)).cast("int")).drop("__number")
