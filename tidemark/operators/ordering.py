"""Exact order statistics without putting one key's rows into one task.

A window over all rows of a period, or the built-in exact ``percentile``,
brings a whole period into a single task.  Here values are first counted per
distinct value.  A fixed grid of relative width splits them into coarse
buckets; each of those is split by a grid between its own least and greatest
value, as fine as its number of values asks for, and each of the parts once
more.  Values are ordered inside the narrowest buckets, and from there on only
bucket totals are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.bins import coarse_bucket, own_bucket

_COARSE, _FINE, _FINEST, _VALUE = "__coarse", "__fine", "__finest", "__value"


def _upto(group: Sequence[str], order: str, descending: bool = False):
    """Rows of the group up to and including the current one."""
    by = F.desc(order) if descending else F.asc(order)
    return Window.partitionBy(*group).orderBy(by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )


def _before(group: Sequence[str], order: str, descending: bool = False):
    by = F.desc(order) if descending else F.asc(order)
    return Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)


def levels(keys: Sequence[str]) -> list[tuple[list[str], str]]:
    """From the narrowest to the widest: the group and what is ordered in it."""
    return [
        ([*keys, _COARSE, _FINE, _FINEST], _VALUE),
        ([*keys, _COARSE, _FINE], _FINEST),
        ([*keys, _COARSE], _FINE),
        ([*keys], _COARSE),
    ]


def _split(counts: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Add bucket ``name`` inside ``group``, by the least and greatest value and the number of values there.

    The bounds have a row per bucket, so the adaptive plan sends them to the
    counts instead of shuffling those.
    """
    bounds = counts.groupBy(*[F.col(c).alias(f"__of_{c}") for c in group]).agg(
        F.min(_VALUE).alias("__low"), F.max(_VALUE).alias("__high"), F.count("*").alias("__size")
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in group])
    placed = own_bucket(F.col(_VALUE), F.col("__low"), F.col("__high"), F.col("__size"))
    return counts.join(bounds, same).select(*counts.columns, placed.alias(name))


def _bucketed(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _split(_split(counts, [*keys, _COARSE], _FINE), [*keys, _COARSE, _FINE], _FINEST)


def value_counts_ordered(
    df: DataFrame, keys: Sequence[str], value: Column, sums: dict[str, Column], keep_missing: bool = False
) -> DataFrame:
    """One row per key and distinct value, with its buckets and the given sums.

    Map-side combining makes a value shared by a third of all rows one row
    per task before the shuffle.  Rows without a value (null or NaN) are left
    out, or make up a bucket of their own with ``keep_missing``.
    """
    v = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    rows = df if keep_missing else df.where(v.isNotNull())
    counts = (
        rows.groupBy(*keys, coarse_bucket(v).alias(_COARSE), v.alias(_VALUE))
        .agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    )
    return _bucketed(counts, keys)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    sums: dict[str, Column],
    descending: bool = False,
) -> DataFrame:
    """Cumulative sums over the distinct values of each key.

    Returns the keys, ``value``, every sum, its running total ``cum_<name>``
    including the row itself, and the key's total ``total_<name>``.
    """
    keys = list(keys)
    counts = value_counts_ordered(df, keys, value, sums)
    narrowest, *wider = levels(keys)
    total = lambda table, group: table.groupBy(*group).agg(*[F.sum(n).alias(n) for n in sums])
    rows = counts.select(
        "*", *[F.sum(n).over(_upto(*narrowest, descending)).alias(f"cum_{n}") for n in sums]
    )
    # Per level: what stands before each bucket inside the next wider one.
    offsets, table, group = None, counts, narrowest[0]
    steps = []
    for outer, order in wider:
        table = total(table, group)
        steps.append((group, table.select(
            *group,
            *[F.coalesce(F.sum(n).over(_before(outer, order, descending)), F.lit(0)).alias(f"__off_{n}") for n in sums],
            *([F.sum(n).over(Window.partitionBy(*keys)).alias(f"total_{n}") for n in sums] if outer == keys else []),
        )))
        group = outer
    # From the widest level down, offsets add up.
    for group, step in reversed(steps):
        if offsets is None:
            offsets, above = step, group
            continue
        wide = offsets.select(*above, *[F.col(f"__off_{n}").alias(f"__up_{n}") for n in sums], *[f"total_{n}" for n in sums])
        offsets = step.join(wide, on=above).select(
            *group, *[(F.col(f"__off_{n}") + F.col(f"__up_{n}")).alias(f"__off_{n}") for n in sums], *[f"total_{n}" for n in sums]
        )
        above = group
    return rows.join(offsets, on=narrowest[0]).select(
        *keys,
        F.col(_VALUE).alias("value"),
        *sums,
        *[(F.col(f"cum_{n}") + F.col(f"__off_{n}")).alias(f"cum_{n}") for n in sums],
        *[f"total_{n}" for n in sums],
    )


def numbered_in_strata(
    df: DataFrame,
    stratum: str,
    order_hash: Column,
    name: str,
    buckets: int = 4096,
) -> DataFrame:
    """Add a zero-based number per stratum in the order of a hash.

    Hashes are dealt over ``buckets``, so a stratum that holds most rows is numbered by
    many tasks: a row's number is its place in its bucket plus what the buckets before
    hold.  Rows are shuffled once, and the bucket totals join them where they are.  Rows with the
    same hash take numbers one by one, without a gap; rows without a stratum are left out.
    """
    bucket = "__bucket"
    tagged = df.where(F.col(stratum).isNotNull()).withColumn("__h", order_hash)
    tagged = tagged.withColumn(bucket, F.pmod("__h", F.lit(buckets)))
    offsets = tagged.groupBy(stratum, bucket).agg(F.count("*").alias("__n")).select(
        stratum, bucket, F.coalesce(F.sum("__n").over(_before([stratum], bucket)), F.lit(0)).alias("__off")
    )
    place = F.row_number().over(Window.partitionBy(stratum, bucket).orderBy("__h")) - 1
    placed = tagged.withColumn("__place", place).join(offsets, on=[stratum, bucket])
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__off") + F.col("__place")).alias(name))
