"""Exact quantiles per key from sketch brackets.

A first pass makes one quantile sketch per key (Spark's KLL aggregate, combined on
the map side) and reads from it, for each wanted rank, two values that enclose it but
for a small chance.  A second pass counts exactly: rows outside all brackets by the
brackets they lie below, rows inside one by their value.  The wanted ranks are then looked
up among the few values inside.

The sketch is never trusted: exact counts tell whether a bracket holds its rank, and one that
does not is opened on the side where the rank lies and counted again.  Brackets of keys with
so many rows that the values inside are still many are narrowed first, by sketches of the
rows inside them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import cut_lineage

#: Size parameter of a sketch, and ranks that are read from it.
SKETCH, GRID = 1000, 512
#: Twice the rank error that the sketch keeps in 99 of 100 cases (a fixed formula of its authors).
SLACK = 2 * 2.296 / SKETCH**0.9723
#: Rows in a bracket that are counted value by value.
WITHIN = 4_000_000

_V, _LOW, _HIGH, _N = "__v", "__low", "__high", "__n"


def _enclosing(sketch: Column, rank: Column, slack: float) -> tuple[Column, Column]:
    """Two values that enclose a rank from 0 to 1."""
    grid = F.kll_sketch_get_quantile_double(sketch, F.lit([i / GRID for i in range(GRID + 1)]))
    below = F.floor((rank - slack) * GRID).cast("int")
    above = F.ceil((rank + slack) * GRID).cast("int")
    return (
        F.when(below <= 0, F.lit(float("-inf"))).otherwise(F.get(grid, below)),
        F.when(above >= GRID, F.lit(float("inf"))).otherwise(F.get(grid, above)),
    )


def _position(p: float, n: Column) -> Column:
    """Zero-based place in the sorted values; a fraction lies between two ranks."""
    return F.lit(float(p)) * (n - 1)


def _inside(i: int) -> Column:
    return (F.col(_V) >= F.col(_LOW)[i]) & (F.col(_V) <= F.col(_HIGH)[i])


def _narrowed(rows: DataFrame, brackets: DataFrame, keys: Sequence[str], probs: Sequence[float], slack: float) -> DataFrame:
    """Each bracket cut down by a sketch of the rows inside it; a side that lost its rank is opened."""
    each = range(len(probs))
    counted = rows.join(brackets, list(keys)).groupBy(*keys).agg(
        F.first(_N).alias(_N), F.first(_LOW).alias(_LOW), F.first(_HIGH).alias(_HIGH),
        *[F.count_if(F.col(_V) < F.col(_LOW)[i]).alias(f"__below_{i}") for i in each],
        *[F.count_if(_inside(i)).alias(f"__in_{i}") for i in each],
        *[F.kll_sketch_agg_double(F.when(_inside(i), F.col(_V)), SKETCH).alias(f"__sketch_{i}") for i in each],
    )
    low, high, held = [], [], []
    for i, p in enumerate(probs):
        place, below, inside = _position(p, F.col(_N)), F.col(f"__below_{i}"), F.col(f"__in_{i}")
        early, late = F.floor(place) < below, F.ceil(place) >= below + inside
        a, b = _enclosing(F.col(f"__sketch_{i}"), (place - below) / inside, slack)
        # The brackets' own ends stay valid ends.
        low.append(F.when(early, F.lit(float("-inf"))).when(late, F.col(_LOW)[i]).otherwise(F.greatest(F.col(_LOW)[i], a)))
        high.append(F.when(late, F.lit(float("inf"))).when(early, F.col(_HIGH)[i]).otherwise(F.least(F.col(_HIGH)[i], b)))
        held.append(F.when(early | late, F.col(_N)).otherwise(F.ceil(inside * (2 * slack + 2 / GRID))))
    return counted.select(*keys, _N, F.array(*low).alias(_LOW), F.array(*high).alias(_HIGH), F.array_max(F.array(*held)).alias("__held"))


def _ranked(rows: DataFrame, brackets: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Per key: ``q_<i>`` or null where the bracket does not hold its rank, and the ends for another try."""
    each = range(len(probs))
    inside = reduce(lambda a, b: a | b, [_inside(i) for i in each])
    below = reduce(lambda a, b: a + b, [F.when(F.col(_V) < F.col(_LOW)[i], 1 << i).otherwise(0) for i in each])
    # The brackets are joined again, since arrays among the aggregates would have all rows sorted.
    counts = (
        rows.join(brackets, list(keys))
        .groupBy(*keys, F.when(inside, F.col(_V)).alias("__x"), F.when(~inside, below).alias("__mask"))
        .agg(F.count("*").alias("__rows"))
        .join(brackets, list(keys))
    )
    whole = Window.partitionBy(*keys)
    # Nulls first: rows outside all brackets come before the values and don't count among them.
    upto = whole.orderBy(F.asc_nulls_first("__x")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = F.when(F.col("__x").isNotNull(), F.col("__rows")).otherwise(0)
    placed = counts.withColumns({
        "__end": F.sum(inner).over(upto),
        **{f"__out_{i}": F.sum(F.when(F.col("__mask").bitwiseAND(F.lit(1 << i)) > 0, F.col("__rows")).otherwise(0)).over(whole) for i in each},
    })
    out = []
    for i, p in enumerate(probs):
        place = _position(p, F.col(_N))
        x, end = F.col("__x"), F.col(f"__out_{i}") + F.col("__end")
        own = (x >= F.col(_LOW)[i]) & (x <= F.col(_HIGH)[i])
        at = lambda rank: F.max(F.when(own & (rank >= end - F.col("__rows")) & (rank < end), x))  # noqa: B023, E731
        low, high = at(F.floor(place)), at(F.ceil(place))
        # Equal ends need no step between them, which infinite ones would not have.
        out.append(F.when(low == high, low).otherwise(low + (high - low) * F.max(place - F.floor(place))).alias(f"q_{i}"))
        out.append((low.isNotNull() & high.isNotNull()).alias(f"__hit_{i}"))
        first = F.min(F.when(own, end - F.col("__rows")))
        out.append(F.coalesce(F.max(F.floor(place)) < first, F.lit(True)).alias(f"__early_{i}"))
        last = F.max(F.when(own, end))
        out.append(F.coalesce(F.max(F.ceil(place)) >= last, F.lit(True)).alias(f"__late_{i}"))
    return placed.groupBy(*keys).agg(F.first(_N).alias(_N), F.first(_LOW).alias(_LOW), F.first(_HIGH).alias(_HIGH), *out)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probs: Sequence[float],
    also: Mapping[str, Column] | None = None,
    slack: float = SLACK,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column ``q_<i>`` per prob.

    Null and NaN are left out, and so are keys without any value or with a null in the
    key.  ``also`` names aggregates of all rows of a key that the first pass takes along
    (``value`` may be used in them); with it a key without values is kept, its quantiles null.

    Starts jobs: the brackets and the counts are stored, a row per key and a row per
    value inside a bracket.
    """
    keys, also = list(keys), dict(also or {})
    v = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    sketched = df.select("*", v.alias(_V)).groupBy(*keys).agg(
        F.kll_sketch_agg_double(_V, SKETCH).alias("__sketch"), F.count(_V).alias(_N),
        *[c.alias(f"__also_{name}") for name, c in also.items()],
    )
    ends = [_enclosing(F.col("__sketch"), F.lit(float(p)) * (F.col(_N) - 1) / F.col(_N), slack + 1 / GRID) for p in probs]
    first = cut_lineage(sketched.select(
        *keys, _N, *[f"__also_{name}" for name in also],
        # An empty sketch has no ranks.
        F.when(F.col(_N) > 0, F.array(*[a for a, _ in ends])).alias(_LOW),
        F.when(F.col(_N) > 0, F.array(*[b for _, b in ends])).alias(_HIGH),
        F.ceil(F.col(_N) * (2 * slack + 4 / GRID)).alias("__held"),
    ), "quantile-brackets")
    brackets = first.where(F.col(_N) > 0).select(*keys, _N, _LOW, _HIGH, "__held")
    rows = df.select(*keys, v.alias(_V)).where(F.col(_V).isNotNull())
    while (brackets.agg(F.max("__held")).first()[0] or 0) > WITHIN:
        brackets = cut_lineage(_narrowed(rows, brackets, keys, probs, slack), "quantile-brackets")
    brackets = brackets.drop("__held")

    columns = [f"q_{i}" for i in range(len(probs))]
    parts = []
    while True:
        ranked = cut_lineage(_ranked(rows, brackets, keys, probs), "quantiles")
        hit = reduce(lambda a, b: a & b, [F.col(f"__hit_{i}") for i in range(len(probs))])
        parts.append(ranked.where(hit).select(*keys, *columns))
        missed = ranked.where(~hit)
        if missed.isEmpty():
            break
        open_ = lambda end, side, value: F.array(*[
            F.when(F.col(f"__{side}_{i}"), F.lit(value)).otherwise(F.col(end)[i]) for i in range(len(probs))])
        brackets = missed.select(*keys, _N, open_(_LOW, "early", float("-inf")).alias(_LOW), open_(_HIGH, "late", float("inf")).alias(_HIGH))
    found = reduce(lambda a, b: a.unionByName(b), parts)
    if not also:
        return found
    return first.select(*keys, *[F.col(f"__also_{name}").alias(name) for name in also]).join(found, keys, "left")
