"""Correlation of many columns from mergeable co-moments.

One pass over the rows: a task keeps, for every pair of columns, the count, the two
means and the three central sums over the rows where both have a value, and sends them by
pairs of column blocks.  These partial results are merged pairwise in rounds of
``FAN`` tasks, so no task holds those of all.  The plan has the same size for any
number of columns.

The task's part is matrix products over Arrow batches, the one place of the operators
outside the training-data subpackage that leaves the JVM: as aggregate expressions, a
thousand columns would be half a million of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.session import cut_lineage

#: Columns of a block, and partial results that are merged at a time.
BLOCK, FAN = 64, 32
_PARTS = ("n", "mean_a", "mean_b", "square_a", "square_b", "product")
SCHEMA = "task long, block_a int, block_b int, " + ", ".join(f"{p} array<double>" for p in _PARTS)


class _Sums:
    """Sums over pairs of columns around a shift that the first values give."""

    def __init__(self, k: int):
        self.shift: np.ndarray | None = None
        self.n, self.x, self.xx, self.xy = np.zeros((4, k, k))

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        if self.shift is None:
            count = np.maximum(known.sum(axis=0), 1)
            self.shift = np.where(known, values, 0.0).sum(axis=0) / count
        x, m = np.where(known, values - self.shift, 0.0), known.astype(float)
        self.n += m.T @ m
        self.x += x.T @ m
        self.xx += (x * x).T @ m
        self.xy += x.T @ x

    def moments(self) -> dict[str, np.ndarray]:
        n = np.maximum(self.n, 1)
        square = self.xx - self.x * self.x / n
        return {
            "n": self.n,
            "mean_a": self.shift[:, None] + self.x / n, "mean_b": self.shift[None, :] + self.x.T / n,
            "square_a": square, "square_b": square.T,
            "product": self.xy - self.x * self.x.T / n,
        }


def _partial(columns: Sequence[str]):
    k = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k)
        for batch in batches:
            if batch.num_rows:
                raw = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                sums.add(raw, ~np.isnan(raw))
        if sums.shift is None:
            return
        whole = sums.moments()
        task = TaskContext.get().partitionId()
        for a in range(0, k, BLOCK):
            for b in range(a, k, BLOCK):
                yield pa.RecordBatch.from_pydict({
                    "task": pa.array([task], pa.int64()),
                    "block_a": pa.array([a // BLOCK], pa.int32()), "block_b": pa.array([b // BLOCK], pa.int32()),
                    **{p: pa.array([whole[p][a : a + BLOCK, b : b + BLOCK].ravel()], pa.list_(pa.float64())) for p in _PARTS}})

    return run


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial results of one pair of blocks combined around their common means."""
    parts = {p: np.stack(rows[p].to_numpy()) for p in _PARTS}
    n = parts["n"]
    total = n.sum(axis=0)
    out = {"n": total}
    for s in "ab":
        out[f"mean_{s}"] = (n * parts[f"mean_{s}"]).sum(axis=0) / np.maximum(total, 1)
        gap = parts[f"mean_{s}"] - out[f"mean_{s}"]
        out[f"square_{s}"] = (parts[f"square_{s}"] + n * gap * gap).sum(axis=0)
        parts[f"gap_{s}"] = gap
    out["product"] = (parts["product"] + n * parts["gap_a"] * parts["gap_b"]).sum(axis=0)
    keys = {c: [rows[c].iloc[0]] for c in ("task", "block_a", "block_b")}
    return pd.DataFrame({**keys, **{p: [out[p]] for p in _PARTS}})


def comoments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row per pair of column blocks (the second not before the first), each field a block matrix by rows."""
    doubles = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = cut_lineage(doubles.mapInArrow(_partial(columns), SCHEMA), "comoments")
    last = parts.agg(F.max("task")).first()[0] or 0
    while True:
        last //= FAN
        parts = parts.withColumn("task", F.expr(f"task div {FAN}"))
        parts = parts.groupBy("task", "block_a", "block_b").applyInPandas(_merged, SCHEMA)
        if last == 0:
            return parts


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature_1, feature_2, correlation)``: pairwise-complete Pearson, the full matrix.

    Null and NaN are missing.  A pair without spread in one of its columns has none; the diagonal is 1
    for a column that varies.
    """
    names = F.array(*[F.lit(c) for c in columns])
    fields = F.arrays_zip(*[F.col(p) for p in _PARTS])
    # Blocks of the last columns are narrower.
    width = F.least(F.lit(BLOCK), F.lit(len(columns)) - F.col("block_b") * BLOCK)
    cells = comoments(df, columns).select("block_a", "block_b", width.alias("w"), F.posexplode(fields).alias("at", "m")).select(
        (F.col("block_a") * BLOCK + F.expr("at div w")).cast("int").alias("i"),
        (F.col("block_b") * BLOCK + F.expr("at % w")).cast("int").alias("j"), "m.*")
    spread = F.sqrt("square_a") * F.sqrt("square_b")
    # A constant column is left with rounding errors of some units in the last place.
    varies = lambda s: F.col(f"square_{s}") > F.lit(1e-28) * F.col("n") * F.col(f"mean_{s}") * F.col(f"mean_{s}")
    r = F.when((F.col("n") > 0) & varies("a") & varies("b"), F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(F.col("product"), spread)))))
    upper = cells.where("i <= j").select("i", "j", r.alias("correlation"))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return upper.select(F.explode(both).alias("e"), "correlation").select(
        F.get(names, F.col("e.i")).alias("feature_1"), F.get(names, F.col("e.j")).alias("feature_2"), "correlation")
