"""Exact dedup by content sort.

Sampled splitters deal rows over range partitions by (first characters,
digest of the normalised text, id); each partition is sorted on disk if need
be, which places equal texts next to each other, and neighbours are compared in
full.  The id is part of the sort key, so a group of copies of any size is dealt
over several partitions; the runs at partition edges are joined up afterwards.

Normalised means A-Z in lower case.  Null texts count as empty.  Of equal texts
the row with the largest id stays; null ids count as smallest; of rows that also
share the id one row stays.  Extra columns of any name pass through
``keep_one``; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark.llm.common import as_bytes, query, stored, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of the text that lead the sort key; the digest decides behind them.
LEAD = 16


@F.arrow_udf(BinaryType())
def _digest(text: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t.lower()).digest() for t in as_bytes(text)], pa.binary())


def _content_sorted(df: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with id and text, range-partitioned and sorted by content, larger ids first; ``without`` some columns."""
    keys = [F.col("lead"), F.col("digest"), F.col("id").desc_nulls_last()]
    return (
        df.withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("digest", _digest("text"))
        .withColumn("lead", F.translate(F.substring("text", 1, LEAD), _UPPER, _LOWER))
        .drop(*without)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("lead")
    )


class _Neighbours:
    """Numbers the runs of equal texts in sorted rows.

    Rows of one digest stand together.  Within them texts are compared in full,
    so two texts that share a digest are told apart.
    """

    def __init__(self) -> None:
        self.base = TaskContext.get().partitionId() << 40
        self.n = -1
        self.digest: bytes | None = None
        self.texts: list[tuple[bytes, int]] = []

    def run_of(self, digest: bytes, text: bytes) -> tuple[int, bool, bool]:
        """(run, first row of the run, first row of the digest)"""
        fresh = digest != self.digest
        if fresh:
            self.digest, self.texts = digest, []
        for seen, run in self.texts:
            if seen == text:
                return run, False, fresh
        self.n += 1
        run = self.base + self.n
        self.texts.append((text, run))
        return run, True, fresh


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document; runs of the first and the last digest of a partition are open."""
    schema = pa.schema([("run", pa.int64()), ("id", pa.int64()), ("head", pa.int64()), ("first", pa.bool_()), ("n", pa.int64()),
                        ("open", pa.bool_()), ("digest", pa.binary()), ("text", pa.string())])
    near = _Neighbours()
    out: list[tuple] = []
    runs: dict[int, list] = {}
    edge = True

    def close(is_open: bool) -> None:
        for run, (ids, digest, text) in runs.items():
            for k, i in enumerate(ids):
                out.append((run, i, ids[0], k == 0, len(ids), is_open, digest, text.decode() if is_open and k == 0 else None))
        runs.clear()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return batch

    for batch in batches:
        for i, digest, text in zip(batch.column("id").to_pylist(), batch.column("digest").to_pylist(), as_bytes(batch.column("text"))):
            text = text.lower()
            run, first, fresh = near.run_of(digest, text)
            if fresh and runs:
                close(edge)
                edge = False
            if first:
                runs[run] = ([], digest, text)
            runs[run][0].append(i)
        if out:
            yield flush()
    close(True)
    if out:
        yield flush()


def decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, keep_id, group_size, kept, digest (binary)."""
    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(
        _content_sorted(slim).mapInArrow(
            _decide, "run long, id long, head long, first boolean, n long, open boolean, digest binary, text string"),
        "exact-dedup")
    same = Window.partitionBy("digest", "text")
    ends = (
        rows.filter("open AND first")  # a few rows a partition
        .select(F.col("run").alias("r"),
                F.sum("n").over(same).alias("size"),
                F.max(F.struct("head", (-F.col("run")).alias("r"))).over(same).alias("best"))
    )
    ends = stored(ends, "exact-dedup-ends")
    return (
        rows.join(ends, F.col("open") & (F.col("run") == F.col("r")), "left")
        .select("id",
                F.when(F.col("open"), F.col("best.head")).otherwise(F.col("head")).alias("keep_id"),
                F.when(F.col("open"), F.col("size")).otherwise(F.col("n")).alias("group_size"),
                (F.col("first") & (~F.col("open") | (F.col("best.r") == -F.col("run")))).alias("kept"),
                "digest")
    )


def _heads(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = _Neighbours()
        for batch in batches:
            texts = as_bytes(batch.column("row").field(text_col))
            found = [near.run_of(d, t.lower()) for d, t in zip(batch.column("digest").to_pylist(), texts)]
            mask = pa.array([first for _, first, _ in found], pa.bool_())
            yield batch.select(["row", "digest"]).append_column("run", pa.array([r for r, _, _ in found], pa.int64())).filter(mask)

    return run


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = _content_sorted(packed, ("text",))  # the row holds it
    out = F.col("row")
    schema = f"row {packed.schema['row'].dataType.simpleString()}, digest binary, run long"
    heads = stored(ordered.mapInArrow(_heads(text_col), schema), "exact-dedup-heads")
    # Heads that share a digest: a run cut by a partition edge, or two texts with one digest.
    twice = heads.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    norm = F.translate(F.coalesce(out[text_col], F.lit("")), _UPPER, _LOWER)
    best = Window.partitionBy("digest", "norm").orderBy(F.col("id").desc_nulls_last(), "run")
    losers = (
        heads.select("digest", "run", out[id_col].cast("long").alias("id"), norm.alias("norm"))
        .join(twice, "digest", "left_semi")
        .withColumn("place", F.row_number().over(best)).filter("place > 1").select("run")
    )
    losers = stored(losers, "exact-dedup-losers")
    return heads.join(losers, "run", "left_anti").select("row.*")


@query("op10_exact_dedup", """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t""")
def op10_exact_dedup(spark, sf_dir):
    """Every document with the copy that stays."""
    docs = table(spark, sf_dir, "documents")
    return decisions(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
