"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Drops the shuffle files of a job when the job ends.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def query(name: str, oracle: str | None = None):
    """Register a query of this subpackage, with its SQL counterpart if there is one."""

    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


#: Bytes of an Arrow batch.  Two workers share an executor with the JVM, and texts are long.
BATCH_BYTES = 16 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches at ``BATCH_BYTES`` from now on, unless the session asks for less."""
    now = spark.conf.get(_BATCH)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for a registered query."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage without tying it to an executor.  The shuffle files of
    the writing job go when it ends, so the disk holds one stage at a time.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(_FILE_CLEANUP, "false")
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``most_bytes`` a piece."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        per_row = max(1, batch.column(column).nbytes // batch.num_rows)
        step = max(1, most_bytes // per_row)
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def power_of_two(n: int) -> int:
    return 1 << max(0, (n - 1).bit_length())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
