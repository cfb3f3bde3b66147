"""Query registry and result presentation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, ShortType, TimestampNTZType, TimestampType,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its counterpart."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def present(df: DataFrame, digits: int = 6, as_double: Sequence[str] = ()) -> DataFrame:
    """Engine-neutral result: rounded doubles, dates as text, longs for ints.

    ``as_double`` names integer columns that may be null.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType, DecimalType)) or f.name in as_double:
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)
