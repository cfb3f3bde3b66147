"""Writing snapshot tables, prediction stores and monitoring results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

# Column types of the prediction store (fixed values; the date is a real date).
PREDICTION_TYPES = {
    "Customer_ID": "string",
    "inference_date": "date",
    "predicted_default": "int",
    "default_probability": "float",
    "risk_category": "string",
}


#: Dates that one write may hold; their rows are counted while they are written.
MAX_DATES = 20_000


def iso_day(day: str | dt.date) -> str:
    """A date, or its text with or without leading zeros, as ``yyyy-mm-dd``."""
    if isinstance(day, dt.datetime):
        return day.date().isoformat()
    if isinstance(day, dt.date):
        return day.isoformat()
    year, month, of_month = day.strip().split("-")
    return dt.date(int(year), int(month), int(of_month)).isoformat()


def _options(fmt: str) -> dict[str, str]:
    """Parquet stores are kept in the smaller of Spark's usual codecs."""
    return {"header": "true"} | ({"compression": "zstd"} if fmt == "parquet" else {})


def write_counted(
    df: DataFrame,
    root: str,
    date: str = "snapshot_date",
    fmt: str = "parquet",
    days: Sequence[str | dt.date] | None = None,
    register: str | None = None,
    clustered: bool = False,
) -> dict[str, int]:
    """Write any number of snapshots; rows per date as they were written.

    Rows are clustered by date first, so each date gets few files; the
    rebalance splits a date that holds most of the rows over several tasks.
    The counts are observed in the tasks that write, so nothing is read again
    and a task that is repeated counts once.

    A date that is written again is replaced.  ``days`` names the dates that
    this write stands for: those of them without rows are empty afterwards, and
    hold one file without rows if they had any before.

    ``clustered`` rows come from files that hold one date each, such as another store of
    the same dates: they are written where they are read, without a shuffle.

    With ``register`` the schema of each date written is added to that table
    (see ``readers.partition_schemas``).
    """
    wanted = [iso_day(x) for x in days or ()]
    spark = df.sparkSession
    seen = Observation()
    # One bin a date: exact as long as there are fewer dates than bins.
    per_date = F.histogram_numeric(F.unix_date(F.col(date).cast("date")), F.lit(MAX_DATES))
    rows = df if clustered else df.hint("rebalance", F.col(date))
    (
        rows
        .observe(seen, per_date.alias("dates"))
        .write.partitionBy(date)
        .option("partitionOverwriteMode", "dynamic")
        .options(**_options(fmt))
        .mode("overwrite")
        .format(fmt)
        .save(root)
    )
    bins = seen.get["dates"] or []
    if len(bins) >= MAX_DATES:
        raise ValueError(f"more than {MAX_DATES} dates in one write")
    counts = {(_EPOCH + dt.timedelta(days=int(x["x"]))).isoformat(): int(x["y"]) for x in bins}
    written = sorted(counts)
    gone = [x for x in wanted if x not in counts]
    if gone:
        # What is left of these dates is from earlier writes; the filter reads their folders only.
        stored = spark.read.format(fmt).option("header", True).schema(df.schema).load(root).where(F.col(date).isin(*[F.lit(x).cast("date") for x in gone]))
        empty = spark.createDataFrame([], df.drop(date).schema)
        for day in (r[0].isoformat() for r in stored.select(F.col(date).cast("date")).distinct().collect()):
            empty.write.options(**_options(fmt)).mode("overwrite").format(fmt).save(f"{root.rstrip('/')}/{date}={day}")
            written.append(day)
        counts.update(dict.fromkeys(gone, 0))
    if register is not None:
        register_schemas(spark, register, root, date, df.schema, written)
    return counts


_EPOCH = dt.date(1970, 1, 1)


def register_schemas(spark: SparkSession, register: str, root: str, date: str, schema: StructType, days: Sequence[str]) -> None:
    """Add a row per partition folder: its path, its schema as JSON, and when it was written."""
    # Columns of a file may be null, whatever the frame knew of them.
    fields = [StructField(f.name, f.dataType) for f in schema.fields if f.name != date] + [StructField(date, DateType())]
    text = StructType(fields).json()
    rows = spark.createDataFrame([(x,) for x in days], "day string").select(
        F.format_string(f"{root.rstrip('/')}/{date}=%s", "day").alias("folder"),
        F.lit(text).alias("schema"), F.current_timestamp().alias("written_at"))
    rows.repartition(1).write.mode("append").parquet(register)


def write_snapshots(
    df: DataFrame, root: str, date: str = "snapshot_date", fmt: str = "parquet",
    days: Sequence[str | dt.date] | None = None, register: str | None = None, clustered: bool = False,
) -> str:
    """``write_counted``, returning the store."""
    write_counted(df, root, date, fmt, days, register, clustered)
    return root


def write_predictions(df: DataFrame, root: str, days: Sequence[str | dt.date] | None = None) -> str:
    """The prediction store: fixed column types, one partition per inference date."""
    typed = df.select(*[F.col(c).cast(t).alias(c) for c, t in PREDICTION_TYPES.items()])
    return write_snapshots(typed, root, date="inference_date", days=days)


def write_predictions_csv(df: DataFrame, path: str) -> str:
    df.select(*PREDICTION_TYPES).write.option("header", True).mode("overwrite").csv(path)
    return path


def write_run_result(df: DataFrame, root: str, run_ts: str) -> str:
    """Append one run's result table under its own ``run_ts`` partition.

    The tables hold a row per period or less, so one file is enough; the
    repartition keeps the work above it parallel.
    """
    (
        df.withColumn("run_ts", F.lit(run_ts))
        .repartition(1)
        .write.partitionBy("run_ts")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(root)
    )
    return root


def write_summary(df: DataFrame, path: str) -> str:
    """The one-row summary document as JSON."""
    df.repartition(1).write.mode("overwrite").json(path)
    return path


def write_table_csv(df: DataFrame, path: str) -> str:
    """A report table (importances, PSI, statistics) as CSV, in as few files as its size asks for."""
    df.hint("rebalance").write.option("header", True).mode("overwrite").csv(path)
    return path
