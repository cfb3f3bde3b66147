"""Reading snapshot tables: CSV text, parquet snapshots, drifting schemas."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, NumericType, StringType, StructField, StructType

from tidemark.functions.numbers import lenient_int


def read_csv_text(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header, every column as text.

    With ``columns`` given no file is opened while planning, and a header that
    differs is an error.  Typing is left to the cleaning step, so a month with
    dirty values, or with a header only, has the same schema as any other.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if columns is not None:
        schema = StructType([StructField(c, StringType()) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path if isinstance(path, str) else list(path))


def snapshot(df: DataFrame, date: str, day: str | Column) -> DataFrame:
    """Rows of one snapshot; on a dataset partitioned by ``date`` only its folder is read."""
    day = F.lit(day).cast("date") if isinstance(day, str) else day
    return df.where(F.col(date) == day)


def snapshots(df: DataFrame, date: str, days: Iterable[str]) -> DataFrame:
    return df.where(F.col(date).isin(*[F.lit(d).cast("date") for d in days]))


def since(df: DataFrame, date: str, day: str) -> DataFrame:
    return df.where(F.col(date) >= F.lit(day).cast("date"))


def read_store(
    spark: SparkSession, root: str, merge_schema: bool = True, schema: StructType | None = None
) -> DataFrame:
    """A whole store, all partitions; columns added later are null in older ones.

    With a schema no file is opened while planning, and a store without any rows is an empty table.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(root)
    return spark.read.option("mergeSchema", merge_schema).parquet(root)


def reconcile(df: DataFrame, target: StructType) -> DataFrame:
    """Bring one partition's columns to the target types; absent columns are null."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def as_target(field: StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(field.name)
        if have[field.name] == field.dataType:
            return c
        if field.dataType.typeName() == "integer" and isinstance(have[field.name], StringType):
            return lenient_int(c).alias(field.name)
        if isinstance(field.dataType, DateType) and isinstance(have[field.name], NumericType):
            return F.lit(None).cast("date").alias(field.name)
        return c.try_cast(field.dataType).alias(field.name)

    return df.select(*[as_target(f) for f in target.fields])


REGISTER_TYPE = "folder string, schema string, written_at timestamp"


def partition_schemas(spark: SparkSession, paths: Sequence[str], register: str | None = None) -> dict[str, StructType]:
    """Schema of each partition folder.

    ``register`` is a table that writers add to; it is read once, and the last
    schema written to a folder counts.  Folders that it does not name, or all
    without one, are asked for the schema in their file footers.  Columns that a folder's
    name holds (``date=2024-01-01``) are part of it.
    """
    known: dict[str, StructType] = {}
    if register is not None:
        last = spark.read.schema(REGISTER_TYPE).parquet(register).groupBy("folder").agg(F.max_by("schema", "written_at").alias("schema"))
        wanted = spark.createDataFrame([(p.rstrip("/"),) for p in paths], "folder string")
        texts: dict[str, StructType] = {}  # few schemas, many folders
        for r in last.join(wanted, "folder", "left_semi").collect():
            if r["schema"] not in texts:
                texts[r["schema"]] = StructType.fromJson(json.loads(r["schema"]))
            known[r["folder"]] = texts[r["schema"]]
    unknown = [p for p in paths if p.rstrip("/") not in known]
    found = footer_schemas(spark, unknown)
    return {p: known[p.rstrip("/")] if p.rstrip("/") in known else found[p] for p in paths}


def footer_schemas(spark: SparkSession, paths: Sequence[str]) -> dict[str, StructType]:
    """Schemas from file footers: a call per folder, ``FOOTER_CALLS`` of them side by side."""
    def found(path: str) -> StructType:
        return spark.read.option("basePath", _base(path)).parquet(path).schema

    with ThreadPoolExecutor(FOOTER_CALLS) as pool:
        return dict(zip(paths, pool.map(found, paths)))


#: Folders whose footers are asked for at a time.
FOOTER_CALLS = 16


def _base(path: str) -> str:
    """The part of a path above the folders that name a partition."""
    parts = path.rstrip("/").split("/")
    named = [i for i, part in enumerate(parts) if "=" in part]
    return "/".join(parts[: named[0]]) if named else path


def read_reconciled(
    spark: SparkSession, paths: Sequence[str], target: StructType, register: str | None = None
) -> DataFrame:
    """Partitions whose column types drifted, as one table of the target schema.

    Folders that share a schema and a store are read by one scan; the union is by name.
    With ``register`` (see ``partition_schemas``) no file of a registered folder is opened for planning.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    texts: dict[int, str] = {}
    for path, schema in partition_schemas(spark, paths, register).items():
        store = _base(path) if "=" in path else ""
        text = texts.setdefault(id(schema), schema.json())
        groups.setdefault((text, store), []).append(path)
    parts = []
    for (js, store), members in groups.items():
        reader = spark.read.schema(StructType.fromJson(json.loads(js)))
        reader = reader.option("basePath", store) if store else reader
        parts.append(reconcile(reader.parquet(*members), target))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Prediction files as written by the CSV sink, dates parsed."""
    columns = ["Customer_ID", "inference_date", "predicted_default", "default_probability", "risk_category"]
    return read_csv_text(spark, path, columns).select(
        "Customer_ID",
        F.to_date("inference_date").alias("inference_date"),
        F.col("predicted_default").try_cast("int").alias("predicted_default"),
        F.col("default_probability").try_cast("double").alias("default_probability"),
        "risk_category",
    )


def read_importance_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_text(spark, path, ["feature", "importance"]).select(
        "feature", F.col("importance").try_cast("double").alias("importance")
    )


def read_summary_documents(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Monitoring summaries; a document may span several lines."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)
