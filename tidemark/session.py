"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "tidemark", **extra: str) -> SparkSession:
    """A small session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # No call-site capture for every column expression while planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # HotSpot compiles no method above 8000 bytes; wide projections split below it.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that all executors can reach.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a
    single-machine session without the setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that several later jobs read: the table survives the loss of
    an executor, and the later jobs do not repeat the work.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of one file of a table that models are fitted on.
FIT_ROWS = 500_000


def cut_for_fitting(df: DataFrame, name: str, partitions: Sequence[str]) -> DataFrame:
    """``cut_lineage`` for rows that a model fit keeps in memory: one task for each file, and at most ``FIT_ROWS`` rows in it.

    A fit holds ten times the bytes of a row in its file and makes a pass over them for
    each level of a tree, so what a task holds must not follow the size of files on disk.  The
    returned table belongs to a session of its own, with the settings of ``df``'s, where files are not joined to larger tasks.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.partitionBy(*partitions).option("maxRecordsPerFile", FIT_ROWS).parquet(path)
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return own.read.schema(df.schema).parquet(path)
