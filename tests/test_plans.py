"""What the physical plans must and must not contain."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, match, stability
from tidemark.queries import QUERIES
from tidemark.session import shared_dir
from tidemark.sources import readers, writers

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", [
    "psi_over_time", "feature_drift", "nearest_label_join", "monthly_evaluation", "numeric_quality",
    "roc_points", "job_gold_features", "job_silver_financials", "data_quality_by_period", "alerts",
])
def test_no_python_and_no_pairs(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_one_snapshot_reads_one_folder(spark):
    df = spark.range(100).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("snapshot_date"))
    root = writers.write_snapshots(df, shared_dir(spark, "pruned"))
    text = plan(readers.snapshot(readers.read_store(spark, root, False), "snapshot_date", "2024-01-03").select("id"))
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date", text)
    assert "ReadSchema: struct<id:bigint>" in text


@needs_tables
def test_scan_is_pruned_and_filter_pushed(spark):
    text = plan(QUERIES["snapshot_scan"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in text or "EqualTo(o_orderdate" in text
    assert "o_orderpriority" not in text


def test_psi_shuffles_only_counts(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("d"), (F.col("id") / 1000).alias("s"))
    text = plan(stability.psi_over_time(df, "s", "d"))
    # counts by period and bin, then the small table by period; partial counts below both
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_count" in text


def test_lagged_join_keeps_one_partitioning(spark):
    """Both joins of the feature store are on the same keys: the spine is shuffled once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        day = F.lit("2024-01-01").cast("date")
        keyed = lambda c: spark.range(50).select(F.col("id").cast("string").alias("Customer_ID"), day.alias("snapshot_date"), F.lit(1).alias(c))
        base = keyed("a").join(keyed("b"), ["Customer_ID", "snapshot_date"], "left")
        text = plan(features.lagged_join(base, keyed("visit_frequency"), keyed("z").select("snapshot_date"), ["visit_frequency"], ["visit_frequency"]))
        main = text.split("BroadcastExchange")[0]
        assert main.count("Exchange hashpartitioning(Customer_ID") <= 3  # a, b, activity
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nearest_label_reduces_before_the_shuffle(spark):
    day = F.lit("2024-01-01").cast("date")
    p = spark.range(10).select((F.col("id") % 3).cast("string").alias("Customer_ID"), day.alias("inference_date"), F.lit(1).alias("predicted_default"), F.rand(1).alias("default_probability"))
    y = spark.range(10).select((F.col("id") % 3).cast("string").alias("Customer_ID"), day.alias("label_date"), F.col("id").cast("string").alias("loan_id"), F.lit(1).alias("label"), F.lit("x").alias("label_def"))
    text = plan(match.nearest_label(p, y))
    assert "Join" not in text
    assert text.count("row_number(), 1, Partial") == 2
