"""Monitoring from stored period states against the run over whole stores."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import stability
from tidemark.plans import monitoring, period_state
from tidemark.session import shared_dir
from tidemark.sources import readers, writers

MONTHS = [dt.date(2023 + m // 12, m % 12 + 1, 1) for m in range(16)]
FEATURES = ["x", "y"]


@pytest.fixture(scope="module")
def stores(spark):
    rng = np.random.default_rng(4)
    n = 3000
    pdf = pd.DataFrame({
        "Customer_ID": [f"C{i}" for i in rng.integers(0, 400, n)], "inference_date": rng.choice(MONTHS, n),
        "default_probability": np.round(rng.random(n), 3), "x": np.where(rng.random(n) < 0.1, np.nan, rng.random(n)), "y": rng.normal(0.5, 0.2, n)})
    rows = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None)))
    predictions = rows.select("Customer_ID", "inference_date", "default_probability", (F.col("default_probability") > 0.5).cast("int").alias("predicted_default"))
    labels = spark.createDataFrame(pd.DataFrame({
        "Customer_ID": [f"C{i}" for i in rng.integers(0, 400, 700)], "label_date": rng.choice(MONTHS, 700),
        "loan_id": [f"L{i}" for i in range(700)], "label": rng.integers(0, 2, 700), "label_def": "d"}))
    features = rows.select("Customer_ID", F.col("inference_date").alias("snapshot_date"), *FEATURES)
    roots = {}
    for name, df, date in (("predictions", predictions, "inference_date"), ("labels", labels, "label_date"), ("features", features, "snapshot_date")):
        roots[name] = writers.write_snapshots(df, shared_dir(spark, name), date=date)
    return {name: readers.read_store(spark, root, False) for name, root in roots.items()}


def shown(df):
    rows = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*sorted(df.columns)).collect()]
    return sorted(rows, key=str)


def same(one, two):
    for name in ("psi", "drift", "performance", "quality", "alerts", "decision"):
        assert shown(getattr(one, name).drop("metrics")) == shown(getattr(two, name).drop("metrics")), name


def test_month_by_month_is_the_full_run(spark, stores):
    p, lab, f = stores["predictions"], stores["labels"], stores["features"]
    full = monitoring.monitor(p, lab, f, FEATURES, training_auc=0.6)
    root = shared_dir(spark, "state")
    steps = [MONTHS[:9], MONTHS[9:10], MONTHS[10:]]
    for step in steps:
        days = [d.isoformat() for d in step]
        so_far = lab.where(F.col("label_date") <= F.lit(step[-1]))
        period_state.update(spark, root, p, so_far, f, FEATURES, days, label_days=days)
    same(period_state.result(spark, root, 0.6), full)
    # Once more, and from a later month on.
    period_state.update(spark, root, p, lab, f, FEATURES, [MONTHS[3].isoformat()])
    same(period_state.result(spark, root, 0.6), full)
    later = [df.where(F.col(c) >= F.lit(MONTHS[5])) for df, c in ((p, "inference_date"), (f, "snapshot_date"))]
    same(period_state.result(spark, root, 0.6, since=MONTHS[5].isoformat()), monitoring.monitor(later[0], lab, later[1], FEATURES, training_auc=0.6))


def test_a_withdrawn_month_leaves_the_state(spark, stores):
    p, lab, f = stores["predictions"], stores["labels"], stores["features"]
    root, days = shared_dir(spark, "state"), [d.isoformat() for d in MONTHS]
    period_state.update(spark, root, p, lab, f, FEATURES, days)
    gone = F.lit(MONTHS[7])
    p, f = p.where(F.col("inference_date") != gone), f.where(F.col("snapshot_date") != gone)
    period_state.update(spark, root, p, lab, f, FEATURES, ["2023-8-1"])
    same(period_state.result(spark, root, 0.6), monitoring.monitor(p, lab, f, FEATURES, training_auc=0.6))


def test_a_new_month_reads_its_own_partition(spark, stores):
    day = MONTHS[9].isoformat()
    states = [
        (stability.score_state(readers.snapshots(stores["predictions"], "inference_date", [day]), "default_probability", "inference_date"), "inference_date"),
        (stability.feature_state(readers.snapshots(stores["features"], "snapshot_date", [day]), "snapshot_date", FEATURES), "snapshot_date"),
    ]
    for state, date in states:
        scans = [line for line in state._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in line]
        assert scans and all(f"= {day}" in line.split("PartitionFilters")[1].split("]")[0] for line in scans)
        read = readers.snapshots(stores["predictions" if date == "inference_date" else "features"], date, [day]).select(F.input_file_name().alias("f")).distinct().collect()
        assert read and all(f"{date}={day}" in r["f"] for r in read)
    # New labels of one month make the months in reach outdated, no others.
    again = period_state.outdated(stores["predictions"], [], [MONTHS[13].isoformat()])
    assert {r[0] for r in again.select("inference_date").distinct().collect()} == set(MONTHS[1:16])
    again = period_state.outdated(stores["predictions"], [MONTHS[15].isoformat()], [MONTHS[0].isoformat()])
    assert {r[0] for r in again.select("inference_date").distinct().collect()} == {*MONTHS[:7], MONTHS[15]}


def test_states_of_parts_add_up(spark, stores):
    f = stores["features"]
    parts = [f.where(F.abs(F.hash("Customer_ID")) % 3 == k) for k in range(3)]
    states = [stability.feature_state(x, "snapshot_date", FEATURES) for x in parts]
    merged = stability.merge_states(states[0].unionByName(states[1]).unionByName(states[2]), ["snapshot_date", "feature"])
    assert shown(stability.drift_from_state(merged, "snapshot_date")) == shown(stability.feature_drift(f, "snapshot_date", FEATURES))


def test_late_rows_are_added(spark, stores):
    p = stores["predictions"]
    first = (F.hash("Customer_ID") % 2 == 0) & (F.col("inference_date") != F.lit(MONTHS[2]))
    root = shared_dir(spark, "state")
    writers.write_snapshots(stability.score_state(p.where(first), "default_probability", "inference_date"), f"{root}/scores", date="inference_date")
    period_state.add_rows(spark, root, p.where(~first))
    state = readers.read_store(spark, f"{root}/scores", schema=period_state.STATES["scores"][1])
    assert shown(stability.psi_from_state(state, "inference_date")) == shown(stability.psi_over_time(p, "default_probability", "inference_date"))


def test_outcomes_are_matched_once(spark, stores, monkeypatch):
    """The evaluation reads a stored match, so counting and ranking don't make it twice."""
    plans, evaluated = [], period_state.evaluate.evaluate_by_period

    def seen(df, *args, **more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return evaluated(df, *args, **more)

    monkeypatch.setattr(period_state.evaluate, "evaluate_by_period", seen)
    days = [MONTHS[0].isoformat(), MONTHS[1].isoformat()]
    period_state.update(spark, shared_dir(spark, "state"), stores["predictions"], stores["labels"], stores["features"], FEATURES, days, days)
    assert len(plans) == 1 and not any(x in plans[0] for x in ("Join", "Window", "Aggregate")), plans
