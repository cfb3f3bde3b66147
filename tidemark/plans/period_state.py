"""Monitoring that grows by periods: stored partial aggregates, one partition per period.

A new month reads its own partitions of the prediction store and the feature store,
writes its state, and the monitors are concluded from the states of all periods, which
are a row per period (and feature).  The full run over whole stores gives the same tables.

==========  ==============  =====================================================
state       period column   content
==========  ==============  =====================================================
scores      inference_date  rows, values and bin counts of the score
features    snapshot_date   per feature: rows, values, bin counts, mean, squares
quality     month           rows, nulls, entities
outcomes    month           the evaluation of the period's matched predictions
==========  ==============  =====================================================

A period that is updated again replaces its state, and one without rows has none
afterwards.  Outcomes depend on labels of other months: an update names the label
dates that arrived, and every prediction period that can match one of them is
evaluated again, from the label months that it can reach.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import evaluate, match, quality, stability
from tidemark.plans.monitoring import MonitoringResult, Thresholds, conclude
from tidemark.session import cut_lineage
from tidemark.sources import readers, writers

#: State tables with their period column and type (the period comes from the folder names).
STATES = {
    "scores": ("inference_date", "n_rows long, n_values long, counts array<long>, inference_date date"),
    "features": (
        "snapshot_date",
        "feature string, n_rows long, n_values long, mean double, squares double, counts array<long>, snapshot_date date",
    ),
    "quality": ("month", "n_rows long, n_nulls long, n_entities long, n_features int, month date"),
    "outcomes": (
        "month",
        "n_samples long, auc double, accuracy double, precision double, recall double, f1_score double, "
        "actual_default_rate double, predicted_default_rate double, true_positives long, false_positives long, "
        "true_negatives long, false_negatives long, false_negative_rate double, false_positive_rate double, month date",
    ),
}


def _reaches(period: Column, days: Sequence[str], back: int, ahead: int) -> Column:
    """Whether some day is from ``back`` months before to ``ahead`` months after the period's month.

    Ranges that meet are one, and their ends are literals, so a store that is
    partitioned by the period reads the folders in reach only.
    """
    def month(number: int) -> dt.date:
        return dt.date(number // 12, number % 12 + 1, 1)

    ranges: list[list[int]] = []
    for m in sorted({int(x[:4]) * 12 + int(x[5:7]) - 1 for x in map(writers.iso_day, days)}):
        if ranges and m - ahead <= ranges[-1][1] + 1:
            ranges[-1][1] = m + back
        else:
            ranges.append([m - ahead, m + back])
    out = F.lit(False)
    for first, last in ranges:
        out = out | ((period >= F.lit(month(first))) & (period < F.lit(month(last + 1))))
    return out


def outdated(predictions: DataFrame, days: Sequence[str], label_days: Sequence[str]) -> DataFrame:
    """Predictions of the periods whose outcomes must be evaluated: the updated ones, and those in reach of new labels."""
    period = F.col("inference_date")
    return predictions.where(period.isin(*[F.lit(str(x)).cast("date") for x in days]) | _reaches(period, label_days, match.BACK, match.AHEAD))


def update(
    spark: SparkSession,
    root: str,
    predictions: DataFrame,
    labels: DataFrame,
    feature_store: DataFrame,
    features: Sequence[str],
    days: Sequence[str],
    label_days: Sequence[str] = (),
) -> str:
    """Bring the states of the periods ``days`` up to date; ``label_days`` are dates of labels that arrived.

    The tables are as for ``monitoring.monitor``, best read from stores
    partitioned by date: filters on the period are all that bounds what is read.
    """
    base = root.rstrip("/")
    scored = readers.snapshots(predictions, "inference_date", days)
    rows = readers.snapshots(feature_store, "snapshot_date", days)
    states = {
        "scores": stability.score_state(scored, "default_probability", "inference_date"),
        "features": stability.feature_state(rows, "snapshot_date", features),
        "quality": quality.quality_state(rows, "snapshot_date", "Customer_ID"),
    }
    for name, state in states.items():
        writers.write_snapshots(state, f"{base}/{name}", date=STATES[name][0], days=days)

    again = outdated(predictions, days, label_days)
    # The periods to evaluate, a row each: they bound the labels that are read, and may lose their outcome.
    periods = [r[0].isoformat() for r in again.select("inference_date").distinct().collect()]
    reach = _reaches(F.col("label_date"), periods, match.AHEAD, match.BACK)
    # Outcomes are counted and ranked: the match is made once for both.
    matched = cut_lineage(
        match.nearest_label(again, labels.where(reach)).select("inference_date", "label", "predicted_default", "default_probability"),
        "matched")
    writers.write_snapshots(
        evaluate.evaluate_by_period(matched, "inference_date"), f"{base}/outcomes", date="month",
        days=sorted({*periods, *map(str, days)}),
    )
    return base


def add_rows(spark: SparkSession, root: str, scored: DataFrame) -> str:
    """Add late predictions to the score states of their periods; only the new rows are read.

    A row must be added once.  Their outcomes need an ``update``.
    """
    period, schema = STATES["scores"]
    path = f"{root.rstrip('/')}/scores"
    new = cut_lineage(stability.score_state(scored, "default_probability", period), "state-new")
    old = readers.read_store(spark, path, schema=schema).join(new.select(period), period, "left_semi")
    merged = stability.merge_states(new.unionByName(old), [period])
    # The states read are replaced by the write.
    writers.write_snapshots(cut_lineage(merged, "state-merged"), path, date=period)
    return root


def result(
    spark: SparkSession, root: str, training_auc: float | None = None, thresholds: Thresholds = Thresholds(), since: str | None = None
) -> MonitoringResult:
    """All monitors from the stored states; ``since`` leaves out earlier periods, so the first one left is the baseline."""
    state = {}
    for name, (period, schema) in STATES.items():
        table = readers.read_store(spark, f"{root.rstrip('/')}/{name}", schema=schema)
        state[name] = table if since is None else readers.since(table, period, since)
    keep = lambda df, name: cut_lineage(df, name)
    return conclude(
        keep(stability.psi_from_state(state["scores"], "inference_date"), "psi"),
        keep(stability.drift_from_state(state["features"], "snapshot_date"), "drift"),
        state["outcomes"],
        quality.quality_from_state(state["quality"]),
        training_auc,
        thresholds,
    )
