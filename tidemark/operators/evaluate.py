"""Classifier evaluation: confusion counts, ratios, ROC-AUC, curves, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.bands import comparison_status
from tidemark.functions.bins import bin_index
from tidemark.functions.numbers import share
from tidemark.operators.ordering import levels, running_totals, value_counts_ordered
from tidemark.operators.quantiles import exact_quantiles

_COUNTS = ("tp", "fp", "tn", "fn")


def _outcomes(label: Column, predicted: Column) -> dict[str, Column]:
    one = lambda test: F.when(test, 1).otherwise(0)
    return {
        "tp": one((label == 1) & (predicted == 1)),
        "fp": one((label == 0) & (predicted == 1)),
        "tn": one((label == 0) & (predicted == 0)),
        "fn": one((label == 1) & (predicted == 0)),
    }


def ratios(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """Rates from confusion counts; a zero denominator gives 0."""
    n = tp + fp + tn + fn
    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    return {
        "accuracy": share(tp + tn, n),
        "precision": precision,
        "recall": recall,
        "f1_score": share(2 * tp, 2 * tp + fp + fn),
        "actual_default_rate": share(tp + fn, n),
        "predicted_default_rate": share(tp + fp, n),
        "false_negative_rate": share(fn, fn + tp),
        "false_positive_rate": share(fp, fp + tn),
    }


def confusion_counts(
    df: DataFrame, keys: Sequence[str], label: str, predicted: str
) -> DataFrame:
    outcomes = _outcomes(F.col(label), F.col(predicted))
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_samples"), *[F.sum(c).alias(n) for n, c in outcomes.items()]
    )


def confusion_metrics(df: DataFrame, keys: Sequence[str], label: str, predicted: str) -> DataFrame:
    counted = confusion_counts(df, keys, label, predicted)
    rates = ratios(*[F.col(c) for c in _COUNTS])
    return counted.select("*", *[c.alias(n) for n, c in rates.items()])


def ranked_counts(
    df: DataFrame, keys: Sequence[str], label: str, predicted: str | None, score: str
) -> DataFrame:
    """Per key: rows, confusion counts and tie-aware ROC-AUC from one grouping.

    All rows count for ``n``, the classes and the outcomes; rows without a score
    (``n_without_score``) are in no pair.

    AUC is the share of (positive, negative) pairs in the right order, ties
    counting half.  Pairs are counted level by level: between the distinct
    scores of a fine bucket, between the fine buckets of a coarse one, and
    between the coarse buckets of a key, always from totals.
    """
    y = F.col(label)
    scored = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")).isNotNull()
    one = lambda test: F.when(test, 1).otherwise(0)
    sums = {
        "n": F.lit(1), "n_without_score": one(~scored), "positives": one(y == 1), "negatives": one(y == 0),
        "pos": one((y == 1) & scored), "neg": one((y == 0) & scored),
    }
    if predicted is not None:
        sums |= _outcomes(y, F.col(predicted))
    table = value_counts_ordered(df, keys, F.col(score), sums, keep_missing=True).withColumn(
        "__pairs", F.col("pos").cast("double") * F.col("neg") / F.lit(2.0)
    )
    for group, order in levels(keys):
        lower = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        beaten = F.coalesce(F.sum("neg").over(lower), F.lit(0)).cast("double")
        table = (
            table.withColumn("__pairs", F.col("__pairs") + F.col("pos") * beaten)
            .groupBy(*group)
            .agg(F.sum("__pairs").alias("__pairs"), *[F.sum(n).alias(n) for n in sums])
        )
    all_pairs = F.col("pos").cast("double") * F.col("neg").cast("double")
    return table.withColumn("auc", F.try_divide(F.col("__pairs"), all_pairs)).drop("__pairs")


def auc_by_group(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """ROC-AUC per key, for keys with at least two rows and both classes."""
    return (
        ranked_counts(df, keys, label, None, score)
        .where((F.col("pos") > 0) & (F.col("neg") > 0))
        .select(*keys, F.col("pos").alias("n_positive"), F.col("neg").alias("n_negative"), "auc")
    )


def evaluate_by_period(
    df: DataFrame,
    period: str,
    label: str = "label",
    predicted: str = "predicted_default",
    score: str = "default_probability",
    period_name: str = "month",
) -> DataFrame:
    """The evaluation table: one row of fifteen columns per eligible period.

    A period needs at least two rows and both classes.  Rows without a score count
    like any other; the AUC leaves them out and is null if it can't be taken.
    """
    counted = ranked_counts(df, [period], label, predicted, score).where(
        (F.col("n") >= 2) & (F.col("positives") > 0) & (F.col("negatives") > 0)
    )
    r = ratios(*[F.col(c) for c in _COUNTS])
    return counted.select(
        F.col(period).alias(period_name),
        F.col("n").alias("n_samples"),
        "auc",
        *[r[n].alias(n) for n in (
            "accuracy", "precision", "recall", "f1_score",
            "actual_default_rate", "predicted_default_rate",
        )],
        F.col("tp").alias("true_positives"),
        F.col("fp").alias("false_positives"),
        F.col("tn").alias("true_negatives"),
        F.col("fn").alias("false_negatives"),
        r["false_negative_rate"].alias("false_negative_rate"),
        r["false_positive_rate"].alias("false_positive_rate"),
    )


def performance_summary(metrics: DataFrame, training_auc: float | None = None) -> DataFrame:
    """One row: unweighted means over the periods, ranges, and the training comparison."""
    mean = lambda c, name=None: F.avg(c).alias(name or f"avg_{c}")
    out = metrics.agg(
        (F.count("*") > 0).alias("evaluation_available"),
        F.min("month").alias("period_start"),
        F.max("month").alias("period_end"),
        F.coalesce(F.sum("n_samples"), F.lit(0)).alias("total_samples_evaluated"),
        mean("auc"), mean("accuracy"), mean("precision"), mean("recall"), mean("f1_score"),
        F.min("auc").alias("auc_min"),
        F.max("auc").alias("auc_max"),
        mean("actual_default_rate"), mean("predicted_default_rate"),
        mean("false_negative_rate"), mean("false_positive_rate"),
    )
    reference = F.lit(training_auc).cast("double")
    return out.select(
        "*",
        reference.alias("training_test_auc"),
        (F.col("avg_auc") - reference).alias("auc_difference"),
        comparison_status(F.col("avg_auc"), reference).alias("performance_status"),
    )


def latest_confusion(metrics: DataFrame) -> DataFrame:
    """The last period's counts as four rows (actual, predicted, n)."""
    last = metrics.agg(F.max_by(
        F.struct("month", "true_negatives", "false_positives", "false_negatives", "true_positives"),
        "month",
    ).alias("m"))
    return last.select("m.*").unpivot(
        ["month"],
        ["true_negatives", "false_positives", "false_negatives", "true_positives"],
        "cell", "n",
    ).select(
        "month",
        F.when(F.col("cell").isin("false_negatives", "true_positives"), 1).otherwise(0).alias("actual"),
        F.when(F.col("cell").isin("false_positives", "true_positives"), 1).otherwise(0).alias("predicted"),
        "n",
    )


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means.

    The accuracy stands in the column of F1.

    The rows are counted once per (actual, predicted) pair of classes; all
    later steps work on that small table.
    """
    cells = df.groupBy(F.col(label).alias("a"), F.col(predicted).alias("p")).agg(
        F.count("*").alias("n")
    )
    by_class_hits = (
        cells.select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("class"), F.col("n").alias("actual"),
                             F.lit(0).cast("long").alias("claimed"),
                             F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                    F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("actual"),
                             F.col("n").alias("claimed"), F.lit(0).cast("long").alias("hit")),
                )
            ).alias("x")
        )
        .groupBy("x.class")
        .agg(F.sum("x.actual").alias("support"), F.sum("x.claimed").alias("claimed"),
             F.sum("x.hit").alias("hit"))
    )
    by_class = by_class_hits.select(
        F.col("class").cast("string").alias("class"),
        share(F.col("hit"), F.col("claimed")).alias("precision"),
        share(F.col("hit"), F.col("support")).alias("recall"),
        share(2 * F.col("hit"), F.col("claimed") + F.col("support")).alias("f1_score"),
        "support",
    )
    metrics = ("precision", "recall", "f1_score")
    macro = by_class.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(m).alias(m) for m in metrics],
        F.sum("support").alias("support"),
    )
    weighted = by_class.agg(
        F.lit("weighted avg").alias("class"),
        *[share(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in metrics],
        F.sum("support").alias("support"),
    )
    accuracy = by_class_hits.agg(
        F.lit("accuracy").alias("class"),
        F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"),
        share(F.sum("hit"), F.sum("support")).alias("f1_score"),
        F.sum("support").alias("support"),
    )
    return by_class.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def roc_points(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """ROC points per key, one per distinct score in falling order, from (0, 0) without a threshold."""
    y = F.col(label)
    totals = running_totals(
        df, keys, F.col(score),
        {"pos": F.when(y == 1, 1).otherwise(0), "neg": F.when(y == 0, 1).otherwise(0)},
        descending=True,
    )
    points = totals.select(
        *keys,
        F.col("value").alias("threshold"),
        (F.col("cum_neg") / F.nullif(F.col("total_neg"), F.lit(0))).alias("fpr"),
        (F.col("cum_pos") / F.nullif(F.col("total_pos"), F.lit(0))).alias("tpr"),
    )
    start = _scored_keys(df, keys, label, score).select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def pr_points(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """Precision-recall points per key, with the base rate of the key.

    The last point, without a threshold, is recall 0 and precision 1.
    """
    y = F.col(label)
    totals = running_totals(
        df, keys, F.col(score),
        {"pos": F.when(y == 1, 1).otherwise(0), "neg": F.when(y == 0, 1).otherwise(0)},
        descending=True,
    )
    base_rate = F.try_divide(F.col("total_pos"), F.col("total_pos") + F.col("total_neg"))
    points = totals.select(
        *keys,
        F.col("value").alias("threshold"),
        share(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        (F.col("cum_pos") / F.nullif(F.col("total_pos"), F.lit(0))).alias("recall"),
        base_rate.alias("base_rate"),
    )
    end = _scored_keys(df, keys, label, score).select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), base_rate.alias("base_rate"))
    return points.unionByName(end)


def _scored_keys(df: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """Keys that have a score, with their positives and negatives among scored rows."""
    y, v = F.col(label), F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    return df.where(v.isNotNull()).groupBy(*keys).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).alias("total_pos"), F.sum(F.when(y == 0, 1).otherwise(0)).alias("total_neg"))


def score_histogram(df: DataFrame, score: str, period: str, bins: int = 50) -> DataFrame:
    """Density histograms of the first and the last period.

    Each period has its own grid from its least to its greatest score; one
    score only gives a grid that reaches half a unit to either side.
    """
    bounds = df.agg(F.struct(F.min(period).alias("lo"), F.max(period).alias("hi")).alias("b")).scalar()
    ends = df.where(F.col(score).isNotNull()).where(
        (F.col(period) == bounds["lo"]) | (F.col(period) == bounds["hi"])
    ).select(period, F.col(score).cast("double").alias("__s"))
    # At most two rows: the first and the last period.
    ranges = ends.groupBy(period).agg(
        F.min("__s").alias("__low"), F.max("__s").alias("__high"), F.count("*").alias("__n")
    )
    half = F.when(F.col("__low") == F.col("__high"), 0.5).otherwise(0.0)
    ranges = ranges.select(period, (F.col("__low") - half).alias("__low"), (F.col("__high") + half).alias("__high"), "__n")
    width = (F.col("__high") - F.col("__low")) / F.lit(float(bins))
    counted = (
        ends.join(F.broadcast(ranges), period)
        .groupBy(period, bin_index(F.col("__s"), bins, F.col("__low"), F.col("__high")).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    grid = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counted, [period, "bin"], "left").select(
        period,
        "bin",
        (F.col("__low") + F.col("bin") * width).alias("bin_low"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        (F.coalesce(F.col("n"), F.lit(0)) / (F.col("__n") * width)).alias("density"),
    )


def box_stats(
    df: DataFrame, keys: Sequence[str], value: str, reach: float = 1.5
) -> DataFrame:
    """Quartiles and whiskers per key.

    A whisker ends at the last value within ``reach`` times the interquartile
    range of the box, and never inside the box.
    """
    keys = list(keys)
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    box = exact_quantiles(
        df, keys, v, [0.25, 0.5, 0.75], also={"n": F.count(v), "mean": F.avg(v)}
    ).select(*keys, "n", "mean", F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3"))
    spread = F.col("q3") - F.col("q1")
    # Only the ends of the whiskers need another pass.
    fences = box.select(*keys, (F.col("q1") - reach * spread).alias("__from"), (F.col("q3") + reach * spread).alias("__to"))
    ends = (
        df.select(*keys, v.alias("__v")).join(fences, keys).groupBy(*keys).agg(
            F.min(F.when(F.col("__v") >= F.col("__from"), F.col("__v"))).alias("__lo"),
            F.max(F.when(F.col("__v") <= F.col("__to"), F.col("__v"))).alias("__hi"),
        )
    )
    return box.where("n > 0").join(ends, keys).select(
        *keys, "n", "mean", "q1", "median", "q3",
        F.least("__lo", "q1").alias("whisker_low"),
        F.greatest("__hi", "q3").alias("whisker_high"),
    )


def trend_check(metrics: DataFrame, period: str, value: str, k: int = 3) -> DataFrame:
    """Mean of the first ``k`` periods against the last ``k``; one row per period comes in."""
    rising = Window.orderBy(F.asc(period))
    falling = Window.orderBy(F.desc(period))
    ranked = metrics.select(
        value,
        F.row_number().over(rising).alias("__up"),
        F.row_number().over(falling).alias("__down"),
    )
    early = F.avg(F.when(F.col("__up") <= k, F.col(value)))
    recent = F.avg(F.when(F.col("__down") <= k, F.col(value)))
    return ranked.agg(
        F.count("*").alias("n_periods"), early.alias("early"), recent.alias("recent"),
        (recent - early).alias("change"),
    )


def rate_variability(rates: DataFrame, value: str, threshold: float = 0.05) -> DataFrame:
    """Sample standard deviation of a per-period rate, flagged above the threshold."""
    return rates.agg(F.stddev_samp(value).alias("rate_std")).select(
        "rate_std", F.coalesce(F.col("rate_std") > threshold, F.lit(False)).alias("high_variability")
    )


def model_comparison(
    scored: DataFrame, model: str, split: str, label: str, predicted: str, score: str,
    base: str, tuned: str,
) -> DataFrame:
    """Per split: AUC, F1, precision and recall of two models, side by side."""
    counted = ranked_counts(scored, [model, split], label, predicted, score)
    r = ratios(*[F.col(c) for c in _COUNTS])
    measures = {"auc": F.col("auc"), "f1": r["f1_score"], "precision": r["precision"], "recall": r["recall"]}
    table = counted.select(model, split, *[c.alias(n) for n, c in measures.items()])
    return table.groupBy(split).agg(
        *[
            F.max(F.when(F.col(model) == which, F.col(m))).alias(f"{name}_{m}")
            for m in measures
            for name, which in (("baseline", base), ("tuned", tuned))
        ]
    )


def mean_improvement(comparison: DataFrame) -> DataFrame:
    return comparison.agg(
        F.avg(F.col("tuned_auc") - F.col("baseline_auc")).alias("avg_auc_improvement"),
        F.avg(F.col("tuned_f1") - F.col("baseline_f1")).alias("avg_f1_improvement"),
    )
