"""Nearest-label matching and classifier evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate, match
from tidemark.operators.quantiles import exact_quantiles
from tidemark.queries import standins as st
from tidemark.queries.base import present, query, table
from tidemark.queries.sqltext import RATES, auc, confusion, d, r, rounded


def matched(spark, sf):
    return match.nearest_label(st.predictions(spark, sf), st.outcomes(spark, sf))


@query("nearest_label_join", f"""
WITH {st.MATCHED}
SELECT Customer_ID, {d('inference_date')} AS inference_date, predicted_default, {r('default_probability')} AS default_probability,
       {d('label_date')} AS label_date, loan_id, label, label_def, date_diff_months
FROM matched""")
def nearest_label_join(spark, sf):
    return present(matched(spark, sf))


@query("match_quality", f"""
WITH {st.MATCHED}
SELECT {d('m.inference_date')} AS inference_date, count(*) AS n_matched, {r('avg(date_diff_months)')} AS avg_time_to_label,
       min(date_diff_months) AS min_time, max(date_diff_months) AS max_time, any_value(p.n) AS n_predictions,
       {r('count(*) * 100e0 / any_value(p.n)')} AS coverage_pct
FROM matched m JOIN (SELECT inference_date, count(*) AS n FROM predictions GROUP BY inference_date) p USING (inference_date)
GROUP BY m.inference_date""")
def match_quality(spark, sf):
    return present(match.match_quality(matched(spark, sf), st.predictions(spark, sf)))


@query("match_totals", f"""
WITH {st.MATCHED}
SELECT count(*) AS n_matched, {r('avg(date_diff_months)')} AS avg_time_to_label, min(date_diff_months) AS min_time,
       max(date_diff_months) AS max_time, (SELECT count(*) FROM predictions) AS n_predictions,
       {r('count(*) * 100e0 / (SELECT count(*) FROM predictions)')} AS coverage_pct
FROM matched""")
def match_totals(spark, sf):
    return present(match.match_totals(matched(spark, sf), st.predictions(spark, sf)))


@query("auc_by_group", f"""
WITH {st.SCORED_DOCUMENTS},
a AS ({auc('scored', 'lang', 'label', 'score')})
SELECT a.lang, count(*) FILTER (WHERE s.label = 1) AS n_positive, count(*) FILTER (WHERE s.label = 0) AS n_negative, {r('any_value(auc)')} AS auc
FROM a JOIN scored s USING (lang) GROUP BY a.lang""")
def auc_by_group(spark, sf):
    return present(evaluate.auc_by_group(st.scored_documents(spark, sf), ["lang"], "label", "score"))


@query("confusion_metrics", f"""
WITH {st.SCORED_DOCUMENTS},
c AS (SELECT lang, {confusion('label', 'predicted')} FROM scored GROUP BY lang)
SELECT lang, n AS n_samples, tp, fp, tn, fn, {', '.join(f'{r(x)} AS {name}' for name, x in RATES.items())} FROM c""")
def confusion_metrics(spark, sf):
    return present(evaluate.confusion_metrics(st.scored_documents(spark, sf), ["lang"], "label", "predicted"))


_REPORT = f"""
classes AS (SELECT DISTINCT label AS c FROM scored UNION SELECT DISTINCT predicted FROM scored),
per AS (
  SELECT c, count(*) FILTER (WHERE label = c) AS support, count(*) FILTER (WHERE predicted = c) AS claimed,
         count(*) FILTER (WHERE label = c AND predicted = c) AS hit
  FROM classes, scored GROUP BY c),
report AS (
  SELECT CAST(c AS VARCHAR) AS class, coalesce(hit / nullif(CAST(claimed AS DOUBLE), 0), 0) AS precision,
         coalesce(hit / nullif(CAST(support AS DOUBLE), 0), 0) AS recall,
         coalesce(2e0 * hit / nullif(claimed + support, 0), 0) AS f1_score, support FROM per)"""


@query("classification_report", f"""
WITH {st.SCORED_DOCUMENTS},{_REPORT}
SELECT class, {rounded(['precision', 'recall', 'f1_score'])}, support FROM report
UNION ALL SELECT 'accuracy', NULL, NULL, {r('(SELECT sum(hit) FROM per) * 1e0 / sum(support)')}, CAST(sum(support) AS BIGINT) FROM report
UNION ALL SELECT 'macro avg', {r('avg(precision)')}, {r('avg(recall)')}, {r('avg(f1_score)')}, CAST(sum(support) AS BIGINT) FROM report
UNION ALL SELECT 'weighted avg', {r('sum(precision * support) / sum(support)')}, {r('sum(recall * support) / sum(support)')},
                 {r('sum(f1_score * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM report""")
def classification_report(spark, sf):
    return present(evaluate.classification_report(st.scored_documents(spark, sf), "label", "predicted"))


def evaluation_cte(source: str = "matched") -> str:
    return f"""
confused AS (SELECT inference_date, {confusion()} FROM {source} GROUP BY inference_date),
ranked AS ({auc(source, 'inference_date', 'label', 'default_probability')}),
evaluation AS (
  SELECT inference_date AS month, n AS n_samples, auc, {', '.join(f'{x} AS {name}' for name, x in RATES.items())},
         tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives
  FROM confused JOIN ranked USING (inference_date) WHERE n >= 2)"""


EVALUATION = f"{st.MATCHED},{evaluation_cte()}"


@query("monthly_evaluation", f"""
WITH {EVALUATION}
SELECT {d('month')} AS month, n_samples, {rounded(['auc', *RATES])},
       true_positives, false_positives, true_negatives, false_negatives FROM evaluation""")
def monthly_evaluation(spark, sf):
    return present(evaluate.evaluate_by_period(matched(spark, sf), "inference_date"))


_GAPS = f"""
{st.MATCHED},
gaps AS (SELECT * REPLACE (CASE WHEN rn % 7 <> 0 THEN default_probability END AS default_probability)
         FROM (SELECT *, length(Customer_ID) + ascii(right(Customer_ID, 1)) AS rn FROM matched)),
confused AS (SELECT inference_date, {confusion()}, count(*) FILTER (WHERE default_probability IS NULL) AS gone FROM gaps GROUP BY inference_date),
kept AS (SELECT * FROM gaps WHERE default_probability IS NOT NULL),
ranked AS ({auc('kept', 'inference_date', 'label', 'default_probability')})"""


@query("evaluation_with_gaps", f"""
WITH {_GAPS}
SELECT {d('inference_date')} AS month, n AS n_samples, gone AS n_without_score, {r('auc')} AS auc,
       tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives
FROM confused LEFT JOIN ranked USING (inference_date)""")
def evaluation_with_gaps(spark, sf):
    """Rows without a score count for everything but the AUC."""
    gap = (F.length("Customer_ID") + F.ascii(F.right("Customer_ID", F.lit(1)))) % 7 == 0
    rows = matched(spark, sf).withColumn("default_probability", F.when(~gap, F.col("default_probability")))
    counted = evaluate.ranked_counts(rows, ["inference_date"], "label", "predicted_default", "default_probability")
    return present(counted.select(
        F.col("inference_date").alias("month"), F.col("n").alias("n_samples"), "n_without_score", "auc",
        F.col("tp").alias("true_positives"), F.col("fp").alias("false_positives"),
        F.col("tn").alias("true_negatives"), F.col("fn").alias("false_negatives")))


@query("auc_tiny_scores", f"""
WITH {st.SCORED_DOCUMENTS}, tiny AS (SELECT lang, label, score * 3e-6 AS s FROM scored),
ranked AS ({auc('tiny', 'lang', 'label', 's')})
SELECT lang, {r('auc')} AS auc FROM ranked""")
def auc_tiny_scores(spark, sf):
    """Scores of rare events: all within three millionths."""
    scored = st.scored_documents(spark, sf).withColumn("s", F.col("score") * 3e-6)
    return present(evaluate.auc_by_group(scored, ["lang"], "label", "s").select("lang", "auc"))


@query("quantiles_large_values", f"""
SELECT o_orderstatus, {r('quantile_cont(v, 0.1)', 3)} AS q10, {r('quantile_cont(v, 0.5)', 3)} AS q50, {r('quantile_cont(v, 0.9)', 3)} AS q90
FROM (SELECT o_orderstatus, 1e9 + o_orderkey % 2000 AS v FROM orders) GROUP BY o_orderstatus""")
def quantiles_large_values(spark, sf):
    """Values that stand close together far from zero."""
    orders = table(spark, sf, "orders").withColumn("v", F.lit(1e9) + F.col("o_orderkey") % 2000)
    q = exact_quantiles(orders, ["o_orderstatus"], F.col("v"), [0.1, 0.5, 0.9])
    return present(q.select("o_orderstatus", F.col("q_0").alias("q10"), F.col("q_1").alias("q50"), F.col("q_2").alias("q90")), digits=3)


_MEANS = ["auc", "accuracy", "precision", "recall", "f1_score", "actual_default_rate",
          "predicted_default_rate", "false_negative_rate", "false_positive_rate"]

PERFORMANCE_SUMMARY = f"""
performance AS (
  SELECT count(*) > 0 AS evaluation_available, min(month) AS period_start, max(month) AS period_end,
         CAST(coalesce(sum(n_samples), 0) AS BIGINT) AS total_samples_evaluated,
         {', '.join(f'avg({m}) AS avg_{m}' for m in _MEANS)},
         min(auc) AS auc_min, max(auc) AS auc_max, 6e-1 AS training_test_auc, avg(auc) - 6e-1 AS auc_difference,
         CASE WHEN avg(auc) > 6e-1 + 1e-2 THEN 'better' WHEN abs(avg(auc) - 6e-1) <= 1e-2 THEN 'similar'
              ELSE 'degraded' END AS performance_status
  FROM evaluation)"""


@query("performance_summary", f"""
WITH {EVALUATION},{PERFORMANCE_SUMMARY}
SELECT evaluation_available, {d('period_start')} AS period_start, {d('period_end')} AS period_end, total_samples_evaluated,
       {rounded([f'avg_{m}' for m in _MEANS] + ['auc_min', 'auc_max', 'training_test_auc', 'auc_difference'])}, performance_status
FROM performance""")
def performance_summary(spark, sf):
    table = evaluate.evaluate_by_period(matched(spark, sf), "inference_date")
    return present(evaluate.performance_summary(table, training_auc=0.6))


@query("latest_confusion", f"""
WITH {EVALUATION}, last AS (SELECT * FROM evaluation ORDER BY month DESC LIMIT 1)
SELECT {d('month')} AS month, 0 AS actual, 0 AS predicted, true_negatives AS n FROM last
UNION ALL SELECT {d('month')}, 0, 1, false_positives FROM last
UNION ALL SELECT {d('month')}, 1, 0, false_negatives FROM last
UNION ALL SELECT {d('month')}, 1, 1, true_positives FROM last""")
def latest_confusion(spark, sf):
    return present(evaluate.latest_confusion(evaluate.evaluate_by_period(matched(spark, sf), "inference_date")))


_CURVE = """
steps AS (SELECT lang, score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
          FROM scored GROUP BY lang, score),
curve AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER (PARTITION BY lang) AS tp, sum(neg) OVER (PARTITION BY lang) AS tn
          FROM steps WINDOW w AS (PARTITION BY lang ORDER BY threshold DESC))"""


@query("roc_points", f"""
WITH {st.SCORED_DOCUMENTS},{_CURVE}
SELECT lang, threshold, {r('cn / nullif(tn, 0)')} AS fpr, {r('cp / nullif(tp, 0)')} AS tpr FROM curve
UNION ALL SELECT DISTINCT lang, CAST(NULL AS DOUBLE), 0e0, 0e0 FROM curve""")
def roc_points(spark, sf):
    return present(evaluate.roc_points(st.scored_documents(spark, sf), ["lang"], "label", "score"))


@query("pr_points", f"""
WITH {st.SCORED_DOCUMENTS},{_CURVE}
SELECT lang, threshold, {r('coalesce(cp / nullif(cp + cn, 0), 0)')} AS precision, {r('cp / nullif(tp, 0)')} AS recall,
       {r('tp / (tp + tn)')} AS base_rate FROM curve
UNION ALL SELECT DISTINCT lang, CAST(NULL AS DOUBLE), 1e0, 0e0, {r('tp / (tp + tn)')} FROM curve""")
def pr_points(spark, sf):
    return present(evaluate.pr_points(st.scored_documents(spark, sf), ["lang"], "label", "score"))


@query("trend_check", f"""
WITH {EVALUATION},
o AS (SELECT auc, row_number() OVER (ORDER BY month) AS a, row_number() OVER (ORDER BY month DESC) AS b FROM evaluation)
SELECT count(*) AS n_periods, {r('avg(auc) FILTER (WHERE a <= 3)')} AS early, {r('avg(auc) FILTER (WHERE b <= 3)')} AS recent,
       {r('avg(auc) FILTER (WHERE b <= 3) - avg(auc) FILTER (WHERE a <= 3)')} AS change FROM o""")
def trend_check(spark, sf):
    return present(evaluate.trend_check(
        evaluate.evaluate_by_period(matched(spark, sf), "inference_date"), "month", "auc"))


@query("rate_variability", f"""
WITH {st.PREDICTIONS},
rates AS (SELECT inference_date, avg(predicted_default) AS rate FROM predictions GROUP BY inference_date)
SELECT {r('stddev_samp(rate)')} AS rate_std, stddev_samp(rate) > 5e-2 AS high_variability FROM rates""")
def rate_variability(spark, sf):
    rates = st.predictions(spark, sf).groupBy("inference_date").agg(F.avg("predicted_default").alias("rate"))
    return present(evaluate.rate_variability(rates, "rate"))
