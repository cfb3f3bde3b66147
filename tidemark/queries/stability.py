"""PSI, score distributions, feature drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.bands import band_right_closed, drift_status
from tidemark.operators import evaluate, quality, stability
from tidemark.plans import rules
from tidemark.queries import standins as st
from tidemark.queries.base import present, query, table
from tidemark.queries.sqltext import d, r, rounded, unit_bin
from tidemark.session import cut_lineage


def psi_cte(source: str, score: str, period: str, out: str = "psi") -> str:
    return f"""
binned AS (SELECT {period} AS p, {unit_bin(score)} AS bin FROM {source}),
sizes AS (SELECT p, count(*) AS n FROM binned GROUP BY p),
filled AS (SELECT p, bin, count(*) AS c FROM binned WHERE bin IS NOT NULL GROUP BY p, bin),
shares AS (
  SELECT s.p, g.bin, CASE WHEN f.c IS NULL THEN 1e-4 ELSE CAST(f.c AS DOUBLE) / s.n END AS share, s.n, coalesce(f.c, 0) AS c
  FROM sizes s CROSS JOIN (SELECT unnest(range(10)) AS bin) g LEFT JOIN filled f ON f.p = s.p AND f.bin = g.bin),
{out} AS (
  SELECT a.p AS date, sum((a.share - b.share) * ln(a.share / b.share)) AS psi, b.p AS baseline_date
  FROM shares a JOIN shares b ON a.bin = b.bin AND b.p = (SELECT min(p) FROM sizes)
  WHERE a.p > b.p GROUP BY a.p, b.p)"""


PSI = f"{st.SCORES},{psi_cte('scores', 'default_probability', 'inference_date')}"


def psi_frame(spark, sf):
    return stability.psi_over_time(st.scores(spark, sf), "default_probability", "inference_date")


@query("psi_over_time", f"""
WITH {PSI}
SELECT {d('date')} AS date, {r('psi')} AS psi, {d('baseline_date')} AS baseline_date FROM psi""")
def psi_over_time(spark, sf):
    return present(psi_frame(spark, sf))


@query("psi_by_month", f"""
WITH {st.PREDICTIONS},{psi_cte('predictions', 'default_probability', 'inference_date')}
SELECT {d('date')} AS date, {r('psi')} AS psi, {d('baseline_date')} AS baseline_date,
       CASE WHEN psi < 1e-1 THEN 'stable' WHEN psi < 2e-1 THEN 'moderate' ELSE 'significant' END AS status
FROM psi""")
def psi_by_month(spark, sf):
    psi = stability.psi_over_time(st.predictions(spark, sf), "default_probability", "inference_date")
    return present(psi.withColumn("status", drift_status(F.col("psi"))))


@query("psi_bins", f"""
WITH {PSI}
SELECT {d('p')} AS inference_date, bin, {r('bin * 1e-1')} AS bin_low, c AS n, {r('share')} AS share
FROM shares""")
def psi_bins(spark, sf):
    return present(
        stability.histogram_shares(st.scores(spark, sf), ["inference_date"], F.col("default_probability"))
    )


@query("psi_two_samples", f"""
WITH {st.SCORES},
sides AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS side, default_probability FROM scores),
{psi_cte('sides', 'default_probability', 'side')}
SELECT g.bin, {r('g.bin * 1e-1')} AS bin_low, {r('b.share')} AS expected_percent, {r('a.share')} AS actual_percent,
       {r('(SELECT psi FROM psi)')} AS psi
FROM (SELECT unnest(range(10)) AS bin) g
JOIN shares a ON a.p = 1 AND a.bin = g.bin JOIN shares b ON b.p = 0 AND b.bin = g.bin""")
def psi_two_samples(spark, sf):
    s = st.scores(spark, sf)
    bought = F.col("event_type") == "purchase"
    one = stability.psi_between(s.where(~bought), s.where(bought), "default_probability")
    return present(
        one.select("psi", F.posexplode("expected_percents").alias("bin", "expected_percent"),
                   "actual_percents", "breakpoints")
        .select("bin", F.get("breakpoints", "bin").alias("bin_low"), "expected_percent",
                F.get("actual_percents", "bin").alias("actual_percent"), "psi")
    )


PSI_SUMMARY = """
psi_summary AS (
  SELECT coalesce(avg(psi), 0) AS avg_psi, coalesce(max(psi), 0) AS max_psi, coalesce(min(psi), 0) AS min_psi,
         (SELECT date FROM psi ORDER BY psi DESC, date LIMIT 1) AS max_psi_date,
         (SELECT date FROM psi ORDER BY psi, date LIMIT 1) AS min_psi_date,
         count(*) FILTER (WHERE psi < 1e-1) AS n_stable,
         count(*) FILTER (WHERE psi >= 1e-1 AND psi < 2e-1) AS n_moderate,
         count(*) FILTER (WHERE psi >= 2e-1) AS n_significant
  FROM psi)"""


@query("psi_summary", f"""
WITH {st.PREDICTIONS},{psi_cte('predictions', 'default_probability', 'inference_date')},{PSI_SUMMARY}
SELECT {rounded(['avg_psi', 'max_psi', 'min_psi'])}, {d('max_psi_date')} AS max_psi_date,
       {d('min_psi_date')} AS min_psi_date, n_stable, n_moderate, n_significant
FROM psi_summary""")
def psi_summary(spark, sf):
    psi = stability.psi_over_time(st.predictions(spark, sf), "default_probability", "inference_date")
    return present(stability.psi_summary(psi))


def drift_cte(scaled: bool) -> str:
    values = " UNION ALL ".join(
        f"SELECT snapshot_date AS p, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM store" for c in st.STORE_FEATURES
    )
    return f"""{st.line_store_sql(scaled)},
long AS ({values}),
stats AS (
  SELECT p, feature, count(v) AS n, avg(v) AS mean, stddev_pop(v) AS std
  FROM long GROUP BY p, feature HAVING count(v) > 0),
hist AS (SELECT p, feature, {unit_bin('v')} AS bin, count(*) AS c FROM long WHERE v IS NOT NULL GROUP BY ALL),
shares AS (
  SELECT s.p, s.feature, g.bin, CASE WHEN h.c IS NULL THEN 1e-4 ELSE CAST(h.c AS DOUBLE) / s.n END AS share
  FROM stats s CROSS JOIN (SELECT unnest(range(10)) AS bin) g
  LEFT JOIN hist h ON h.p = s.p AND h.feature = s.feature AND h.bin = g.bin),
drift_psi AS (
  SELECT a.p, a.feature, sum((a.share - b.share) * ln(a.share / b.share)) AS psi
  FROM shares a JOIN shares b ON a.feature = b.feature AND a.bin = b.bin AND b.p = (SELECT min(p) FROM long)
  WHERE a.p > b.p GROUP BY a.p, a.feature),
drift AS (
  SELECT x.p AS date, x.feature, x.psi,
         (s.mean - b.mean) / (abs(b.mean) + 1e-10) * 100 AS mean_change_pct,
         (s.std - b.std) / (abs(b.std) + 1e-10) * 100 AS std_change_pct
  FROM drift_psi x JOIN stats s ON s.p = x.p AND s.feature = x.feature
  JOIN stats b ON b.feature = x.feature AND b.p = (SELECT min(p) FROM long))"""


_DRIFT_SELECT = f"""
SELECT {d('date')} AS date, feature, {rounded(['psi', 'mean_change_pct', 'std_change_pct'])} FROM drift"""


@query("feature_drift", f"WITH {drift_cte(False)}{_DRIFT_SELECT}")
def feature_drift(spark, sf):
    return present(stability.feature_drift(st.line_store(spark, sf), "snapshot_date", st.STORE_FEATURES))


def scaled_drift(spark, sf):
    return stability.feature_drift(st.line_store(spark, sf, scaled=True), "snapshot_date", st.STORE_FEATURES)


@query("feature_drift_scaled", f"WITH {drift_cte(True)}{_DRIFT_SELECT}")
def feature_drift_scaled(spark, sf):
    return present(scaled_drift(spark, sf))


DRIFT_SUMMARY = """
drift_summary AS (
  SELECT count(DISTINCT feature) AS n_features_monitored, coalesce(avg(psi), 0) AS avg_feature_psi,
         count(DISTINCT feature) FILTER (WHERE psi >= 2e-1) AS n_features_high_drift,
         coalesce(string_agg(DISTINCT CASE WHEN psi >= 2e-1 THEN feature END, ',' ORDER BY CASE WHEN psi >= 2e-1 THEN feature END), '') AS features_high_drift
  FROM drift)"""


@query("drift_summary", f"""
WITH {drift_cte(True)},{DRIFT_SUMMARY},
top AS (SELECT feature, avg(psi) AS avg_psi FROM drift GROUP BY feature ORDER BY avg_psi DESC, feature LIMIT 5)
SELECT n_features_monitored, {r('avg_feature_psi')} AS avg_feature_psi, features_high_drift, n_features_high_drift,
       (SELECT string_agg(feature, ',' ORDER BY avg_psi DESC, feature) FROM top) AS top_drifting_features
FROM drift_summary""")
def drift_summary(spark, sf):
    s = stability.drift_summary(scaled_drift(spark, sf))
    return present(s.select(
        "n_features_monitored", "avg_feature_psi",
        F.array_join("features_high_drift", ",").alias("features_high_drift"),
        "n_features_high_drift",
        F.array_join(F.transform("top_drifting_features", lambda x: x["feature"]), ",").alias("top_drifting_features"),
    ))


@query("top_drifting_features", f"""
WITH {drift_cte(True)}
SELECT feature, {r('avg(psi)')} AS avg_psi FROM drift GROUP BY feature ORDER BY avg(psi) DESC, feature LIMIT 3""")
def top_drifting_features(spark, sf):
    return present(stability.drift_by_feature(scaled_drift(spark, sf), top_k=3))


@query("high_drift_rows", f"""
WITH {drift_cte(True)}
SELECT {d('date')} AS date, feature, {r('psi')} AS psi FROM drift WHERE psi >= 1e-1""")
def high_drift_rows(spark, sf):
    return present(
        stability.rows_at_or_above(scaled_drift(spark, sf), "psi", 0.1).select("date", "feature", "psi")
    )


@query("drift_matrix", f"""
WITH {drift_cte(True)},
grid AS (SELECT feature, date FROM (SELECT DISTINCT feature FROM drift), (SELECT DISTINCT date FROM drift))
SELECT feature, {d('date')} AS date, {r('psi')} AS psi FROM grid LEFT JOIN drift USING (feature, date)""")
def drift_matrix(spark, sf):
    """The matrix over all dates found, read back cell by cell."""
    drift = scaled_drift(spark, sf).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    wide = stability.drift_matrix(cut_lineage(drift, "drift"))
    return present(wide.unpivot(["feature"], wide.columns[1:], "date", "psi"))


@query("monitored_features", f"""
WITH {st.line_store_sql(True)},
importance AS (
  SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'Customer_ID']) AS feature,
         unnest([count(l_quantity), count(l_extendedprice), count(l_discount), count(l_tax), count(Customer_ID)]) AS importance
  FROM store)
SELECT feature, importance FROM importance WHERE feature IN (
  SELECT feature FROM importance ORDER BY importance DESC, feature LIMIT 4) AND feature <> 'Customer_ID'""")
def monitored_features(spark, sf):
    """Importance here is how complete a column is; the text key ranks but is not numeric."""
    store = st.line_store(spark, sf, scaled=True)
    columns = [*st.STORE_FEATURES, "Customer_ID"]
    importance = store.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], columns, "feature", "importance")
    names = stability.top_numeric_features(importance, store.schema, top_n=4)
    return present(importance.where(F.col("feature").isin(*names)))


_STATS = ["avg_probability", "std_probability", "min_probability", "max_probability",
          "predicted_default_rate", "median_probability"]


@query("monthly_score_stats", f"""
WITH {st.PREDICTIONS},
banded AS (SELECT *, CASE WHEN default_probability > 0 AND default_probability <= 3e-1 THEN 'Low Risk'
                          WHEN default_probability > 3e-1 AND default_probability <= 7e-1 THEN 'Medium Risk'
                          WHEN default_probability > 7e-1 AND default_probability <= 1 THEN 'High Risk' END AS cat
           FROM predictions),
s AS (SELECT inference_date, count(Customer_ID) AS n_customers, avg(default_probability) AS avg_probability,
             stddev_samp(default_probability) AS std_probability, min(default_probability) AS min_probability,
             max(default_probability) AS max_probability, avg(predicted_default) AS predicted_default_rate,
             quantile_cont(default_probability, 0.5) AS median_probability,
             count(*) FILTER (WHERE cat = 'Low Risk') * 100e0 / count(cat) AS low,
             count(*) FILTER (WHERE cat = 'Medium Risk') * 100e0 / count(cat) AS mid,
             count(*) FILTER (WHERE cat = 'High Risk') * 100e0 / count(cat) AS high
      FROM banded GROUP BY inference_date)
SELECT {d('inference_date')} AS inference_date, n_customers, {rounded(_STATS)},
       {r('low')} AS "pct_Low Risk", {r('mid')} AS "pct_Medium Risk", {r('high')} AS "pct_High Risk" FROM s""")
def monthly_score_stats(spark, sf):
    p = st.predictions(spark, sf).withColumn(
        "risk_category", band_right_closed(F.col("default_probability"), rules.RISK_EDGES, rules.RISK_NAMES)
    )
    found = quality.score_statistics(
        p, "inference_date", "Customer_ID", "default_probability", "predicted_default", "risk_category")
    share = lambda name: F.coalesce(F.get(F.map_values(F.map_filter("category_percents", lambda k, _: k == name)), F.lit(0)), F.lit(0.0))
    return present(found.select("*", *[share(x).alias(f"pct_{x}") for x in rules.RISK_NAMES]).drop("category_percents"))


@query("category_shares_many", """
WITH counted AS (SELECT year(l_shipdate) AS year, CAST(l_partkey AS VARCHAR) AS category, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY ALL)
SELECT CAST(year AS BIGINT) AS year, category, n, """+r('n * 100e0 / sum(n) OVER (PARTITION BY year)')+""" AS percent FROM counted""")
def category_shares_many(spark, sf):
    """A category of any number of values, in long form."""
    lines = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), "l_partkey")
    return present(quality.category_shares(lines, "year", "l_partkey"))


@query("category_share_pivot", f"""
WITH {st.SCORES},
grid AS (SELECT inference_date, event_type FROM (SELECT DISTINCT inference_date FROM scores), (SELECT DISTINCT event_type FROM scores WHERE event_type IS NOT NULL)),
counted AS (SELECT inference_date, event_type, count(*) AS n FROM scores GROUP BY ALL),
total AS (SELECT inference_date, count(event_type) AS n FROM scores GROUP BY inference_date)
SELECT {d('g.inference_date')} AS inference_date, event_type, {r('coalesce(c.n, 0) * 100e0 / t.n')} AS pct
FROM grid g LEFT JOIN counted c USING (inference_date, event_type) JOIN total t USING (inference_date)""")
def category_share_pivot(spark, sf):
    """The wide table over all categories found, read back cell by cell."""
    wide = quality.category_shares_wide(st.scores(spark, sf), "inference_date", "event_type", prefix="")
    return present(wide.unpivot(["inference_date"], wide.columns[1:], "event_type", "pct"))


@query("run_statistics", f"""
WITH {st.SCORES}
SELECT count(*) AS n_scored, {r('avg(default_probability)')} AS avg_probability, {r('min(default_probability)')} AS min_probability,
       {r('max(default_probability)')} AS max_probability, count(*) FILTER (WHERE predicted_default = 1) AS n_predicted,
       {r('avg(predicted_default)')} AS predicted_default_rate, {d('min(inference_date)')} AS first_period,
       {d('max(inference_date)')} AS last_period, count(DISTINCT inference_date) AS n_periods
FROM scores""")
def run_statistics(spark, sf):
    return present(quality.run_statistics(
        st.scores(spark, sf), "inference_date", "default_probability", "predicted_default"))


def _box_sql(source: str, key: str, v: str) -> str:
    return f"""
q AS (SELECT {key}, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.75) AS q3
      FROM {source} GROUP BY {key}),
box AS (
  SELECT s.{key}, count(s.{v}) AS n, avg(s.{v}) AS mean, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
         least(min(CASE WHEN s.{v} >= q1 - 1.5e0 * (q3 - q1) THEN s.{v} END), any_value(q1)) AS whisker_low,
         greatest(max(CASE WHEN s.{v} <= q3 + 1.5e0 * (q3 - q1) THEN s.{v} END), any_value(q3)) AS whisker_high
  FROM {source} s JOIN q USING ({key}) GROUP BY s.{key})"""


@query("box_stats", f"""
WITH {st.SCORES},{_box_sql('scores', 'inference_date', 'default_probability')}
SELECT {d('inference_date')} AS inference_date, n, {rounded(['mean', 'q1', 'median', 'q3', 'whisker_low', 'whisker_high'])}
FROM box""")
def box_stats(spark, sf):
    return present(evaluate.box_stats(st.scores(spark, sf), ["inference_date"], "default_probability"))


@query("score_histogram", f"""
WITH {st.SCORES},
ends AS (SELECT inference_date, default_probability AS s FROM scores
         WHERE inference_date IN ((SELECT min(inference_date) FROM scores), (SELECT max(inference_date) FROM scores))),
found AS (SELECT inference_date, min(s) AS lo, max(s) AS hi, count(*) AS total FROM ends GROUP BY inference_date),
ranges AS (SELECT inference_date, CASE WHEN lo = hi THEN lo - 5e-1 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 5e-1 ELSE hi END AS hi, total FROM found),
grid AS (SELECT inference_date, i AS bin, total, (hi - lo) / 50e0 AS width, lo + i * ((hi - lo) / 50e0) AS low,
                CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 50e0) END AS high
         FROM ranges, (SELECT unnest(range(50)) AS i))
SELECT {d('g.inference_date')} AS inference_date, g.bin, {r('any_value(g.low)')} AS bin_low, count(e.s) AS n,
       {r('count(e.s) / (any_value(total) * any_value(width))')} AS density
FROM grid g LEFT JOIN ends e
  ON e.inference_date = g.inference_date AND e.s >= g.low AND (e.s < g.high OR (g.bin = 49 AND e.s = g.high))
GROUP BY g.inference_date, g.bin""")
def score_histogram(spark, sf):
    return present(evaluate.score_histogram(st.scores(spark, sf), "default_probability", "inference_date"))


@query("score_histogram_constant", f"""
WITH {st.SCORES},
ends AS (SELECT inference_date, CASE WHEN inference_date = (SELECT min(inference_date) FROM scores) THEN 25e-2 ELSE default_probability END AS s FROM scores
         WHERE inference_date IN ((SELECT min(inference_date) FROM scores), (SELECT max(inference_date) FROM scores))),
found AS (SELECT inference_date, min(s) AS lo, max(s) AS hi, count(*) AS total FROM ends GROUP BY inference_date),
ranges AS (SELECT inference_date, CASE WHEN lo = hi THEN lo - 5e-1 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 5e-1 ELSE hi END AS hi, total FROM found),
grid AS (SELECT inference_date, i AS bin, total, (hi - lo) / 50e0 AS width, lo + i * ((hi - lo) / 50e0) AS low,
                CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 50e0) END AS high
         FROM ranges, (SELECT unnest(range(50)) AS i))
SELECT {d('g.inference_date')} AS inference_date, g.bin, {r('any_value(g.low)')} AS bin_low, count(e.s) AS n,
       {r('count(e.s) / (any_value(total) * any_value(width))')} AS density
FROM grid g LEFT JOIN ends e
  ON e.inference_date = g.inference_date AND e.s >= g.low AND (e.s < g.high OR (g.bin = 49 AND e.s = g.high))
GROUP BY g.inference_date, g.bin""")
def score_histogram_constant(spark, sf):
    """The first period has one score only."""
    scores = st.scores(spark, sf)
    first = scores.agg(F.min("inference_date")).scalar()
    constant = F.when(F.col("inference_date") == first, 0.25).otherwise(F.col("default_probability"))
    return present(evaluate.score_histogram(scores.withColumn("default_probability", constant), "default_probability", "inference_date"))
