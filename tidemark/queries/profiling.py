"""Column profiles, key and bounds checks, correlation, quality per period."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import month_of
from tidemark.functions.numbers import numeric_columns
from tidemark.operators import profile, quality
from tidemark.queries import standins as st
from tidemark.queries.alerting import ORDER_COLUMNS, quality_cte
from tidemark.queries.base import present, query, table
from tidemark.queries.cleaning import DIRTY_PART, dirty_part
from tidemark.queries.sqltext import d, r, rounded
from tidemark.session import cut_lineage


def _profile_cte(columns: list[str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, (count(*) - count({c})) * 100e0 / count(*) AS missing_percent FROM store"
        for c in columns)
    return f"profile AS ({rows})"


@query("null_profile", f"""
WITH {st.ORDER_STORE},{_profile_cte(ORDER_COLUMNS)}
SELECT column_name, missing_count, {r('missing_percent')} AS missing_percent FROM profile""")
def null_profile(spark, sf):
    return present(profile.null_profile(st.order_store(spark, sf)))


@query("columns_with_missing", f"""
WITH {st.ORDER_STORE},{_profile_cte(ORDER_COLUMNS)}
SELECT column_name, missing_count, {r('missing_percent')} AS missing_percent FROM profile WHERE missing_percent > 5""")
def columns_with_missing(spark, sf):
    return present(profile.columns_with_missing(profile.null_profile(st.order_store(spark, sf)), 5.0))


@query("acceptance_bands", f"""
WITH {st.ORDER_STORE},{_profile_cte(ORDER_COLUMNS)}
SELECT column_name, missing_count, {r('missing_percent')} AS missing_percent,
       CASE WHEN missing_percent < 9 THEN 'PASS' WHEN missing_percent = 100 THEN 'FAIL' ELSE 'PARTIAL' END AS verdict FROM profile""")
def acceptance_bands(spark, sf):
    return present(profile.acceptance(profile.null_profile(st.order_store(spark, sf)), accept_below=9.0))


_DESCRIBED = st.STORE_FEATURES


@query("describe_columns", f"""
WITH {st.line_store_sql()}
{' UNION ALL '.join(f'''SELECT '{c}' AS column_name, count({c}) AS n, {r(f'avg({c})', 4)} AS mean, {r(f'stddev_samp({c})', 4)} AS std, {r(f'min({c})', 4)} AS min,
  {r(f'quantile_cont({c}, 0.25)', 4)} AS q25, {r(f'quantile_cont({c}, 0.5)', 4)} AS q50, {r(f'quantile_cont({c}, 0.75)', 4)} AS q75, {r(f'max({c})', 4)} AS max FROM store''' for c in _DESCRIBED)}""")
def describe_columns(spark, sf):
    return present(profile.describe_columns(st.line_store(spark, sf), _DESCRIBED), digits=4)


def _quality_sql(c: str, v: str, source: str) -> str:
    return f"""SELECT '{c}' AS column_name, any_value(nulls) AS null_count, {r('any_value(nulls) * 100e0 / any_value(total)', 1)} AS null_percent,
  any_value(bad) AS non_numeric, count(*) FILTER (WHERE v < q1 - 3 * (q3 - q1) OR v > q3 + 3 * (q3 - q1)) AS extreme_outliers,
  {r('min(v)', 4)} AS min, {r('max(v)', 4)} AS max
FROM (SELECT {v} AS v, quantile_cont({v}, 0.25) OVER () AS q1, quantile_cont({v}, 0.75) OVER () AS q3,
             count(*) OVER () AS total, count(*) OVER () - count({c}) OVER () AS nulls,
             count({c}) OVER () - count({v}) OVER () AS bad FROM {source})"""


@query("numeric_quality", f"""
WITH {st.line_store_sql()},
skewed AS (SELECT * REPLACE (CASE WHEN Customer_ID LIKE '%7' THEN l_extendedprice * 40 ELSE l_extendedprice END AS l_extendedprice) FROM store)
{' UNION ALL '.join(_quality_sql(c, c, 'skewed') for c in _DESCRIBED)}""")
def numeric_quality(spark, sf):
    store = st.line_store(spark, sf).withColumn(
        "l_extendedprice",
        F.when(F.col("Customer_ID").endswith("7"), F.col("l_extendedprice") * 40).otherwise(F.col("l_extendedprice")))
    return present(profile.numeric_quality(store, _DESCRIBED), digits=4)


@query("text_numeric_quality", f"""
WITH {DIRTY_PART} {_quality_sql('raw', 'TRY_CAST(raw AS DOUBLE)', 'dirty')}
UNION ALL {_quality_sql('p_retailprice', 'p_retailprice', 'dirty')}""")
def text_numeric_quality(spark, sf):
    return present(profile.numeric_quality(dirty_part(spark, sf), ["raw", "p_retailprice"]), digits=4)


@query("categorical_profile", f"""
WITH {st.ORDER_STORE}
{' UNION ALL '.join(f'''SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, {r(f'(count(*) - count({c})) * 100e0 / count(*)', 1)} AS null_percent,
  count(DISTINCT {c}) AS n_unique FROM store''' for c in ['Customer_ID', 'o_orderpriority', 'o_orderstatus'])}""")
def categorical_profile(spark, sf):
    return present(profile.categorical_profile(
        st.order_store(spark, sf), ["Customer_ID", "o_orderpriority", "o_orderstatus"]))


@query("distinct_sketches", f"""
WITH {st.ORDER_STORE}
{' UNION ALL '.join(f'''SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, {r(f'(count(*) - count({c})) * 100e0 / count(*)', 1)} AS null_percent,
  true AS within_error FROM store''' for c in ['Customer_ID', 'o_orderpriority', 'o_orderstatus', 'o_totalprice'])}""")
def distinct_sketches(spark, sf):
    """The profile from one stored sketch a snapshot and column, its distinct counts held against exact ones."""
    columns = ["Customer_ID", "o_orderpriority", "o_orderstatus", "o_totalprice"]
    store = st.order_store(spark, sf)
    states = cut_lineage(profile.distinct_states(store, "snapshot_date", columns), "distinct-states")
    exact = profile.categorical_profile(store, columns).select("column_name", F.col("n_unique").alias("exact"))
    near = F.abs(F.col("n_unique") - F.col("exact")) <= profile.distinct_error() * F.col("exact")
    found = profile.categorical_profile_from_states(states).join(exact, "column_name")
    return present(found.select("column_name", "null_count", "null_percent", near.alias("within_error")))


def _outcome_table(spark, sf):
    return st.outcomes(spark, sf).withColumnRenamed("label_date", "snapshot_date")


@query("key_checks", f"""
WITH {st.OUTCOMES}
SELECT count(DISTINCT loan_id) + CAST(count(loan_id) < count(*) AS INTEGER) = count(*) AS key_is_unique, count(DISTINCT Customer_ID) AS n_entities,
       count(*) AS n_rows, count(DISTINCT label_date) AS n_dates, {d('min(label_date)')} AS first_date, {d('max(label_date)')} AS last_date,
       (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT CAST(dayofmonth(label_date) AS VARCHAR) AS x FROM outcomes)) AS snapshot_days
FROM outcomes""")
def key_checks(spark, sf):
    checked = profile.key_checks(_outcome_table(spark, sf), "loan_id", "Customer_ID", "snapshot_date")
    return present(checked.withColumn("snapshot_days", F.array_join("snapshot_days", ",")))


@query("repeated_keys", """
SELECT l_orderkey, l_linenumber, count(*) - 1 AS n_extra FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def repeated_keys(spark, sf):
    return present(quality.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query("label_domain", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE quality NOT IN (0, 1) OR quality IS NULL) AS n_outside,
       count(*) FILTER (WHERE quality NOT IN (0, 1) OR quality IS NULL) = 0 AS all_inside FROM labels""")
def label_domain(spark, sf):
    return present(profile.domain_check(table(spark, sf, "labels"), "quality", [0, 1]))


_BOUNDS = {"l_quantity": (0, 50), "l_extendedprice": (0, 50000), "l_discount": (0, 1), "l_tax": (0.02, 1)}


def _bounds_sql(bounds: dict, source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST({lo} AS DOUBLE) AS expected_min, CAST({hi} AS DOUBLE) AS expected_max, {r(f'min({c})', 4)} AS actual_min,
  {r(f'max({c})', 4)} AS actual_max, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS outside_bounds,
  CASE WHEN count({c}) = 0 THEN 'ALL NULL' WHEN count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"""
        for c, (lo, hi) in bounds.items())


@query("bounds_check", f"""
WITH {st.line_store_sql()} {_bounds_sql(_BOUNDS, 'store')}
UNION ALL SELECT 'l_missing', 0, 1, NULL, NULL, 0, 'NOT FOUND'""")
def bounds_check(spark, sf):
    return present(profile.bounds_check(st.line_store(spark, sf), _BOUNDS | {"l_missing": (0, 1)}), digits=4)


@query("bounds_summary", f"""
WITH {st.line_store_sql()}, checked AS ({_bounds_sql(_BOUNDS, 'store')})
SELECT count(*) FILTER (WHERE status = 'PASS') AS n_passed, count(*) AS n_checked, count(*) FILTER (WHERE status = 'PASS') = count(*) AS all_passed FROM checked""")
def bounds_summary(spark, sf):
    return present(profile.bounds_summary(profile.bounds_check(st.line_store(spark, sf), _BOUNDS)))


_SANE = {"l_quantity": (-1e10, 1e10), "l_extendedprice": (0, 10000000)}


@query("sanity_check", f"WITH {st.line_store_sql()} {_bounds_sql(_SANE, 'store')}")
def sanity_check(spark, sf):
    return present(profile.bounds_check(st.line_store(spark, sf), _SANE), digits=4)


@query("type_check", f"""
SELECT 'p_size' AS column_name, 'integer' AS found_type, 'PASS' AS status, count(*) - count(p_size) AS null_count,
       {r('(count(*) - count(p_size)) * 100e0 / count(*)')} AS null_percent, {r('min(p_size)')} AS min, {r('max(p_size)')} AS max,
       {r('avg(p_size)')} AS mean, true AS median_within_error
FROM part""")
def type_check(spark, sf):
    """The median is approximate: its rank may be off by a 10,000th of the rows, and by no more."""
    parts = table(spark, sf, "part")
    checked = profile.type_check(parts, "p_size", ["integer", "long"])
    median = checked.select("approx_median").scalar()
    # Ranks that the value takes up, against the middle one.
    ranks = parts.agg(
        F.count_if(F.col("p_size") < median).alias("below"), F.count_if(F.col("p_size") <= median).alias("upto"), F.count("p_size").alias("n"))
    allowed, middle = F.col("n") / 10000 + 1, F.col("n") / 2
    close = ranks.select(((F.col("below") <= middle + allowed) & (F.col("upto") >= middle - allowed)).alias("ok")).scalar()
    return present(checked.drop("approx_median").withColumn("median_within_error", close))


@query("type_check_exact_part", f"""
WITH {DIRTY_PART}
SELECT 'raw' AS column_name, 'string' AS found_type, 'FAIL' AS status, count(*) - count(raw) AS null_count,
       {r('(count(*) - count(raw)) * 100e0 / count(*)')} AS null_percent, {r('min(TRY_CAST(raw AS DOUBLE))')} AS min,
       {r('max(TRY_CAST(raw AS DOUBLE))')} AS max, {r('avg(TRY_CAST(raw AS DOUBLE))')} AS mean
FROM dirty""")
def type_check_exact_part(spark, sf):
    return present(profile.type_check(dirty_part(spark, sf), "raw", ["integer", "long"]).drop("approx_median"))


@query("monthly_null_rate", f"""
SELECT {d("date_trunc('month', o_orderdate)")} AS month, {r("count(*) FILTER (WHERE o_orderkey % 7 = 0) * 100e0 / count(*)", 1)} AS null_percent, count(*) AS n_rows,
       CASE WHEN round(count(*) FILTER (WHERE o_orderkey % 7 = 0) * 100e0 / count(*), 1) < 10 THEN 'PASS'
            WHEN round(count(*) FILTER (WHERE o_orderkey % 7 = 0) * 100e0 / count(*), 1) > 20 THEN 'FAIL' ELSE 'PARTIAL' END AS verdict
FROM orders GROUP BY 1""")
def monthly_null_rate(spark, sf):
    rate = profile.null_rate_by_period(st.order_store(spark, sf), month_of(F.col("snapshot_date")), "o_totalprice")
    return present(profile.availability_verdict(rate, pass_below=10.0, fail_above=20.0))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net"]


def _corr_frame(spark, sf):
    return st.line_store(spark, sf).withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))


_CORR_CTE = f"""{st.line_store_sql()}, wide AS (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM store),
matrix AS ({' UNION ALL '.join(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS correlation FROM wide" for a in _CORR for b in _CORR)})"""


@query("correlation_long", f"""
WITH {_CORR_CTE} SELECT feature_1, feature_2, {r('correlation')} AS correlation FROM matrix""")
def correlation_long(spark, sf):
    return present(profile.correlation_long(_corr_frame(spark, sf), _CORR))


@query("high_corr_pairs", f"""
WITH {_CORR_CTE} SELECT feature_1, feature_2, {r('correlation')} AS correlation FROM matrix
WHERE abs(correlation) > 8e-1 AND list_position({_CORR}, feature_1) < list_position({_CORR}, feature_2)""")
def high_corr_pairs(spark, sf):
    return present(profile.high_correlations(profile.correlation_long(_corr_frame(spark, sf), _CORR), _CORR))


@query("class_shares", f"""
SELECT event_type, count(*) AS n, {r('count(*) * 100e0 / sum(count(*)) OVER ()', 2)} AS percentage FROM events GROUP BY event_type""")
def class_shares(spark, sf):
    return present(profile.class_shares(table(spark, sf, "events"), "event_type"))


@query("data_quality_by_period", f"""
WITH {st.ORDER_STORE},{quality_cte('store', ORDER_COLUMNS)}
SELECT {d('month')} AS month, n_rows, {r('missing_rate_pct')} AS missing_rate_pct, n_duplicates FROM quality""")
def data_quality_by_period(spark, sf):
    return present(quality.quality_by_period(st.order_store(spark, sf), "snapshot_date", "Customer_ID"))


@query("data_quality_summary", f"""
WITH {st.ORDER_STORE},{quality_cte('store', ORDER_COLUMNS)}
SELECT {rounded(['avg_missing_rate_pct', 'max_missing_rate_pct'])}, {d('max_missing_rate_date')} AS max_missing_rate_date,
       {r('avg_rows_per_month')} AS avg_rows_per_month, total_duplicates FROM quality_summary""")
def data_quality_summary(spark, sf):
    return present(quality.quality_summary(
        quality.quality_by_period(st.order_store(spark, sf), "snapshot_date", "Customer_ID")))


@query("numeric_column_nulls", f"""
WITH {st.line_store_sql()}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, {r(f'(count(*) - count({c})) * 100e0 / count(*)')} AS missing_percent FROM store" for c in _DESCRIBED)}""")
def numeric_column_nulls(spark, sf):
    store = st.line_store(spark, sf)
    return present(profile.null_profile(store, numeric_columns(store.schema)))
