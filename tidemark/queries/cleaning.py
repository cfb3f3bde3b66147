"""Snapshot scans and the single cleaning expressions on star-schema columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import bands, dates, numbers, text
from tidemark.operators import features, quality
from tidemark.plans import rules
from tidemark.queries import standins as st
from tidemark.queries.base import present, query, table
from tidemark.queries.sqltext import d, r
from tidemark.sources import readers


@query("snapshot_scan", f"""
SELECT o_orderkey, o_custkey, {r('o_totalprice', 2)} AS o_totalprice, {d('o_orderdate')} AS o_orderdate
FROM orders WHERE o_orderdate = DATE '1996-03-01'""")
def snapshot_scan(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return present(readers.snapshot(orders, "o_orderdate", "1996-03-01"), digits=2)


@query("snapshot_counts", f"""
SELECT {d("date_trunc('month', o_orderdate)")} AS snapshot_date, count(*) AS n_rows FROM orders GROUP BY 1""")
def snapshot_counts(spark, sf):
    orders = table(spark, sf, "orders").select(dates.month_of(F.col("o_orderdate")).alias("snapshot_date"))
    return present(quality.snapshot_counts(orders, "snapshot_date"))


@query("snapshots_since", f"""
SELECT {d("date_trunc('month', o_orderdate)")} AS snapshot_date, count(*) AS n_rows
FROM orders WHERE o_orderdate >= DATE '2000-02-01' GROUP BY 1""")
def snapshots_since(spark, sf):
    late = readers.since(table(spark, sf, "orders"), "o_orderdate", "2000-02-01")
    return present(quality.snapshot_counts(
        late.select(dates.month_of(F.col("o_orderdate")).alias("snapshot_date")), "snapshot_date"))


def dirty_part(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(k % 10 == 0, F.concat(F.lit("_"), size, F.lit("_"))).when(k % 10 == 1, F.concat(size, F.lit(".0")))
        .when(k % 10 == 2, F.concat(size, F.lit(".75"))).when(k % 10 == 3, "_").when(k % 10 == 4, "n/a")
        .when(k % 10 == 5, None).when(k % 10 == 6, F.concat(F.lit("-"), size)).otherwise(size).alias("raw"),
        "p_type", "p_brand", "p_size", "p_retailprice",
    )


DIRTY_PART = """
dirty AS (
  SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN '_' || p_size || '_' WHEN 1 THEN p_size || '.0' WHEN 2 THEN p_size || '.75'
           WHEN 3 THEN '_' WHEN 4 THEN 'n/a' WHEN 5 THEN NULL WHEN 6 THEN '-' || p_size ELSE CAST(p_size AS VARCHAR) END AS raw,
         p_type, p_brand, p_size, p_retailprice FROM part)"""


@query("clean_numeric_text", f"""
WITH {DIRTY_PART}
SELECT p_partkey, replace(raw, '_', '') AS stripped, {r("TRY_CAST(replace(raw, '_', '') AS DOUBLE)")} AS as_double,
       CAST(trunc(TRY_CAST(replace(raw, '_', '') AS DOUBLE)) AS DOUBLE) AS as_int,
       raw IS NOT NULL AND TRY_CAST(replace(raw, '_', '') AS DOUBLE) IS NULL AS not_a_number
FROM dirty""")
def clean_numeric_text(spark, sf):
    stripped = text.strip_token(F.col("raw"))
    return present(dirty_part(spark, sf).select(
        "p_partkey", stripped.alias("stripped"), stripped.try_cast("double").alias("as_double"),
        numbers.lenient_int(stripped).alias("as_int"), text.non_numeric(stripped).alias("not_a_number"),
    ), as_double=["as_int"])


@query("sentinel_nulls", """
SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('P', '', '_') THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', '^5.*$') THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def sentinel_nulls(spark, sf):
    return present(table(spark, sf, "orders").select(
        "o_orderkey",
        text.null_if_in(F.col("o_orderstatus"), ["P", "", "_"]).alias("o_orderstatus"),
        text.null_if_in(F.col("o_orderpriority"), ["4-NOT SPECIFIED", "^5.*$"]).alias("o_orderpriority"),
    ))


@query("whitelist_category", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN c_mktsegment END AS c_mktsegment FROM customer""")
def whitelist_category(spark, sf):
    return present(table(spark, sf, "customer").select(
        "c_custkey", text.keep_if_in(F.col("c_mktsegment"), ["HOUSEHOLD", "MACHINERY"]).alias("c_mktsegment")))


@query("range_guards", f"""
SELECT c_custkey, {r('CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal END', 2)} AS in_range,
       {r('CASE WHEN c_acctbal >= 0 THEN c_acctbal END', 2)} AS non_negative FROM customer""")
def range_guards(spark, sf):
    balance = F.col("c_acctbal")
    return present(table(spark, sf, "customer").select(
        "c_custkey",
        numbers.within(balance, 0, 5000).alias("in_range"),
        numbers.within(balance, 0, None).alias("non_negative"),
    ), digits=2)


@query("regex_mask", f"""
WITH {st.RAW_ATTRIBUTES}
SELECT Customer_ID, SSN, regexp_matches(SSN, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') AS valid,
       CASE WHEN regexp_matches(SSN, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') THEN SSN END AS masked FROM raw_attributes""")
def regex_mask(spark, sf):
    return present(st.raw_attributes(spark, sf).select(
        "Customer_ID", "SSN", F.col("SSN").rlike(rules.SSN_PATTERN).alias("valid"),
        text.keep_if_matches(F.col("SSN"), rules.SSN_PATTERN).alias("masked"),
    ))


@query("value_bands", """
SELECT p_partkey, CASE WHEN p_size < 15 THEN 'young' WHEN p_size < 30 THEN 'middle' ELSE 'old' END AS size_band,
       CASE WHEN p_partkey % 6 = 0 THEN 'very_low' WHEN p_size > 40 THEN 'critical' WHEN p_size > 20 THEN 'high' ELSE 'very_low' END AS risk_band
FROM part""")
def value_bands(spark, sf):
    size = F.col("p_size")
    gappy = F.when(F.col("p_partkey") % 6 != 0, size)
    return present(table(spark, sf, "part").select(
        "p_partkey",
        bands.band_below(size, [(15, "young"), (30, "middle")], "old").alias("size_band"),
        bands.band_above(gappy, [(40, "critical"), (20, "high")], "very_low").alias("risk_band"),
    ))


@query("category_map", """
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'None' WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'home'
  WHEN c_mktsegment = 'MACHINERY' THEN 'works' ELSE 'other' END AS segment_group FROM customer""")
def category_map(spark, sf):
    gappy = F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment"))
    return present(table(spark, sf, "customer").select(
        "c_custkey",
        text.map_categories(gappy, {"home": ["HOUSEHOLD", "FURNITURE"], "works": ["MACHINERY"]}, "None", "other")
        .alias("segment_group"),
    ))


@query("risk_bands", f"""
WITH {st.SCORES}
SELECT risk_category, count(*) AS n, {r('min(default_probability)')} AS low, {r('max(default_probability)')} AS high
FROM scores GROUP BY risk_category""")
def risk_bands(spark, sf):
    return present(st.scores(spark, sf).groupBy("risk_category").agg(
        F.count("*").alias("n"), F.min("default_probability").alias("low"), F.max("default_probability").alias("high")))


@query("horizontal_activity", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {r('CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END + (l_discount - 5e-2) + l_tax')} AS total,
       {r('abs(CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END) + abs(l_discount - 5e-2) + abs(l_tax)')} AS total_abs,
       CASE WHEN l_partkey % 7 <> 0 AND l_quantity <> 0 THEN 1 ELSE 0 END + CASE WHEN l_discount - 5e-2 <> 0 THEN 1 ELSE 0 END
         + CASE WHEN l_tax <> 0 THEN 1 ELSE 0 END AS n_nonzero
FROM lineitem""")
def horizontal_activity(spark, sf):
    cols = [F.when(F.col("l_partkey") % 7 != 0, F.col("l_quantity")), F.col("l_discount") - 0.05, F.col("l_tax")]
    return present(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.row_sum(cols).alias("total"),
        numbers.row_sum([F.abs(c) for c in cols]).alias("total_abs"),
        numbers.row_nonzero(cols).alias("n_nonzero"),
    ))


@query("duration_months", """
SELECT p_partkey, CAST(CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN NULL ELSE p_size * 12 + p_partkey % 12 END AS DOUBLE) AS months
FROM part""")
def duration_months(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    span = F.when(k % 5 == 0, None).when(k % 5 == 1, F.concat(size, F.lit(" Years"))).otherwise(
        F.concat(size, F.lit(" Years and "), (k % 12).cast("string"), F.lit(" Months")))
    return present(table(spark, sf, "part").select("p_partkey", dates.span_in_months(span).alias("months")),
                   as_double=["months"])


@query("guarded_ratio", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {r('CASE WHEN l_tax > 0 THEN l_discount / l_tax END')} AS ratio,
       {r('(l_quantity - l_discount) / (abs(l_discount) + 1e-10) * 100', 0)} AS change_pct
FROM lineitem""")
def guarded_ratio(spark, sf):
    lines = table(spark, sf, "lineitem")
    return present(lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.ratio_if_positive(F.col("l_discount"), F.col("l_tax")).alias("ratio"),
        F.round(numbers.percent_change(F.col("l_quantity"), F.col("l_discount")), 0).alias("change_pct"),
    ))


@query("date_parts", f"""
SELECT dayofmonth(o_orderdate) AS day_of_month, {d("date_trunc('month', o_orderdate)")} AS month,
       strftime(o_orderdate, '%Y-%m') AS label, {d("CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE)")} AS previous_month,
       count(*) AS n
FROM orders GROUP BY ALL""")
def date_parts(spark, sf):
    day = F.col("o_orderdate").cast("date")
    month = dates.month_of(day)
    return present(table(spark, sf, "orders").groupBy(
        F.dayofmonth(day).alias("day_of_month"), month.alias("month"),
        F.date_format(day, "yyyy-MM").alias("label"), features.previous_month(month).alias("previous_month"),
    ).agg(F.count("*").alias("n")))


@query("month_gaps", """
SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey,
       (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS gap
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def month_gaps(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return present(lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        dates.month_gap(F.col("l_shipdate"), F.col("o_orderdate")).alias("gap")))


_LOAN_NUMBERS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
LOAN_SELECT = f"""
SELECT loan_id, Customer_ID, {d('loan_start_date')} AS loan_start_date, tenure, installment_num,
       {', '.join(f'{r(c, 4)} AS {c}' for c in _LOAN_NUMBERS)}, {d('snapshot_date')} AS snapshot_date, mob, installments_missed,
       {d('first_missed_date')} AS first_missed_date, CAST(dpd AS DOUBLE) AS dpd
FROM loans"""


@query("loan_dpd", f"WITH {st.LOANS}{LOAN_SELECT}")
def loan_dpd(spark, sf):
    raw = st.raw_loans(spark, sf)
    typed = raw.select(*[F.col(c).cast(t).alias(c) for c, t in rules.LOAN_TYPES.items()])
    return present(features.loan_status(typed), digits=4, as_double=["dpd"])


LABEL_SELECT = f"""
SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def,
       {d('snapshot_date')} AS snapshot_date FROM loans WHERE mob = 6"""


@query("loan_labels", f"WITH {st.LOANS}{LABEL_SELECT}")
def loan_labels(spark, sf):
    raw = st.raw_loans(spark, sf)
    typed = raw.select(*[F.col(c).cast(t).alias(c) for c, t in rules.LOAN_TYPES.items()])
    return present(features.loan_labels(features.loan_status(typed)))


def weekly_clicks(spark, sf):
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("Customer_ID"),
        dates.week_of(F.col("ts")).alias("snapshot_date"),
        F.when(e % 31 != 0, (e % 21 - 10).cast("int")).alias("total_activity"),
        F.abs(e % 21 - 10).cast("int").alias("activity_intensity"),
        (e % 5).cast("int").alias("active_features_count"),
    )


WEEKLY = """
clicks AS (
  SELECT CAST(user_id AS VARCHAR) AS Customer_ID, CAST(date_trunc('week', ts) AS DATE) AS snapshot_date,
         CASE WHEN event_id % 31 <> 0 THEN event_id % 21 - 10 END AS total_activity, abs(event_id % 21 - 10) AS activity_intensity,
         event_id % 5 AS active_features_count FROM events),
activity AS (
  SELECT Customer_ID, snapshot_date, count(*) AS visit_frequency, max(snapshot_date) AS last_activity_date,
         CAST(sum(total_activity) AS BIGINT) AS recent_total_activity, avg(activity_intensity) AS avg_activity_intensity,
         CAST(sum(active_features_count) AS BIGINT) AS total_active_features FROM clicks GROUP BY 1, 2)"""


@query("activity_rollup", f"""
WITH {WEEKLY}
SELECT Customer_ID, {d('snapshot_date')} AS snapshot_date, visit_frequency, {d('last_activity_date')} AS last_activity_date,
       CAST(recent_total_activity AS DOUBLE) AS recent_total_activity, {r('avg_activity_intensity')} AS avg_activity_intensity,
       total_active_features FROM activity""")
def activity_rollup(spark, sf):
    return present(features.activity_rollup(weekly_clicks(spark, sf)), as_double=["recent_total_activity"])


def customer_weeks(spark, sf):
    """Every customer at one of eight weeks; the weeks reach past both ends of the clicks."""
    week = F.date_add(F.lit("2023-12-25").cast("date"), ((F.col("c_custkey") % 8) * 7).cast("int"))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("Customer_ID"), week.alias("snapshot_date"), "c_mktsegment")


@query("lagged_activity_features", f"""
WITH {WEEKLY},
spine AS (SELECT CAST(c_custkey AS VARCHAR) AS Customer_ID,
                 CAST(DATE '2023-12-25' + to_days(CAST((c_custkey % 8) * 7 AS INTEGER)) AS DATE) AS snapshot_date, c_mktsegment FROM customer),
weeks AS (SELECT DISTINCT snapshot_date FROM clicks),
joined AS (
  SELECT s.*, w.snapshot_date IS NOT NULL AS has_prev, a.visit_frequency, a.last_activity_date, a.recent_total_activity,
         a.avg_activity_intensity, a.total_active_features
  FROM spine s LEFT JOIN weeks w ON w.snapshot_date = s.snapshot_date - 7
  LEFT JOIN activity a ON a.Customer_ID = s.Customer_ID AND a.snapshot_date = s.snapshot_date - 7)
SELECT Customer_ID, {d('snapshot_date')} AS snapshot_date, c_mktsegment,
       CAST(CASE WHEN has_prev THEN coalesce(visit_frequency, 0) ELSE visit_frequency END AS DOUBLE) AS visit_frequency,
       {d('last_activity_date')} AS last_activity_date,
       CAST(CASE WHEN has_prev THEN coalesce(recent_total_activity, 0) ELSE recent_total_activity END AS DOUBLE) AS recent_total_activity,
       {r('CASE WHEN has_prev THEN coalesce(avg_activity_intensity, 0) ELSE avg_activity_intensity END')} AS avg_activity_intensity,
       CAST(CASE WHEN has_prev THEN coalesce(total_active_features, 0) ELSE total_active_features END AS DOUBLE) AS total_active_features
FROM joined""")
def lagged_activity_features(spark, sf):
    clicks = weekly_clicks(spark, sf)
    activity = features.activity_rollup(clicks)
    measures = activity.columns[2:]
    joined = features.lagged_join(
        customer_weeks(spark, sf), activity, clicks.select("snapshot_date"), measures,
        features.ACTIVITY_ZERO_FILLED, previous=lambda c: F.date_sub(c, 7),
    )
    return present(joined, as_double=["visit_frequency", "recent_total_activity", "total_active_features"])


@query("health_score", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 4 <> 0 AND o_totalprice / 500000 < 3e-1 THEN 3 WHEN o_orderkey % 4 <> 0 AND o_totalprice / 500000 < 5e-1 THEN 2 ELSE 1 END
     + CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 110 < 30 THEN 2 WHEN o_orderkey % 5 <> 0 AND o_orderkey % 110 < 70 THEN 1 ELSE 0 END AS score
FROM orders""")
def health_score(spark, sf):
    k = F.col("o_orderkey")
    return present(table(spark, sf, "orders").select(
        "o_orderkey",
        features.health_score(
            F.when(k % 4 != 0, F.col("o_totalprice") / 500000), F.when(k % 5 != 0, k % 110)).alias("score")))
