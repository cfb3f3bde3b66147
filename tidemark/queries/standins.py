"""Credit-shaped tables derived from the star schema, and the same in SQL.

Each function takes whole tables; dirt (sentinels, suffixes, nulls) is added
by key arithmetic so that every cleaning rule meets values it must change.
The SQL texts are common table expressions without the leading WITH.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.bands import band_right_closed
from tidemark.functions.dates import month_of, week_of
from tidemark.plans import rules
from tidemark.queries.base import table


def _text(c: Column) -> Column:
    return c.cast("string")


def _month_from(start: str, months: Column) -> Column:
    return F.add_months(F.lit(start).cast("date"), months.cast("int"))


# --- scores: one prediction per event, weekly -------------------------------

def scores(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("value") / 100
    return table(spark, sf, "events").select(
        _text(F.col("user_id")).alias("Customer_ID"),
        week_of(F.col("ts")).alias("inference_date"),
        p.alias("default_probability"),
        F.when(p >= 0.5, 1).otherwise(0).alias("predicted_default"),
        band_right_closed(p, rules.RISK_EDGES, rules.RISK_NAMES).alias("risk_category"),
        "event_type",
    )


SCORES = """
scores AS (
  SELECT CAST(user_id AS VARCHAR) AS Customer_ID,
         CAST(date_trunc('week', ts) AS DATE) AS inference_date,
         value / 100 AS default_probability,
         CASE WHEN value / 100 >= 0.5 THEN 1 ELSE 0 END AS predicted_default,
         CASE WHEN value / 100 > 0 AND value / 100 <= 3e-1 THEN 'Low Risk'
              WHEN value / 100 > 3e-1 AND value / 100 <= 7e-1 THEN 'Medium Risk'
              WHEN value / 100 > 7e-1 AND value / 100 <= 1 THEN 'High Risk' END AS risk_category,
         event_type
  FROM events)"""


# --- predictions and labels by month ---------------------------------------

def predictions(spark: SparkSession, sf: str) -> DataFrame:
    p = (F.col("o_totalprice") % 1000) / 1000
    return table(spark, sf, "orders").select(
        _text(F.col("o_custkey")).alias("Customer_ID"),
        month_of(F.col("o_orderdate")).alias("inference_date"),
        p.alias("default_probability"),
        F.when(p >= 0.5, 1).otherwise(0).alias("predicted_default"),
    )


PREDICTIONS = """
predictions AS (
  SELECT CAST(o_custkey AS VARCHAR) AS Customer_ID,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS inference_date,
         (o_totalprice % 1000) / 1000 AS default_probability,
         CASE WHEN (o_totalprice % 1000) / 1000 >= 0.5 THEN 1 ELSE 0 END AS predicted_default
  FROM orders)"""


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    owners = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lines.join(owners, lines.l_orderkey == owners.o_orderkey).select(
        _text(F.col("o_custkey")).alias("Customer_ID"),
        month_of(F.col("l_shipdate")).alias("label_date"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("loan_id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.lit("30dpd_6mob").alias("label_def"),
    )


OUTCOMES = """
outcomes AS (
  SELECT CAST(o_custkey AS VARCHAR) AS Customer_ID,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS label_date,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS loan_id,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         '30dpd_6mob' AS label_def
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# All pairs in the window, ranked: the literal reading of the nearest match.
MATCHED = f"""{PREDICTIONS},{OUTCOMES},
pairs AS (
  SELECT p.*, o.label_date, o.loan_id, o.label, o.label_def,
         (year(o.label_date) - year(p.inference_date)) * 12
           + month(o.label_date) - month(p.inference_date) AS date_diff_months
  FROM predictions p JOIN outcomes o USING (Customer_ID)),
matched AS (
  SELECT * FROM pairs WHERE date_diff_months BETWEEN -6 AND 12
  QUALIFY row_number() OVER (
    PARTITION BY Customer_ID, inference_date
    ORDER BY abs(date_diff_months), label_date, loan_id, label,
             default_probability, predicted_default) = 1)"""


# --- a feature store: line items by ship year --------------------------------

STORE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def line_store(spark: SparkSession, sf: str, scaled: bool = False) -> DataFrame:
    """With ``scaled`` all features lie in [0, 1] and prices fall from year to year."""
    part = F.col("l_partkey")
    gaps = {
        "l_quantity": part % 7 == 0,
        "l_extendedprice": part % 11 == 3,
        "l_discount": part % 13 == 5,
        "l_tax": (part % 3 == 1) & (F.year("l_shipdate") == 1999),
    }
    unit = {
        "l_quantity": F.col("l_quantity") / 50,
        "l_extendedprice": F.col("l_extendedprice") / 105000 * (2005 - F.year("l_shipdate")) / 10,
    }
    return table(spark, sf, "lineitem").select(
        _text(F.col("l_orderkey")).alias("Customer_ID"),
        F.trunc(F.col("l_shipdate").cast("date"), "year").alias("snapshot_date"),
        *[
            F.when(~gap, unit.get(c, F.col(c)) if scaled else F.col(c)).alias(c)
            for c, gap in gaps.items()
        ],
    )


def line_store_sql(scaled: bool = False) -> str:
    q, e = ("l_quantity / 50", "l_extendedprice / 105000 * (2005 - year(l_shipdate)) / 10") if scaled else ("l_quantity", "l_extendedprice")
    return f"""
store AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS Customer_ID,
         CAST(date_trunc('year', l_shipdate) AS DATE) AS snapshot_date,
         CASE WHEN l_partkey % 7 <> 0 THEN {q} END AS l_quantity,
         CASE WHEN l_partkey % 11 <> 3 THEN {e} END AS l_extendedprice,
         CASE WHEN l_partkey % 13 <> 5 THEN l_discount END AS l_discount,
         CASE WHEN NOT (l_partkey % 3 = 1 AND year(l_shipdate) = 1999) THEN l_tax END AS l_tax
  FROM lineitem)"""


# --- orders with gaps, by month ----------------------------------------------

def order_store(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.when(k % 97 != 0, _text(F.col("o_custkey"))).alias("Customer_ID"),
        month_of(F.col("o_orderdate")).alias("snapshot_date"),
        F.when(k % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when((k % 5 != 0) | (F.year("o_orderdate") != 1996), F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 11 != 2, F.col("o_orderstatus")).alias("o_orderstatus"),
    )


ORDER_STORE = """
store AS (
  SELECT CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS Customer_ID,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 5 <> 0 OR year(o_orderdate) <> 1996 THEN o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderkey % 11 <> 2 THEN o_orderstatus END AS o_orderstatus
  FROM orders)"""


# --- documents scored against their labels -----------------------------------

def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id",
        "lang",
        "source",
        F.col("quality").alias("label"),
        F.col("n_chars").cast("double").alias("score"),
        F.when(F.col("n_chars") >= 600, 1).otherwise(0).alias("predicted"),
    )


SCORED_DOCUMENTS = """
scored AS (
  SELECT doc_id, lang, source, quality AS label, CAST(n_chars AS DOUBLE) AS score,
         CASE WHEN n_chars >= 600 THEN 1 ELSE 0 END AS predicted
  FROM documents JOIN labels USING (doc_id))"""


# --- raw credit tables -------------------------------------------------------

def raw_attributes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    age = _text(F.abs(F.col("c_acctbal")).cast("int") % 130)
    jobs = ["Doctor", "Lawyer", "Engineer", "Teacher", "Journalist", "Manager", "Entrepreneur",
            "Mechanic", "Accountant", "Musician", "_______"]
    return table(spark, sf, "customer").select(
        F.concat(F.lit("CUS_"), _text(k)).alias("Customer_ID"),
        F.col("c_name").alias("Name"),
        F.when(k % 41 == 7, None).when(k % 37 == 5, "-500").when(k % 19 == 3, F.concat(age, F.lit("_")))
        .otherwise(age).alias("Age"),
        F.when(k % 17 == 4, "#F%$D@*&8").otherwise(
            F.concat_ws("-", F.lpad(_text(k % 1000), 3, "0"), F.lpad(_text(F.col("c_nationkey")), 2, "0"),
                        F.lpad(_text(k % 10000), 4, "0"))
        ).alias("SSN"),
        F.get(F.array(*[F.lit(j) for j in jobs]), F.col("c_nationkey") % 12).alias("Occupation"),
        _text(_month_from("2023-01-01", k % 25)).alias("snapshot_date"),
    )


RAW_ATTRIBUTES = """
raw_attributes AS (
  SELECT 'CUS_' || c_custkey AS Customer_ID, c_name AS Name,
         CASE WHEN c_custkey % 41 = 7 THEN NULL WHEN c_custkey % 37 = 5 THEN '-500'
              WHEN c_custkey % 19 = 3 THEN (CAST(trunc(abs(c_acctbal)) AS BIGINT) % 130) || '_'
              ELSE CAST(CAST(trunc(abs(c_acctbal)) AS BIGINT) % 130 AS VARCHAR) END AS Age,
         CASE WHEN c_custkey % 17 = 4 THEN '#F%$D@*&8'
              ELSE lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
                   || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS SSN,
         (['Doctor', 'Lawyer', 'Engineer', 'Teacher', 'Journalist', 'Manager', 'Entrepreneur',
           'Mechanic', 'Accountant', 'Musician', '_______'])[c_nationkey % 12 + 1] AS Occupation,
         CAST(DATE '2023-01-01' + to_months(CAST(c_custkey % 25 AS INTEGER)) AS DATE) AS snapshot_date
  FROM customer)"""

ATTRIBUTES = f"""{RAW_ATTRIBUTES},
aged AS (
  SELECT *, TRY_CAST(replace(Age, '_', '') AS INTEGER) AS a FROM raw_attributes),
attributes AS (
  SELECT Customer_ID, Name, CASE WHEN a BETWEEN 16 AND 100 THEN a END AS Age, SSN,
         CASE WHEN Occupation NOT IN ('', '-', '^_+$') THEN Occupation END AS Occupation, snapshot_date,
         regexp_matches(SSN, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') AS SSN_is_valid,
         CASE WHEN regexp_matches(SSN, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') THEN SSN END AS SSN_clean,
         CASE WHEN a BETWEEN 16 AND 24 THEN 'young' WHEN a BETWEEN 25 AND 39 THEN 'middle_25_40'
              WHEN a BETWEEN 40 AND 59 THEN 'mature_40_60' ELSE 'seniors' END AS age_group,
         CASE WHEN Occupation IS NULL THEN 'None'
              WHEN Occupation IN ('Doctor', 'Lawyer', 'Engineer') THEN 'professional'
              WHEN Occupation IN ('Teacher', 'Journalist') THEN 'education_media'
              WHEN Occupation IN ('Manager', 'Entrepreneur') THEN 'business'
              WHEN Occupation IN ('Mechanic', 'Accountant') THEN 'technical'
              ELSE 'other' END AS occupation_category
  FROM aged)"""


def raw_clickstream(spark: SparkSession, sf: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    month = F.when(e % 24 == 7, 8).otherwise(e % 24)
    return table(spark, sf, "events").select(
        *[
            F.when(e % 50 != i, _text((e * i + u) % 41 - 20)).alias(f"fe_{i}")
            for i in range(1, 21)
        ],
        F.concat(F.lit("CUS_"), _text(u)).alias("Customer_ID"),
        _text(_month_from("2023-01-01", month)).alias("snapshot_date"),
    )


_FE = [f"fe_{i}" for i in range(1, 21)]
CLICKSTREAM = f"""
raw_clickstream AS (
  SELECT {', '.join(f'CASE WHEN event_id % 50 <> {i} THEN (event_id * {i} + user_id) % 41 - 20 END AS fe_{i}' for i in range(1, 21))},
         'CUS_' || user_id AS Customer_ID,
         CAST(DATE '2023-01-01' + to_months(CAST(CASE WHEN event_id % 24 = 7 THEN 8 ELSE event_id % 24 END AS INTEGER)) AS DATE) AS snapshot_date
  FROM events),
clickstream AS (
  SELECT *, {' + '.join(_FE)} AS total_activity,
         {' + '.join(f'abs({c})' for c in _FE)} AS activity_intensity,
         {' + '.join(f'CASE WHEN {c} <> 0 THEN 1 ELSE 0 END' for c in _FE)} AS active_features_count
  FROM raw_clickstream)"""


def raw_financials(spark: SparkSession, sf: str) -> DataFrame:
    k, c, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    whole = price.cast("long")
    suffixed = lambda x, every: F.when(k % every == 2, F.concat(_text(x), F.lit("_"))).otherwise(_text(x))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("CUS_"), _text(k)).alias("Customer_ID"),
        F.when(k % 29 == 3, "-100").when(k % 31 == 0, "9999999").otherwise(suffixed(whole, 13)).alias("Annual_Income"),
        _text((price / 12).cast("long")).alias("Monthly_Inhand_Salary"),
        _text(c % 14 - 1).alias("Num_Bank_Accounts"),
        _text(c % 20).alias("Num_Credit_Card"),
        _text(k % 70).alias("Interest_Rate"),
        F.when(k % 11 == 5, "-100").otherwise(suffixed(k % 9, 6)).alias("Num_of_Loan"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Not Specified")
        .when(F.col("o_orderpriority") == "5-LOW", "").when(F.col("o_orderpriority") == "1-URGENT", "_")
        .otherwise("Auto Loan, and Student Loan").alias("Type_of_Loan"),
        _text(k % 400 - 10).alias("Delay_from_due_date"),
        suffixed(k % 120, 7).alias("Num_of_Delayed_Payment"),
        F.when(k % 23 == 0, "_").otherwise(F.concat(_text(k % 300), F.lit(".5"))).alias("Changed_Credit_Limit"),
        F.when(k % 53 == 9, F.concat(_text(c % 60), F.lit("_"))).otherwise(
            F.concat(_text(c % 60), F.lit(".0"))).alias("Num_Credit_Inquiries"),
        F.when(F.col("o_orderstatus") == "F", "Good").when(F.col("o_orderstatus") == "O", "Standard")
        .otherwise("_").alias("Credit_Mix"),
        F.concat(_text((price / 7).cast("long")), F.lit(".25"), F.when(k % 10 == 2, "_").otherwise("")).alias("Outstanding_Debt"),
        F.when(k % 17 != 0, F.concat(_text(k % 110), F.lit(".5"))).alias("Credit_Utilization_Ratio"),
        F.when(k % 43 == 1, None).when(k % 19 == 0, F.concat(_text(c % 30), F.lit(" Years"))).otherwise(
            F.concat(_text(c % 30), F.lit(" Years and "), _text(k % 12), F.lit(" Months"))).alias("Credit_History_Age"),
        F.get(F.array(F.lit("Yes"), F.lit("No"), F.lit("NM")), (k % 3).cast("int")).alias("Payment_of_Min_Amount"),
        _text(k % 12000).alias("Total_EMI_per_month"),
        F.when(k % 21 == 0, "__10000__").otherwise(_text(k % 900)).alias("Amount_invested_monthly"),
        F.get(F.array(*[F.lit(b) for b in rules.PAYMENT_BEHAVIOURS], F.lit("!@9#%8")), (k % 8).cast("int")).alias("Payment_Behaviour"),
        F.when(k % 27 == 0, "__-333333333333333333333333333__").otherwise(_text(k % 2000 - 500)).alias("Monthly_Balance"),
        _text(_month_from("2023-01-01", (k + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)) % 25)).alias("snapshot_date"),
    )


def _suffixed(x: str, every: int) -> str:
    return f"CASE WHEN o_orderkey % {every} = 2 THEN ({x}) || '_' ELSE CAST({x} AS VARCHAR) END"


RAW_FINANCIALS = f"""
raw_financials AS (
  SELECT 'CUS_' || o_orderkey AS Customer_ID,
         CASE WHEN o_orderkey % 29 = 3 THEN '-100' WHEN o_orderkey % 31 = 0 THEN '9999999'
              ELSE {_suffixed('CAST(trunc(o_totalprice) AS BIGINT)', 13)} END AS Annual_Income,
         CAST(CAST(trunc(o_totalprice / 12) AS BIGINT) AS VARCHAR) AS Monthly_Inhand_Salary,
         CAST(o_custkey % 14 - 1 AS VARCHAR) AS Num_Bank_Accounts,
         CAST(o_custkey % 20 AS VARCHAR) AS Num_Credit_Card,
         CAST(o_orderkey % 70 AS VARCHAR) AS Interest_Rate,
         CASE WHEN o_orderkey % 11 = 5 THEN '-100' ELSE {_suffixed('o_orderkey % 9', 6)} END AS Num_of_Loan,
         CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Not Specified' WHEN '5-LOW' THEN ''
              WHEN '1-URGENT' THEN '_' ELSE 'Auto Loan, and Student Loan' END AS Type_of_Loan,
         CAST(o_orderkey % 400 - 10 AS VARCHAR) AS Delay_from_due_date,
         {_suffixed('o_orderkey % 120', 7)} AS Num_of_Delayed_Payment,
         CASE WHEN o_orderkey % 23 = 0 THEN '_' ELSE (o_orderkey % 300) || '.5' END AS Changed_Credit_Limit,
         CASE WHEN o_orderkey % 53 = 9 THEN (o_custkey % 60) || '_' ELSE (o_custkey % 60) || '.0' END AS Num_Credit_Inquiries,
         CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Standard' ELSE '_' END AS Credit_Mix,
         CAST(trunc(o_totalprice / 7) AS BIGINT) || '.25' || CASE WHEN o_orderkey % 10 = 2 THEN '_' ELSE '' END AS Outstanding_Debt,
         CASE WHEN o_orderkey % 17 <> 0 THEN (o_orderkey % 110) || '.5' END AS Credit_Utilization_Ratio,
         CASE WHEN o_orderkey % 43 = 1 THEN NULL WHEN o_orderkey % 19 = 0 THEN (o_custkey % 30) || ' Years'
              ELSE (o_custkey % 30) || ' Years and ' || (o_orderkey % 12) || ' Months' END AS Credit_History_Age,
         (['Yes', 'No', 'NM'])[o_orderkey % 3 + 1] AS Payment_of_Min_Amount,
         CAST(o_orderkey % 12000 AS VARCHAR) AS Total_EMI_per_month,
         CASE WHEN o_orderkey % 21 = 0 THEN '__10000__' ELSE CAST(o_orderkey % 900 AS VARCHAR) END AS Amount_invested_monthly,
         (['High_spent_Large_value_payments', 'High_spent_Medium_value_payments', 'High_spent_Small_value_payments',
           'Low_spent_Large_value_payments', 'Low_spent_Medium_value_payments', 'Low_spent_Small_value_payments',
           '!@9#%8'])[o_orderkey % 8 + 1] AS Payment_Behaviour,
         CASE WHEN o_orderkey % 27 = 0 THEN '__-333333333333333333333333333__'
              ELSE CAST(o_orderkey % 2000 - 500 AS VARCHAR) END AS Monthly_Balance,
         CAST(DATE '2023-01-01' + to_months(CAST((o_orderkey + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) % 25 AS INTEGER)) AS DATE) AS snapshot_date
  FROM orders)"""


def _num(c: str, low: str | None = None, high: str | None = None, strip: bool = True, integer: bool = False) -> str:
    x = f"replace({c}, '_', '')" if strip else c
    x = f"CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS BIGINT)" if integer else f"TRY_CAST({x} AS FLOAT)"
    tests = [f"{x} >= {low}"] if low is not None else []
    tests += [f"{x} <= {high}"] if high is not None else []
    return f"CASE WHEN {' AND '.join(tests)} THEN {x} END AS {c}" if tests else f"{x} AS {c}"


FINANCIALS = f"""{RAW_FINANCIALS},
typed_financials AS (
  SELECT Customer_ID, {_num('Annual_Income', '0', '1000000')}, {_num('Monthly_Inhand_Salary', '0')},
         {_num('Num_Bank_Accounts', '0', '10', integer=True)}, {_num('Num_Credit_Card', '0', '15', integer=True)},
         {_num('Interest_Rate', '0', '50')}, {_num('Num_of_Loan', '0', '20', integer=True)},
         CASE WHEN Type_of_Loan NOT IN ('', '_', 'Not Specified') THEN Type_of_Loan END AS Type_of_Loan,
         {_num('Delay_from_due_date', '0', '365', integer=True)},
         {_num('Num_of_Delayed_Payment', '0', '100', integer=True)}, {_num('Changed_Credit_Limit')},
         {_num('Num_Credit_Inquiries', '0', '50', strip=False, integer=True)},
         CASE WHEN Credit_Mix NOT IN ('_', '') THEN Credit_Mix END AS Credit_Mix,
         {_num('Outstanding_Debt', '0', '50000')}, {_num('Credit_Utilization_Ratio', '0')},
         Credit_History_Age, Payment_of_Min_Amount, {_num('Total_EMI_per_month', '0', '10000')},
         {_num('Amount_invested_monthly', '0', '10000')},
         CASE WHEN Payment_Behaviour IN ('High_spent_Large_value_payments', 'High_spent_Medium_value_payments',
           'High_spent_Small_value_payments', 'Low_spent_Large_value_payments', 'Low_spent_Medium_value_payments',
           'Low_spent_Small_value_payments') THEN Payment_Behaviour END AS Payment_Behaviour,
         {_num('Monthly_Balance', '-10000', '100000')}, snapshot_date
  FROM raw_financials),
financials AS (
  SELECT *,
         TRY_CAST(nullif(regexp_extract(Credit_History_Age, '(\\d+) Years', 1), '') AS INTEGER) * 12
           + TRY_CAST(nullif(regexp_extract(Credit_History_Age, '(\\d+) Months', 1), '') AS INTEGER) AS Credit_history_total_months,
         CASE WHEN Annual_Income > 0 THEN CAST(Outstanding_Debt AS DOUBLE) / CAST(Annual_Income AS DOUBLE) END AS Debt_to_income_ratio,
         CASE WHEN Credit_Utilization_Ratio > 90 THEN 'critical' WHEN Credit_Utilization_Ratio > 70 THEN 'very_high'
              WHEN Credit_Utilization_Ratio > 50 THEN 'high' WHEN Credit_Utilization_Ratio > 30 THEN 'moderate'
              WHEN Credit_Utilization_Ratio > 10 THEN 'low' ELSE 'very_low' END AS credit_risk_level
  FROM typed_financials)"""


def raw_loans(spark: SparkSession, sf: str, monthly: bool = False) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    lines = table(spark, sf, "lineitem")
    owners = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("l_orderkey")
    return lines.join(owners, lines.l_orderkey == owners.o_orderkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("loan_id"),
        F.concat(F.lit("CUS_"), _text(F.col("o_custkey"))).alias("Customer_ID"),
        F.col("o_orderdate").cast("date").alias("loan_start_date"),
        F.lit(10).alias("tenure"),
        F.col("l_linenumber").alias("installment_num"),
        F.col("l_extendedprice").alias("loan_amt"),
        F.when(k % 9 == 0, 0.0).otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("due_amt"),
        F.when(k % 8 != 3, F.col("l_quantity")).alias("paid_amt"),
        F.when(k % 10 != 1, F.col("l_extendedprice") * F.col("l_discount")).alias("overdue_amt"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("balance"),
        (month_of(day) if monthly else day).alias("snapshot_date"),
    )


LOANS = """
raw_loans AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS loan_id,
         'CUS_' || o_custkey AS Customer_ID, CAST(o_orderdate AS DATE) AS loan_start_date, 10 AS tenure,
         l_linenumber AS installment_num, CAST(l_extendedprice AS FLOAT) AS loan_amt,
         CAST(CASE WHEN l_orderkey % 9 = 0 THEN 0 ELSE l_extendedprice / l_quantity END AS FLOAT) AS due_amt,
         CAST(CASE WHEN l_orderkey % 8 <> 3 THEN l_quantity END AS FLOAT) AS paid_amt,
         CAST(CASE WHEN l_orderkey % 10 <> 1 THEN l_extendedprice * l_discount END AS FLOAT) AS overdue_amt,
         CAST(l_extendedprice * l_tax AS FLOAT) AS balance, CAST(l_shipdate AS DATE) AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
missed AS (
  SELECT * REPLACE (coalesce(paid_amt, 0) AS paid_amt, coalesce(overdue_amt, 0) AS overdue_amt), installment_num AS mob,
         coalesce(CAST(ceil(CAST(overdue_amt AS DOUBLE) / nullif(CAST(due_amt AS DOUBLE), 0)) AS BIGINT), 0) AS installments_missed
  FROM raw_loans),
dated AS (
  SELECT *, CASE WHEN installments_missed > 0
                 THEN CAST(snapshot_date - to_months(CAST(installments_missed AS INTEGER)) AS DATE) END AS first_missed_date
  FROM missed),
loans AS (
  SELECT *, CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END AS dpd
  FROM dated)"""


# --- a modelling table: order features, line-item labels -----------------------

MODEL_NUMERIC = ["o_totalprice", "c_acctbal", "order_age"]
MODEL_CATEGORICAL = ["o_orderpriority", "c_mktsegment"]


def model_features(spark: SparkSession, sf: str) -> DataFrame:
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    k = F.col("o_orderkey")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        _text(k).alias("Customer_ID"),
        month_of(F.col("o_orderdate")).alias("snapshot_date"),
        F.when(k % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 11 != 3, F.col("c_acctbal")).alias("c_acctbal"),
        F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate").cast("date")).cast("double").alias("order_age"),
        F.when(k % 13 != 1, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.col("c_mktsegment"),
    )


MODEL_FEATURES = """
model_features AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 11 <> 3 THEN c_acctbal END AS c_acctbal,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS DOUBLE) AS order_age,
         CASE WHEN o_orderkey % 13 <> 1 THEN o_orderpriority END AS o_orderpriority, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def model_labels(spark: SparkSession, sf: str) -> DataFrame:
    # Joined on the key of the result, so a later join on it needs no second shuffle.
    lines = table(spark, sf, "lineitem").withColumn("Customer_ID", _text(F.col("l_orderkey")))
    prices = table(spark, sf, "orders").select(_text(F.col("o_orderkey")).alias("Customer_ID"), "o_totalprice")
    return lines.join(prices, "Customer_ID").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("loan_id"),
        "Customer_ID",
        F.when(F.col("o_totalprice") + F.col("l_quantity") * 4000 > 450000, 1).otherwise(0).alias("label"),
        F.lit("30dpd_6mob").alias("label_def"),
        month_of(F.col("l_shipdate")).alias("snapshot_date"),
    )


MODEL_LABELS = """
model_labels AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS loan_id,
         CAST(l_orderkey AS VARCHAR) AS Customer_ID,
         CASE WHEN o_totalprice + l_quantity * 4000 > 450000 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MERGED = f"""{MODEL_FEATURES},{MODEL_LABELS},
merged AS (
  SELECT y.loan_id, y.Customer_ID, y.label, y.label_def, y.snapshot_date AS label_date, f.snapshot_date AS feature_date,
         f.o_totalprice, f.c_acctbal, f.order_age, f.o_orderpriority, f.c_mktsegment, y.snapshot_date
  FROM model_labels y JOIN model_features f USING (Customer_ID))"""

SPLIT = f"""{MERGED},
dates AS (
  SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) - 1 AS i, count(*) OVER () - 1 AS n
  FROM (SELECT DISTINCT snapshot_date FROM merged)),
split_dates AS (
  SELECT snapshot_date, CASE WHEN i = n THEN 'oot' WHEN i < floor(n * 0.70) THEN 'train'
                             WHEN i < floor(n * 0.85) THEN 'val' ELSE 'test' END AS split
  FROM dates),
split_rows AS (SELECT * FROM merged JOIN split_dates USING (snapshot_date))"""
