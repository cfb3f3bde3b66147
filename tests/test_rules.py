"""Cleaning and feature rules on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import bands, bins, dates, numbers
from tidemark.operators import features
from tidemark.plans import rules, tables


def one(spark, ddl, values, *cols):
    return [tuple(r) for r in spark.createDataFrame(values, ddl).select(*cols).collect()]


def attributes(spark, **change):
    row = {"Customer_ID": "CUS_1", "Name": "A", "Age": "30", "SSN": "123-45-6789",
           "Occupation": "Lawyer", "snapshot_date": "2023-01-01"} | change
    ddl = ", ".join(f"{c} string" for c in rules.ATTRIBUTE_COLUMNS)
    df = spark.createDataFrame([tuple(row[c] for c in rules.ATTRIBUTE_COLUMNS)], ddl)
    return tables.clean_attributes(df).first()


@pytest.mark.parametrize("raw,age,group", [
    ("41_", 41, "mature_40_60"), ("2329_", None, "seniors"), ("-500", None, "seniors"),
    (None, None, "seniors"), ("24", 24, "young"), ("25", 25, "middle_25_40"), ("16", 16, "young"),
    ("15", None, "seniors"), ("100", 100, "seniors"), ("101", None, "seniors"),
])
def test_age(spark, raw, age, group):
    row = attributes(spark, Age=raw)
    assert (row.Age, row.age_group) == (age, group)


@pytest.mark.parametrize("raw,kept,category", [
    ("_______", "_______", "other"), (None, None, "None"), ("", None, "None"), ("-", None, "None"),
    ("Lawyer", "Lawyer", "professional"), ("Journalist", "Journalist", "education_media"),
    ("Entrepreneur", "Entrepreneur", "business"), ("Accountant", "Accountant", "technical"),
    ("Musician", "Musician", "other"),
])
def test_occupation(spark, raw, kept, category):
    row = attributes(spark, Occupation=raw)
    assert (row.Occupation, row.occupation_category) == (kept, category)


def test_ssn(spark):
    good, bad, gone = (attributes(spark, SSN=s) for s in ("230-22-9583", "#F%$D@*&8", None))
    assert (good.SSN_is_valid, good.SSN_clean) == (True, "230-22-9583")
    assert (bad.SSN_is_valid, bad.SSN_clean) == (False, None)
    assert (gone.SSN_is_valid, gone.SSN_clean) == (None, None)


def test_lenient_int(spark):
    got = one(spark, "x string", [("2.0",), ("8",), ("_",), (None,), ("2.9",), ("x",), ("-3.7",)],
              numbers.lenient_int(F.col("x")))
    assert [r[0] for r in got] == [2, 8, None, None, 2, None, -3]


def test_span_in_months(spark):
    got = one(spark, "x string", [("22 Years and 9 Months",), ("5 Years",), (None,), ("9 Months",), ("NA",)],
              dates.span_in_months(F.col("x")))
    assert [r[0] for r in got] == [273, None, None, None, None]


def test_month_gap_counts_calendar_months(spark):
    got = one(spark, "a date, b date", [(dt.date(2024, 1, 1), dt.date(2023, 12, 31))],
              dates.month_gap(F.col("a"), F.col("b")))
    assert got[0][0] == 1


def clicks(spark, values):
    row = dict(zip(rules.CLICK_FEATURES, values)) | {"Customer_ID": "C", "snapshot_date": "2023-01-01"}
    ddl = ", ".join(f"{c} string" for c in rules.CLICKSTREAM_COLUMNS)
    df = spark.createDataFrame([tuple(row[c] for c in rules.CLICKSTREAM_COLUMNS)], ddl)
    return tables.clean_clickstream(df).first()


def test_activity_with_one_null(spark):
    row = clicks(spark, [None] + ["1"] * 19)
    assert (row.total_activity, row.activity_intensity, row.active_features_count) == (None, None, 19)
    row = clicks(spark, ["-5", "0"] + ["1"] * 18)
    assert (row.total_activity, row.activity_intensity, row.active_features_count) == (13, 23, 19)


def financials(spark, **change):
    row = {c: None for c in rules.FINANCIAL_TYPES} | change
    ddl = ", ".join(f"{c} string" for c in rules.FINANCIAL_TYPES)
    df = spark.createDataFrame([tuple(row[c] for c in rules.FINANCIAL_TYPES)], ddl)
    return tables.clean_financials(df).first()


def test_financial_ranges_and_sentinels(spark):
    row = financials(
        spark, Annual_Income="9999999_", Num_of_Loan="8_", Num_Bank_Accounts="-1", Num_Credit_Inquiries="2.0",
        Credit_Mix="_", Type_of_Loan="Not Specified", Payment_Behaviour="!@9#%8", Interest_Rate="50",
        Monthly_Balance="__-333333333333333333333333333__", Amount_invested_monthly="__10000__",
        Delay_from_due_date="-1", Changed_Credit_Limit="_", Outstanding_Debt="809.98_",
    )
    assert row.Annual_Income is None and row.Num_of_Loan == 8 and row.Num_Bank_Accounts is None
    assert row.Num_Credit_Inquiries == 2 and row.Credit_Mix is None and row.Type_of_Loan is None
    assert row.Payment_Behaviour is None and row.Interest_Rate == 50 and row.Monthly_Balance is None
    assert row.Amount_invested_monthly == 10000 and row.Delay_from_due_date is None
    assert row.Changed_Credit_Limit is None and row.Outstanding_Debt == pytest.approx(809.98, rel=1e-6)


def test_ratio_uses_guarded_inputs(spark):
    assert financials(spark, Annual_Income="0", Outstanding_Debt="5").Debt_to_income_ratio is None
    assert financials(spark, Annual_Income="9999999", Outstanding_Debt="5").Debt_to_income_ratio is None
    assert financials(spark, Annual_Income="100", Outstanding_Debt="50").Debt_to_income_ratio == 0.5


@pytest.mark.parametrize("raw,level", [
    (None, "very_low"), ("10", "very_low"), ("10.5", "low"), ("31", "moderate"), ("51", "high"),
    ("71", "very_high"), ("91", "critical"),
])
def test_utilisation_level(spark, raw, level):
    assert financials(spark, Credit_Utilization_Ratio=raw).credit_risk_level == level


def loans(spark, scope="frame", **change):
    row = {"loan_id": "L", "Customer_ID": "C", "loan_start_date": "2023-01-01", "tenure": "10",
           "installment_num": "6", "loan_amt": "1000", "due_amt": "100", "paid_amt": "100",
           "overdue_amt": "0", "balance": "0", "snapshot_date": "2024-03-31"} | change
    ddl = ", ".join(f"{c} string" for c in rules.LOAN_TYPES)
    df = spark.createDataFrame([tuple(row[c] for c in rules.LOAN_TYPES)], ddl)
    return tables.clean_loans(df, scope)


def test_loan_overdue(spark):
    row = loans(spark, overdue_amt="250").first()
    assert (row.mob, row.installments_missed, row.first_missed_date, row.dpd) == (6, 3, dt.date(2023, 12, 31), 91)


def test_loan_overdue_without_due(spark):
    df = loans(spark, overdue_amt="5", due_amt="0")
    row = df.first()
    assert (row.installments_missed, row.first_missed_date, row.dpd) == (0, None, None)
    assert tables.label_store(df).first().label == 0


def test_loan_fill_scope(spark):
    assert loans(spark, paid_amt=None, installment_num=None).first().paid_amt == 0
    assert loans(spark, installment_num=None).first().mob == 0
    row = loans(spark, "column", paid_amt=None, due_amt=None).first()
    assert row.paid_amt is None and row.installments_missed == 0


def test_label_definition(spark):
    df = loans(spark, overdue_amt="250")
    got = tables.label_store(df, dpd=30, mob=6).first()
    assert (got.label, got.label_def) == (1, "30dpd_6mob")
    assert tables.label_store(df, dpd=92, mob=6).first().label == 0
    assert tables.label_store(df, mob=5).count() == 0


def test_health_score(spark):
    rows = [(None, None), (0.1, 10.0), (0.4, 50.0), (0.9, 80.0), (0.3, 30.0)]
    got = one(spark, "r double, u double", rows, features.health_score(F.col("r"), F.col("u")))
    assert [x[0] for x in got] == [1, 5, 3, 1, 3]


def test_risk_bands_are_right_closed(spark):
    got = one(spark, "p double", [(0.0,), (0.3,), (0.3000001,), (0.7,), (1.0,), (1.2,), (None,)],
              bands.band_right_closed(F.col("p"), rules.RISK_EDGES, rules.RISK_NAMES))
    assert [x[0] for x in got] == [None, "Low Risk", "Medium Risk", "Medium Risk", "High Risk", None, None]


def test_bin_edges_are_exact(spark):
    got = one(spark, "x double", [(0.3,), (0.30000000000000004,), (1.0,), (1.2,), (0.0,), (-0.1,), (None,), (0.7,), (float("nan"),)],
              bins.bin_index(F.col("x"), 10))
    assert [x[0] for x in got] == [2, 3, 9, None, 0, None, None, 6, None]


def test_order_bucket_never_decreases(spark):
    rows = spark.range(20000).select(((F.col("id") - 10000) * 0.37).alias("x")).union(
        spark.createDataFrame([(float("inf"),), (float("-inf"),), (1e300,), (-1e300,), (0.0,), (-0.0,)], "x double"))
    got = [r.c for r in rows.orderBy("x").select(bins.coarse_bucket(F.col("x")).alias("c")).collect()]
    assert got == sorted(got)


def feature_store(spark, click_dates):
    day = lambda s: dt.date.fromisoformat(s)
    spine = spark.createDataFrame(
        [("a", day("2024-02-01")), ("b", day("2024-02-01")), ("a", day("2024-03-01")), ("c", day("2024-03-31"))],
        "Customer_ID string, snapshot_date date")
    activity = spark.createDataFrame(
        [("a", day("2024-01-01"), 2, day("2024-01-01"), 7), ("c", day("2024-02-29"), 1, day("2024-02-29"), 3)],
        "Customer_ID string, snapshot_date date, visit_frequency long, last_activity_date date, recent_total_activity long")
    ingested = spark.createDataFrame([(day(s),) for s in click_dates], "snapshot_date date")
    out = features.lagged_join(
        spine, activity, ingested, ["visit_frequency", "last_activity_date", "recent_total_activity"],
        ["visit_frequency", "recent_total_activity"])
    return {(r.Customer_ID, str(r.snapshot_date)): tuple(r)[2:] for r in out.collect()}


def test_lagged_join_fills_only_ingested_months(spark):
    got = feature_store(spark, ["2024-01-01", "2024-02-29"])
    assert got[("a", "2024-02-01")] == (2, dt.date(2024, 1, 1), 7)
    assert got[("b", "2024-02-01")] == (0, None, 0)          # silent, previous month ingested
    assert got[("a", "2024-03-01")] == (None, None, None)    # previous month not ingested
    assert got[("c", "2024-03-31")] == (1, dt.date(2024, 2, 29), 3)  # month end
    assert len(got) == 4


def test_lagged_join_empty_but_ingested_snapshot(spark):
    assert feature_store(spark, ["2024-02-01"])[("a", "2024-03-01")] == (0, None, 0)


def test_merge_keeps_both_dates(spark):
    day = dt.date(2024, 1, 1)
    f = spark.createDataFrame([("a", day, 1.0)], "Customer_ID string, snapshot_date date, x double")
    y = spark.createDataFrame([("a", dt.date(2024, 6, 1), 1), ("a", dt.date(2024, 7, 1), 0), ("b", day, 1)],
                              "Customer_ID string, snapshot_date date, label int")
    got = sorted(tuple(r) for r in features.merge_features_labels(f, y).select(
        "label_date", "feature_date", "snapshot_date", "label", "x").collect())
    assert got == [(dt.date(2024, 6, 1), day, dt.date(2024, 6, 1), 1, 1.0),
                   (dt.date(2024, 7, 1), day, dt.date(2024, 7, 1), 0, 1.0)]
