"""Bronze, silver and gold jobs over all snapshots at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from tidemark.functions import bands, dates, numbers, text
from tidemark.operators import features
from tidemark.plans import rules
from tidemark.sources import readers, writers


# --- bronze ----------------------------------------------------------------

#: What was ingested: a row per table, date and run; a date may have no rows.
REGISTER = "ingest_register"
#: The schema of each folder written.
SCHEMAS = "schema_register"
REGISTER_TYPE = StructType([
    StructField("snapshot_date", DateType()), StructField("n_rows", LongType()),
    StructField("table", StringType()), StructField("run", StringType())])


def bronze_schema(table: str) -> StructType:
    fields = [StructField(c, StringType()) for c in rules.RAW_LAYOUTS[table] if c != "snapshot_date"]
    return StructType([*fields, StructField("snapshot_date", DateType())])


def ingest(
    spark: SparkSession, table: str, source: str, bronze_root: str, days: Sequence[str] | None = None, run: str | None = None
) -> str:
    """Raw CSV to one text-typed, date-partitioned bronze table; one scan for all dates.

    Rows are counted while they are written.  The register gets a row for each requested date, or each date found.  A
    requested date without rows counts as ingested and is empty afterwards.
    """
    base = bronze_root.rstrip("/")
    raw = readers.read_csv_text(spark, source, rules.RAW_LAYOUTS[table])
    typed = raw.withColumn("snapshot_date", F.col("snapshot_date").try_cast("date"))
    if days is not None:
        typed = readers.snapshots(typed, "snapshot_date", days)
    root = f"{base}/{table}"
    counts = writers.write_counted(typed, root, days=days, register=f"{base}/{SCHEMAS}")
    entries = spark.createDataFrame(sorted(counts.items()), "d string, n_rows long").select(
        F.to_date("d").alias("snapshot_date"), "n_rows", F.lit(table).alias("table"), F.lit(run or uuid.uuid4().hex).alias("run"))
    # A row per date: one file.
    entries.repartition(1).write.mode("append").partitionBy("table", "run").parquet(f"{base}/{REGISTER}")
    return root


def ingested(spark: SparkSession, bronze_root: str, table: str) -> DataFrame:
    """The dates that were ingested, empty ones included."""
    register = readers.read_store(spark, f"{bronze_root.rstrip('/')}/{REGISTER}", schema=REGISTER_TYPE)
    return register.where(F.col("table") == table).select("snapshot_date").distinct()


# --- silver ----------------------------------------------------------------

def clean_attributes(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        F.col("Name").cast("string").alias("Name"),
        numbers.within(
            numbers.lenient_int(text.strip_token(F.col("Age").cast("string"))), *rules.AGE_RANGE
        ).alias("Age"),
        F.col("SSN").cast("string").alias("SSN"),
        text.null_if_in(F.col("Occupation").cast("string"), rules.OCCUPATION_SENTINELS).alias("Occupation"),
        F.col("snapshot_date").try_cast("date").alias("snapshot_date"),
    )
    return typed.select(
        "*",
        F.col("SSN").rlike(rules.SSN_PATTERN).alias("SSN_is_valid"),
        text.keep_if_matches(F.col("SSN"), rules.SSN_PATTERN).alias("SSN_clean"),
        bands.band_below(F.col("Age"), rules.AGE_BANDS, rules.AGE_BAND_DEFAULT).alias("age_group"),
        text.map_categories(
            F.col("Occupation"), rules.OCCUPATION_GROUPS, null_as="None", default="other"
        ).alias("occupation_category"),
    )


def clean_clickstream(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        *[numbers.lenient_int(F.col(c)).alias(c) for c in rules.CLICK_FEATURES],
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        F.col("snapshot_date").try_cast("date").alias("snapshot_date"),
    )
    counts = [F.col(c) for c in rules.CLICK_FEATURES]
    return typed.select(
        "*",
        numbers.row_sum(counts).alias("total_activity"),
        numbers.row_sum([F.abs(c) for c in counts]).alias("activity_intensity"),
        numbers.row_nonzero(counts).alias("active_features_count"),
    )


def clean_financials(raw: DataFrame) -> DataFrame:
    """Strip and cast, then guard, then derive.

    Each step is one projection: a guard tests its value more than once, and
    a value that is a plain column of the step before is computed only once.
    """

    def typed(name: str, dtype: str) -> Column:
        c = F.col(name)
        if dtype == "date":
            return c.try_cast("date")
        c = c.cast("string")
        if dtype == "string":
            return c
        if name not in rules.KEEPS_UNDERSCORES:
            c = text.strip_token(c)
        return numbers.lenient_int(c) if dtype == "int" else c.try_cast(dtype)

    guards = {
        "Credit_Mix": text.null_if_in(F.col("Credit_Mix"), rules.CREDIT_MIX_SENTINELS),
        "Type_of_Loan": text.null_if_in(F.col("Type_of_Loan"), rules.LOAN_TYPE_SENTINELS),
        "Payment_Behaviour": text.keep_if_in(F.col("Payment_Behaviour"), rules.PAYMENT_BEHAVIOURS),
    } | {
        name: numbers.within(F.col(name), low, high)
        for name, (low, high) in rules.FINANCIAL_RANGES.items()
    }
    return (
        raw.select(*[typed(n, t).alias(n) for n, t in rules.FINANCIAL_TYPES.items()])
        .withColumns(guards)
        .withColumns({
            "Credit_history_total_months": dates.span_in_months(F.col("Credit_History_Age")),
            "Debt_to_income_ratio": numbers.ratio_if_positive(
                F.col("Outstanding_Debt"), F.col("Annual_Income")
            ),
            "credit_risk_level": bands.band_above(
                F.col("Credit_Utilization_Ratio"), rules.UTILISATION_BANDS, rules.UTILISATION_DEFAULT
            ),
        })
    )


def clean_loans(raw: DataFrame, fill_scope: str = "frame") -> DataFrame:
    def cast(name: str, dtype: str) -> Column:
        c = F.col(name)
        return numbers.lenient_int(c) if dtype == "int" else c.try_cast(dtype)

    typed = raw.select(*[cast(n, t).alias(n) for n, t in rules.LOAN_TYPES.items()])
    return features.loan_status(typed, fill_scope)


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "attributes": clean_attributes,
    "clickstream": clean_clickstream,
    "financials": clean_financials,
    "lms": clean_loans,
}


def silver_schema(spark: SparkSession, table: str) -> StructType:
    cleaned = CLEANERS[table](spark.createDataFrame([], bronze_schema(table))).schema
    # A partition column is read as the last one.
    return StructType([*[f for f in cleaned if f.name != features.DATE], cleaned[features.DATE]])


def refine(
    spark: SparkSession, table: str, bronze_root: str, silver_root: str, days: Sequence[str] | None = None
) -> str:
    """Bronze to silver for the given dates, or all that were ingested; dates without rows end up empty."""
    raw = readers.read_store(spark, f"{bronze_root.rstrip('/')}/{table}", schema=bronze_schema(table))
    if days is None:
        # One row per snapshot date.
        days = sorted(str(r["snapshot_date"]) for r in ingested(spark, bronze_root, table).collect())
    else:
        raw = readers.snapshots(raw, "snapshot_date", days)
    # Cleaning keeps rows and dates, so silver's files can follow bronze's.
    return writers.write_snapshots(CLEANERS[table](raw), f"{silver_root.rstrip('/')}/{table}", days=days, clustered=True)


# --- gold ------------------------------------------------------------------

def feature_store(
    attributes: DataFrame, financials: DataFrame, clicks: DataFrame, ingested: DataFrame
) -> DataFrame:
    """Attributes with financials and the previous snapshot's activity.

    Both joins are on (customer, snapshot), so the attributes are shuffled
    once.  ``ingested`` lists the clickstream snapshots that exist.
    """
    base = attributes.join(financials, [features.KEY, features.DATE], "left")
    activity = features.activity_rollup(clicks)
    measures = [c for c in activity.columns if c not in (features.KEY, features.DATE)]
    joined = features.lagged_join(
        base, activity, ingested, measures, features.ACTIVITY_ZERO_FILLED
    )
    return joined.withColumn(
        "financial_health_score",
        features.health_score(F.col("Debt_to_income_ratio"), F.col("Credit_Utilization_Ratio")),
    ).drop(*rules.FEATURE_STORE_DROPPED)


def label_store(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    return features.loan_labels(loans, dpd, mob)


def build_gold(
    spark: SparkSession, silver_root: str, gold_root: str,
    ingested_clicks: DataFrame, days: Sequence[str] | None = None, dpd: int = 30, mob: int = 6,
) -> dict[str, str]:
    """Silver to both gold stores for the given dates, or all of them.

    ``ingested_clicks`` lists the clickstream dates that exist (see ``ingested``).
    """
    silver = {
        t: readers.read_store(spark, f"{silver_root.rstrip('/')}/{t}", schema=silver_schema(spark, t))
        for t in ("attributes", "financials", "clickstream", "lms")
    }

    def only(df: DataFrame) -> DataFrame:
        return df if days is None else readers.snapshots(df, features.DATE, days)

    store = feature_store(
        only(silver["attributes"]), only(silver["financials"]), silver["clickstream"], ingested_clicks
    )
    labels = label_store(only(silver["lms"]), dpd, mob)
    root = gold_root.rstrip("/")
    return {
        "feature_store": writers.write_snapshots(store, f"{root}/feature_store", days=days),
        "label_store": writers.write_snapshots(labels, f"{root}/label_store", days=days, clustered=True),
    }
