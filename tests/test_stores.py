"""Readers, writers and composite jobs on small files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tidemark.operators import features
from tidemark.plans import acceptance, rules, tables
from tidemark.session import shared_dir
from tidemark.sources import readers, writers


def test_rewriting_a_date_replaces_only_that_date(spark):
    root = shared_dir(spark, "t")
    first = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-02-01")], "k string, d string").select(
        "k", F.to_date("d").alias("snapshot_date"))
    writers.write_snapshots(first, root)
    writers.write_snapshots(first.where("k = 'b'").withColumn("k", F.lit("c")), root)
    got = sorted((r.k, str(r.snapshot_date)) for r in readers.read_store(spark, root).collect())
    assert got == [("a", "2024-01-01"), ("c", "2024-02-01")]


def test_header_only_csv_keeps_its_columns(spark, tmp_path):
    (tmp_path / "clicks.csv").write_text(",".join(rules.CLICKSTREAM_COLUMNS) + "\n")
    raw = readers.read_csv_text(spark, str(tmp_path / "clicks.csv"), rules.CLICKSTREAM_COLUMNS)
    cleaned = tables.clean_clickstream(raw)
    assert cleaned.count() == 0
    assert cleaned.schema["total_activity"].dataType.typeName() == "integer"


def test_csv_with_another_header_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        readers.read_csv_text(spark, str(tmp_path / "x.csv"), ["a", "b"]).collect()


def test_quoted_names_with_commas(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(rules.ATTRIBUTE_COLUMNS) + '\nCUS_1,"Doe, J ""Jo""",41_,1,Lawyer,2023-01-01\n')
    row = tables.clean_attributes(readers.read_csv_text(spark, str(tmp_path / "a.csv"), rules.ATTRIBUTE_COLUMNS)).first()
    assert (row.Name, row.Age, row.snapshot_date) == ('Doe, J "Jo"', 41, dt.date(2023, 1, 1))


def test_bronze_to_gold_for_some_dates(spark, tmp_path):
    def csv(name, columns, rows):
        lines = [",".join(columns)] + [",".join(str(r.get(c, "")) for c in columns) for r in rows]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
        return str(tmp_path / f"{name}.csv")

    who = [{"Customer_ID": f"C{i}", "Age": 30 + i, "snapshot_date": d} for i in range(3) for d in ("2023-01-01", "2023-02-01")]
    sources = {
        "attributes": csv("attributes", rules.ATTRIBUTE_COLUMNS, who),
        "financials": csv("financials", list(rules.FINANCIAL_TYPES), [w | {"Annual_Income": "1000_", "Outstanding_Debt": 200} for w in who]),
        "clickstream": csv("clickstream", rules.CLICKSTREAM_COLUMNS, [
            {c: 1 for c in rules.CLICK_FEATURES} | {"Customer_ID": "C0", "snapshot_date": "2023-01-01"}]),
        "lms": csv("lms", list(rules.LOAN_TYPES), [
            {"loan_id": f"L{i}", "Customer_ID": f"C{i}", "installment_num": 6, "due_amt": 100, "overdue_amt": 100 * i,
             "snapshot_date": "2023-02-01"} for i in range(3)]),
    }
    bronze, silver, gold = (shared_dir(spark, x) for x in ("bronze", "silver", "gold"))
    for name, path in sources.items():
        tables.ingest(spark, name, path, bronze, ["2023-01-01", "2023-02-01"])
        tables.refine(spark, name, bronze, silver)
    clicks = readers.read_store(spark, f"{silver}/clickstream").select("snapshot_date")
    roots = tables.build_gold(spark, silver, gold, clicks, ["2023-02-01"])
    store = {r.Customer_ID: r for r in readers.read_store(spark, roots["feature_store"]).collect()}
    assert set(store) == {"C0", "C1", "C2"}
    assert len(store["C0"]) == 30
    assert (store["C0"].visit_frequency, store["C0"].recent_total_activity, store["C1"].visit_frequency) == (1, 20, 0)
    assert store["C0"].Debt_to_income_ratio == pytest.approx(0.2)
    labels = {r.loan_id: r.label for r in readers.read_store(spark, roots["label_store"]).collect()}
    assert labels == {"L0": 0, "L1": 1, "L2": 1}


def test_a_date_that_is_now_empty_has_no_rows(spark):
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-02-01"), ("c", "2024-03-01")], "k string, d string").select(
        "k", F.to_date("d").alias("snapshot_date"))
    root = writers.write_snapshots(rows, shared_dir(spark, "t"))
    writers.write_snapshots(rows.where("k = 'a'").withColumn("k", F.lit("new")), root, days=["2024-01-01", "2024-02-01", "2024-04-01"])
    got = sorted((r.k, str(r.snapshot_date)) for r in readers.read_store(spark, root).collect())
    assert got == [("c", "2024-03-01"), ("new", "2024-01-01")]


def test_header_only_month_is_ingested(spark, tmp_path):
    (tmp_path / "clicks.csv").write_text(",".join(rules.CLICKSTREAM_COLUMNS) + "\n")
    bronze, silver = shared_dir(spark, "bronze"), shared_dir(spark, "silver")
    tables.ingest(spark, "clickstream", str(tmp_path / "clicks.csv"), bronze, ["2025-01-01"])
    tables.refine(spark, "clickstream", bronze, silver)
    assert [str(r.snapshot_date) for r in tables.ingested(spark, bronze, "clickstream").collect()] == ["2025-01-01"]
    assert tables.ingested(spark, bronze, "lms").count() == 0
    assert readers.read_store(spark, f"{silver}/clickstream", schema=tables.silver_schema(spark, "clickstream")).count() == 0


def test_reconciled_read_keeps_the_partition_column(spark):
    rows = spark.range(20).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("snapshot_date"))
    root = writers.write_snapshots(rows, shared_dir(spark, "t"))
    target = rows.schema
    back = readers.read_reconciled(spark, [f"{root}/snapshot_date=2024-01-01", f"{root}/snapshot_date=2024-01-02"], target)
    assert (back.count(), back.where("snapshot_date IS NOT NULL").count()) == (20, 20)
    found = readers.partition_schemas(spark, [f"{root}/snapshot_date=2024-01-01"])
    assert found[f"{root}/snapshot_date=2024-01-01"]["snapshot_date"].dataType.typeName() == "date"


def test_second_feature_snapshot_of_a_customer_fails(spark):
    day = F.lit("2024-01-01").cast("date")
    store = spark.createDataFrame([("a", 1), ("b", 2)], "Customer_ID string, x int").withColumn("snapshot_date", day)
    labels = spark.createDataFrame([("a", "L1", 1)], "Customer_ID string, loan_id string, label int").withColumn("snapshot_date", day)
    assert features.merge_features_labels(store, labels).count() == 1
    with pytest.raises(Exception, match="more than one feature snapshot"):
        features.merge_features_labels(store.unionByName(store), labels).collect()


def test_acceptance(spark):
    store = spark.createDataFrame([(5, None, 1.0), (30, 3.0, 2.0)], "Num_of_Loan int, Num_Credit_Inquiries double, Annual_Income double")
    got = {(r.check, r.column_name): r.status for r in acceptance.accept(store).collect()}
    assert got["null_rate", "Num_Credit_Inquiries"] == "PARTIAL"
    assert got["bounds", "Num_of_Loan"] == "FAIL" and got["bounds", "Annual_Income"] == "PASS"
    assert got["bounds", "Monthly_Balance"] == "NOT FOUND" and ("sanity", "Monthly_Balance") not in got
    assert got["sanity", "Num_of_Loan"] == "PASS"
    assert {r.status for r in acceptance.accept(store.select("Annual_Income")).where("check = 'null_rate'").collect()} == {"NOT FOUND"}


@pytest.mark.parametrize("day", ["1996-3-1", " 1996-03-01", dt.date(1996, 3, 1), dt.datetime(1996, 3, 1, 12)])
def test_a_date_written_without_rows_is_empty(spark, day):
    rows = spark.createDataFrame([("a", "1996-03-01"), ("b", "1996-04-01")], "k string, d string").select("k", F.to_date("d").alias("snapshot_date"))
    root = writers.write_snapshots(rows, shared_dir(spark, "t"))
    assert writers.write_counted(rows.where("false"), root, days=[day]) == {"1996-03-01": 0}
    assert [r.k for r in readers.read_store(spark, root).collect()] == ["b"]
    assert writers.write_counted(rows.where("k = 'a'"), root, days=[day, "1996-04-01"]) == {"1996-03-01": 1, "1996-04-01": 0}
    assert [r.k for r in readers.read_store(spark, root).collect()] == ["a"]


def test_a_malformed_day_is_an_error(spark):
    with pytest.raises(ValueError):
        writers.iso_day("1996-13-1")


def test_rows_are_counted_while_written(spark):
    """Counts per date, a date that holds most rows and rows without a date included in no count."""
    day = F.when(F.col("id") % 50 == 3, None).when(F.col("id") % 3 == 0, F.lit("2024-02-01")).otherwise(F.date_add(F.lit("2024-03-01"), (F.col("id") % 400).cast("int")))
    rows = spark.range(20_000).select("id", day.cast("date").alias("snapshot_date"))
    counts = writers.write_counted(rows, shared_dir(spark, "t"))
    want = {str(r[0]): r[1] for r in rows.where("snapshot_date IS NOT NULL").groupBy("snapshot_date").count().collect()}
    assert counts == want and len(want) > 300


def test_ingest_scans_its_source_once(spark, tmp_path):
    """The rows that the scan of the source gives, counted where it is read, are those of one pass."""
    columns = rules.RAW_LAYOUTS["attributes"]
    lines = [",".join(columns)] + [",".join(f"2024-0{i % 3 + 1}-01" if c == "snapshot_date" else "1" for c in columns) for i in range(90)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    seen = spark.sparkContext.accumulator(0)
    read = readers.read_csv_text

    def counting(*args, **kwargs):
        raw = read(*args, **kwargs)

        def each(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return raw.mapInArrow(each, raw.schema)

    readers.read_csv_text = counting
    try:
        bronze = shared_dir(spark, "bronze")
        tables.ingest(spark, "attributes", str(tmp_path / "a.csv"), bronze, ["2024-1-1", "2024-02-01", "2024-06-01"])
    finally:
        readers.read_csv_text = read
    assert seen.value == 90
    register = spark.read.schema(tables.REGISTER_TYPE).parquet(f"{bronze}/{tables.REGISTER}")
    assert {(str(r.snapshot_date), r.n_rows) for r in register.collect()} == {("2024-01-01", 30), ("2024-02-01", 30), ("2024-06-01", 0)}


def test_registered_folders_need_no_footer(spark, monkeypatch):
    """Schemas come from the register; a folder that another tool wrote is asked, and a folder written again has its last schema."""
    register, root = shared_dir(spark, "register"), shared_dir(spark, "store")
    day = lambda d: F.lit(d).cast("date").alias("snapshot_date")
    writers.write_snapshots(spark.range(3).select("id", day("2024-01-01")), root, register=register)
    writers.write_snapshots(spark.range(4).select(F.col("id").cast("string").alias("id"), day("2024-02-01")), root, register=register)
    writers.write_snapshots(spark.range(5).select(F.col("id").cast("int").alias("id"), day("2024-03-01")), root, register=register)
    writers.write_snapshots(spark.range(5).select(F.col("id").cast("double").alias("id"), day("2024-03-01")), root, register=register)
    writers.write_snapshots(spark.range(6).select("id", day("2024-04-01")), root)
    asked, footers = [], readers.footer_schemas
    monkeypatch.setattr(readers, "footer_schemas", lambda spark, paths: (asked.extend(paths), footers(spark, paths))[1])
    paths = [f"{root}/snapshot_date=2024-0{m}-01" for m in range(1, 5)]
    found = readers.partition_schemas(spark, paths, register)
    assert asked == paths[3:]
    assert [found[p]["id"].dataType.simpleString() for p in paths] == ["bigint", "string", "double", "bigint"]
    assert found == readers.partition_schemas(spark, paths)
    target = StructType([StructField("id", LongType()), StructField("snapshot_date", DateType())])
    got = readers.read_reconciled(spark, paths, target, register)
    assert {(str(r[0]), r[1], r[2]) for r in got.groupBy("snapshot_date").agg(F.count("id"), F.sum("id")).collect()} == {
        ("2024-01-01", 3, 3), ("2024-02-01", 4, 6), ("2024-03-01", 5, 10), ("2024-04-01", 6, 15)}


def test_silver_follows_bronze_without_a_shuffle(spark, monkeypatch):
    """Cleaning keeps dates: the files of a date are written where bronze's are read, in a small codec."""
    import os

    from pyspark.sql import DataFrame, functions as F

    from tidemark.plans import rules, tables
    from tidemark.session import shared_dir
    from tidemark.sources import readers

    source, bronze, silver = (shared_dir(spark, x) for x in ("source", "bronze", "silver"))
    clicks = spark.range(300).select(
        *[F.lit("1").alias(c) for c in rules.CLICK_FEATURES], F.format_string("C%s", F.col("id").cast("string")).alias("Customer_ID"),
        F.add_months(F.lit("2023-01-01").cast("date"), (F.col("id") % 3).cast("int")).cast("string").alias("snapshot_date"))
    clicks.write.option("header", True).csv(source)
    tables.ingest(spark, "clickstream", source, bronze)
    monkeypatch.setattr(DataFrame, "hint", lambda *a: pytest.fail("rows were shuffled again"))
    root = tables.refine(spark, "clickstream", bronze, silver)
    assert {str(r[0]): r[1] for r in readers.read_store(spark, root).groupBy("snapshot_date").count().collect()} == {
        f"2023-0{m}-01": 100 for m in (1, 2, 3)}
    files = [f for _, _, names in os.walk(root) for f in names if f.endswith(".parquet")]
    assert len(files) == 3 and all(".zstd." in f for f in files)
