"""Merging, splitting, imputing, encoding, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features, prepare, profile
from tidemark.queries import standins as st
from tidemark.queries.base import present, query
from tidemark.queries.sqltext import d, r
from tidemark.session import cut_lineage

_NUM, _CAT = st.MODEL_NUMERIC, st.MODEL_CATEGORICAL


def merged(spark, sf):
    return features.merge_features_labels(st.model_features(spark, sf), st.model_labels(spark, sf))


def split_rows(spark, sf, columns=None):
    """The merge is written once, with the columns asked for; dates, fits and rows then read the table."""
    rows = merged(spark, sf)
    if columns is not None:
        rows = rows.select("snapshot_date", *columns)
    return prepare.temporal_split(cut_lineage(rows, "merged"), "snapshot_date")


@query("feature_label_merge", f"""
WITH {st.MERGED}
SELECT loan_id, Customer_ID, label, label_def, {d('label_date')} AS label_date, {d('feature_date')} AS feature_date,
       {r('o_totalprice', 2)} AS o_totalprice, {r('c_acctbal', 2)} AS c_acctbal, order_age, o_orderpriority, c_mktsegment,
       {d('snapshot_date')} AS snapshot_date FROM merged""")
def feature_label_merge(spark, sf):
    return present(merged(spark, sf), digits=2)


@query("temporal_split", f"""
WITH {st.SPLIT}
SELECT {d('snapshot_date')} AS snapshot_date, split, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive FROM split_rows GROUP BY ALL""")
def temporal_split(spark, sf):
    return present(split_rows(spark, sf, ["label"]).groupBy("snapshot_date", "split").agg(
        F.count("*").alias("n_rows"), F.sum("label").alias("n_positive")))


@query("class_weights", f"""
WITH {st.SPLIT}, c AS (SELECT label, count(*) AS n FROM split_rows WHERE split = 'train' GROUP BY label)
SELECT label, n, {r('(SELECT sum(n) FROM c) / (CAST((SELECT count(*) FROM c) AS DOUBLE) * n)')} AS balanced_weight,
       {r('CAST((SELECT n FROM c WHERE label = 0) AS DOUBLE) / (SELECT n FROM c WHERE label = 1)')} AS scale_pos_weight FROM c""")
def class_weights(spark, sf):
    train = split_rows(spark, sf, ["label"]).where(F.col("split") == "train")
    return present(prepare.class_weights(train, "label"))


def _train_medians(columns):
    return ", ".join(f"(SELECT quantile_cont({c}, 0.5) FROM split_rows WHERE split = 'train') AS m_{c}" for c in columns)


@query("impute_median", f"""
WITH {st.SPLIT}, m AS (SELECT {_train_medians(_NUM)}),
filled AS (SELECT split, {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in _NUM)} FROM split_rows, m)
SELECT split, count(*) AS n, {', '.join(f'{r(f"avg({c})", 4)} AS avg_{c}, count(*) FILTER (WHERE {c} IS NULL) AS null_{c}' for c in _NUM)} FROM filled GROUP BY split""")
def impute_median(spark, sf):
    rows = split_rows(spark, sf, _NUM)
    medians = prepare.fit_medians(rows.where(F.col("split") == "train"), _NUM)
    filled = prepare.impute_medians(rows, medians, _NUM)
    return present(filled.groupBy("split").agg(
        F.count("*").alias("n"),
        *[x for c in _NUM for x in (F.avg(c).alias(f"avg_{c}"), F.count_if(F.col(c).isNull()).alias(f"null_{c}"))],
    ), digits=4)


@query("train_medians", f"""
WITH {st.SPLIT} {' UNION ALL '.join(f"SELECT '{c}' AS column_name, {r(f'quantile_cont({c}, 0.5)', 4)} AS median FROM split_rows WHERE split = 'train'" for c in _NUM)}""")
def train_medians(spark, sf):
    return present(prepare.fit_medians(split_rows(spark, sf).where(F.col("split") == "train"), _NUM), digits=4)


_CODES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, v AS value, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce({c}, 'Unknown') AS v FROM {{source}})"
    for c in _CAT)


@query("fit_encoder", f"""
WITH {st.SPLIT}, train AS (SELECT * FROM split_rows WHERE split = 'train') {_CODES.format(source='train')}""")
def fit_encoder(spark, sf):
    train = split_rows(spark, sf).where(F.col("split") == "train")
    return present(prepare.fit_encoder(train, _CAT))


@query("fit_encoder_all_splits", f"WITH {st.MERGED} {_CODES.format(source='merged')}")
def fit_encoder_all_splits(spark, sf):
    return present(prepare.fit_encoder(merged(spark, sf), _CAT))


@query("encode_categories", f"""
WITH {st.SPLIT},
early AS (SELECT * FROM split_rows WHERE split = 'train' AND coalesce(c_mktsegment, '') <> 'MACHINERY' AND o_orderpriority IS NOT NULL),
codes AS ({_CODES.format(source='early')})
SELECT split, coalesce(p.code, (SELECT max(code) + 1 FROM codes WHERE column_name = 'o_orderpriority')) AS o_orderpriority,
       coalesce(s.code, (SELECT max(code) + 1 FROM codes WHERE column_name = 'c_mktsegment')) AS c_mktsegment, count(*) AS n
FROM split_rows x
LEFT JOIN codes p ON p.column_name = 'o_orderpriority' AND p.value = coalesce(x.o_orderpriority, 'Unknown')
LEFT JOIN codes s ON s.column_name = 'c_mktsegment' AND s.value = coalesce(x.c_mktsegment, 'Unknown')
GROUP BY ALL""")
def encode_categories(spark, sf):
    """Fitted without one segment and without nulls, so that unseen values occur."""
    rows = split_rows(spark, sf, _CAT)
    early = rows.where(
        (F.col("split") == "train") & (F.col("c_mktsegment") != "MACHINERY") & F.col("o_orderpriority").isNotNull())
    coded = prepare.encode(rows, cut_lineage(prepare.fit_encoder(early, _CAT), "encoder"), _CAT)
    return present(coded.groupBy("split", *_CAT).agg(F.count("*").alias("n")))


@query("scale_numeric", f"""
WITH {st.SPLIT},
p AS (SELECT {', '.join(f'avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}' for c in _NUM)} FROM split_rows WHERE split = 'train')
SELECT split, {', '.join(f'{r(f"avg(({c} - m_{c}) / s_{c})", 5)} AS avg_{c}, {r(f"min(({c} - m_{c}) / s_{c})", 5)} AS min_{c}, {r(f"max(({c} - m_{c}) / s_{c})", 5)} AS max_{c}' for c in _NUM)}
FROM split_rows, p GROUP BY split""")
def scale_numeric(spark, sf):
    rows = split_rows(spark, sf, _NUM)
    scaler = prepare.fit_scaler(rows.where(F.col("split") == "train"), _NUM)
    scaled = prepare.scale(rows, scaler, _NUM)
    return present(scaled.groupBy("split").agg(
        *[x for c in _NUM for x in (F.avg(c).alias(f"avg_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))],
    ), digits=5)


@query("feature_matrix", f"""
WITH {st.SPLIT}, m AS (SELECT {_train_medians(_NUM)}), codes AS ({_CODES.format(source='merged')})
SELECT loan_id, label, {', '.join(f'{r(f"coalesce({c}, m_{c})", 4)} AS {c}' for c in _NUM)}, p.code AS o_orderpriority, s.code AS c_mktsegment
FROM split_rows x, m
LEFT JOIN codes p ON p.column_name = 'o_orderpriority' AND p.value = coalesce(x.o_orderpriority, 'Unknown')
LEFT JOIN codes s ON s.column_name = 'c_mktsegment' AND s.value = coalesce(x.c_mktsegment, 'Unknown')""")
def feature_matrix(spark, sf):
    rows = split_rows(spark, sf)
    medians = prepare.fit_medians(rows.where(F.col("split") == "train"), _NUM)
    coded = prepare.encode(
        prepare.impute_medians(rows, medians, _NUM), cut_lineage(prepare.fit_encoder(rows, _CAT), "encoder"), _CAT)
    return present(prepare.feature_matrix(coded, ["loan_id", "label"], _NUM, _CAT), digits=4)


@query("category_vocabulary", f"""
WITH {st.MERGED} SELECT DISTINCT coalesce(o_orderpriority, 'Unknown') AS value FROM merged""")
def category_vocabulary(spark, sf):
    rows = split_rows(spark, sf)
    splits = [rows.where(F.col("split") == s) for s in ("train", "val", "test", "oot")]
    return present(prepare.category_vocabulary(splits, "o_orderpriority"))


_IMPORTANCE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_IMPORTANCE_SQL = f"""{st.line_store_sql()},
importance AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST(count({c}) AS DOUBLE) / count(*) AS importance FROM store" for c in _IMPORTANCE_COLUMNS)}),
ranked AS (SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS position,
                  sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING) / sum(importance) OVER () AS cumulative_importance FROM importance)"""


def importance_table(spark, sf):
    """Completeness of a column as its importance: a table that grows out of the data."""
    missing = profile.null_profile(st.line_store(spark, sf), _IMPORTANCE_COLUMNS)
    return missing.select(
        F.col("column_name").alias("feature"), (1 - F.col("missing_percent") / 100).alias("importance"))


@query("cumulative_importance", f"""
WITH {_IMPORTANCE_SQL}
SELECT feature, {r('importance')} AS importance, position, {r('cumulative_importance')} AS cumulative_importance,
       cumulative_importance <= 8e-1 AS within_cutoff FROM ranked""")
def cumulative_importance(spark, sf):
    return present(prepare.cumulative_importance(importance_table(spark, sf)))


@query("stratified_folds", f"""
WITH {st.MODEL_LABELS}, c AS (SELECT label, count(*) AS n FROM model_labels GROUP BY label)
SELECT label, f AS fold, n // 3 + CAST(f < n % 3 AS INTEGER) AS n FROM c, (SELECT unnest(range(3)) AS f)""")
def stratified_folds(spark, sf):
    folded = prepare.stratified_folds(st.model_labels(spark, sf), "label", ["loan_id"], folds=3)
    return present(folded.groupBy("label", "fold").agg(F.count("*").alias("n")))
