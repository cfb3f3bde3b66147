"""Operators against brute force with numpy and pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import bins
from tidemark.operators import comoments, evaluate, match, ordering, prepare, profile, quality, quantiles, stability

DATES = [dt.date(2024, m, 1) for m in (1, 2, 3)]


def psi(expected, actual, bins=10):
    edges = np.linspace(0, 1, bins + 1)
    e = np.histogram(expected, edges)[0] / len(expected)
    a = np.histogram(actual, edges)[0] / len(actual)
    e, a = np.where(e == 0, 1e-4, e), np.where(a == 0, 1e-4, a)
    return float(np.sum((a - e) * np.log(a / e)))


@pytest.fixture(scope="module")
def scores():
    rng = np.random.default_rng(7)
    frames = []
    for i, date in enumerate(DATES):
        s = np.round(rng.beta(2 + i, 3, 400), 1 if i == 1 else 6)
        s[:5] = [0.3, 0.6, 0.7, 1.0, 1.3]
        frames.append(pd.DataFrame({"d": date, "s": s}))
    return pd.concat(frames, ignore_index=True)


def test_psi_over_time(spark, scores):
    got = {r.date: r.psi for r in stability.psi_over_time(spark.createDataFrame(scores), "s", "d").collect()}
    by = {k: g.s.values for k, g in scores.groupby("d")}
    assert set(got) == set(DATES[1:])
    for date in DATES[1:]:
        assert got[date] == pytest.approx(psi(by[DATES[0]], by[date]), abs=1e-12)


def test_psi_between(spark, scores):
    df = spark.createDataFrame(scores)
    row = stability.psi_between(df.where(F.col("d") == DATES[0]), df.where(F.col("d") == DATES[2]), "s").first()
    by = {k: g.s.values for k, g in scores.groupby("d")}
    assert row.psi == pytest.approx(psi(by[DATES[0]], by[DATES[2]]), abs=1e-12)
    assert row.breakpoints == list(np.linspace(0, 1, 11))


def test_nulls_count_for_scores_but_not_for_features(spark):
    rows = [(DATES[0], 0.05)] * 4 + [(DATES[1], 0.05)] * 2 + [(DATES[1], None)] * 2
    df = spark.createDataFrame(rows, "snapshot_date date, s double")
    half = (0.5 - 1) * np.log(0.5)
    assert stability.psi_over_time(df, "s", "snapshot_date").first().psi == pytest.approx(half)
    assert stability.feature_drift(df, "snapshot_date", ["s"]).first().psi == pytest.approx(0)


def test_feature_drift(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "snapshot_date": np.repeat(DATES, 200),
        "x": rng.random(600), "y": rng.normal(50, 9, 600), "z": [np.nan] * 200 + [1.0] * 400,
    })
    pdf.loc[rng.random(600) < 0.1, "x"] = np.nan
    got = {(r.date, r.feature): r for r in stability.feature_drift(
        spark.createDataFrame(pdf), "snapshot_date", ["x", "y", "z"]).collect()}
    assert set(got) == {(d, f) for d in DATES[1:] for f in "xy"}  # z has no baseline
    for (date, f), r in got.items():
        b = pdf[pdf.snapshot_date == DATES[0]][f].dropna().values
        m = pdf[pdf.snapshot_date == date][f].dropna().values
        assert r.psi == pytest.approx(psi(b, m), abs=1e-12)
        assert r.mean_change_pct == pytest.approx((m.mean() - b.mean()) / (abs(b.mean()) + 1e-10) * 100)
        assert r.std_change_pct == pytest.approx((m.std() - b.std()) / (abs(b.std()) + 1e-10) * 100)


def test_empty_summaries_keep_their_columns(spark):
    empty = spark.createDataFrame([], "date date, psi double, baseline_date date")
    row = stability.psi_summary(empty).first()
    assert (row.avg_psi, row.max_psi, row.n_significant, row.max_psi_date) == (0, 0, 0, None)
    drift = spark.createDataFrame([], "date date, feature string, psi double")
    row = stability.drift_summary(drift).first()
    assert (row.n_features_monitored, row.avg_feature_psi, row.features_high_drift, row.n_features_high_drift) == (0, 0, [], 0)
    none = quality.quality_summary(spark.createDataFrame(
        [], "month date, n_rows long, missing_rate_pct double, n_duplicates long")).first()
    assert (none.avg_missing_rate_pct, none.total_duplicates) == (0, 0)


def test_psi_summary_ties_take_the_earliest_date(spark):
    rows = [(DATES[2], 0.3), (DATES[1], 0.3), (DATES[0], 0.1)]
    row = stability.psi_summary(spark.createDataFrame(rows, "date date, psi double")).first()
    assert row.max_psi_date == DATES[1]
    assert (row.n_stable, row.n_moderate, row.n_significant) == (0, 1, 2)


# --- ordering ----------------------------------------------------------------

@pytest.mark.parametrize("kind", ["normal", "ties", "tails", "single", "signed_zero", "crowded"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(1)
    values = {
        "normal": rng.normal(0, 1, 999), "ties": np.array([5.0] * 700 + [1.0] * 100 + list(rng.integers(0, 9, 201))),
        "tails": np.concatenate([rng.random(500), [1e12, -1e15, 3e8]]), "single": np.array([4.25]),
        "crowded": np.concatenate([0.5 + rng.random(700) * 1e-6, rng.random(300)]),
        "signed_zero": np.array([-0.0, 0.0, -1e-9, 1e-9, 0.0]),
    }[kind]
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame([("k", float(v)) for v in values] + [("k", None), ("empty", None)], "k string, v double")
    got = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], F.col("v"), probs).collect()}
    assert set(got) == {"k"}
    for i, p in enumerate(probs):
        assert got["k"][f"q_{i}"] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-15)


def test_quantiles_of_many_keys_need_no_broadcast(spark):
    df = spark.range(900).select((F.col("id") % 300).alias("k"), F.col("id").cast("double").alias("v"))
    got = quantiles.exact_quantiles(df, ["k"], F.col("v"), [0.5])
    assert all(r.q_0 == r.k + 300 for r in got.collect())
    assert "BroadcastExchange" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("within", [10**9, 40])
@pytest.mark.parametrize("slack", [quantiles.SLACK, 0.0, -0.2])
def test_missed_brackets_are_widened(spark, monkeypatch, slack, within):
    """A slack below zero makes brackets that can't hold their ranks; a small ``WITHIN`` narrows them first."""
    monkeypatch.setattr(quantiles, "WITHIN", within)
    monkeypatch.setattr(quantiles, "GRID", 32)
    tries = []
    ranked = quantiles._ranked
    monkeypatch.setattr(quantiles, "_ranked", lambda *a: (tries.append(a), ranked(*a))[1])
    rng = np.random.default_rng(7)
    values = {"a": rng.normal(0, 1, 4000), "b": np.round(rng.exponential(2, 3000), 1), "c": np.array([1.0, 2.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None), ("d", None), ("b", float("nan"))], "k string, v double").repartition(4)
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], F.col("v"), probs, also={"n": F.count("*")}, slack=slack).collect()}
    assert {k: r.n for k, r in got.items()} == {"a": 4001, "b": 3001, "c": 2, "d": 1} and got["d"].q_0 is None
    for k, vs in values.items():
        assert [got[k][f"q_{i}"] for i in range(len(probs))] == pytest.approx(np.quantile(vs, probs), rel=1e-12)
    if slack < 0:
        assert len(tries) > 1


def test_infinite_values_have_ranks(spark):
    values = [float("-inf")] * 3 + [float(i) for i in range(2000)] + [float("inf")] * 2
    df = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    got = quantiles.exact_quantiles(df, ["k"], F.col("v"), [0.0, 0.5, 0.9]).first()
    assert (got.q_0, got.q_1) == (float("-inf"), 999.0) and got.q_2 == pytest.approx(1800.6)


def test_codes_of_values_that_begin_alike_come_from_many_parts(spark):
    """20,000 values with one beginning: even parts, codes in the order of the values."""
    names = spark.range(20_000).select(F.format_string("Customer#%09d", (F.col("id") * 7919) % 20_000).alias("c"), F.when(F.col("id") % 2 == 0, "p").alias("d"))
    encoder = prepare.fit_encoder(names.unionByName(names.limit(3000)), ["c", "d"])
    got = encoder.orderBy("column_name", "value").collect()
    assert [(r.value, r.code) for r in got[:20_000]] == [(f"Customer#{i:09d}", i) for i in range(20_000)]
    assert [(r.value, r.code) for r in got[20_000:]] == [("Unknown", 0), ("p", 1)]
    parts = spark.range(20_000).select(F.format_string("Customer#%09d", "id").alias("c")).repartitionByRange(8, "c").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 2 * 20_000 / 8


def test_encoding_joins_the_rows_once(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "new", None), (4, "b", "x")], "id int, c string, d string")
    train = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "x")], "c string, d string")
    encoder = prepare.fit_encoder(train, ["c", "d"])
    got = prepare.encode(rows, encoder, ["c", "d"])
    assert got.columns == rows.columns
    assert {r.id: (r.c, r.d) for r in got.collect()} == {1: (1, 0), 2: (0, 1), 3: (0, 2), 4: (2, 0)}
    assert {r.id: (r.c, r.u) for r in prepare.encode(rows, encoder, ["c"], ["u"]).collect()} == {1: ("a", 1), 2: (None, 0), 3: ("new", 0), 4: ("b", 2)}


@pytest.mark.parametrize("k", [5, 300])
def test_correlation_of_many_columns(spark, monkeypatch, k):
    """Against pandas: missing values, constants, large offsets, and partial results of many tasks."""
    monkeypatch.setattr(comoments, "FAN", 3)
    rng = np.random.default_rng(k)
    m = rng.normal(0, 1, (400, k)) + rng.normal(0, 1, (400, 1)) * rng.random(k)
    m[:, 1] += 1e8
    m[:, 2] = 3.7
    m[rng.random((400, k)) < 0.1] = np.nan
    m[:, 3] = np.nan
    names = [f"col {i}" for i in range(k)]
    pdf = pd.DataFrame(m, columns=names)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"`{c}` double" for c in names)).repartition(11)
    got = {(r[0], r[1]): r[2] for r in profile.correlation_long(df, names).collect()}
    want = pdf.corr(min_periods=2)
    assert len(got) == k * k
    for (a, b), r in got.items():
        w = want.loc[a, b]
        if names.index(a) in (2, 3) or names.index(b) in (2, 3):
            assert r is None
        elif a == b:
            assert r == 1.0
        else:
            assert r == pytest.approx(w, abs=2e-6 if "col 1" in (a, b) else 1e-9)


def test_correlation_without_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert profile.correlation_long(df, ["a", "b"]).collect() == []


def test_distinct_sketches_merge(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("p"), (F.col("id") % 20_000).cast("string").alias("c"), F.when(F.col("id") % 4 == 0, "z").alias("d"))
    states = profile.distinct_states(rows, "p", ["c", "d"])
    got = {r.column_name: r for r in profile.categorical_profile_from_states(states).collect()}
    assert abs(got["c"].n_unique - 20_000) <= profile.distinct_error() * 20_000 and got["d"].n_unique == 1
    assert (got["d"].null_count, got["d"].null_percent, got["c"].null_count) == (45_000, 75.0, 0)


def test_shares_of_more_categories_than_columns(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_CATEGORIES", 3)
    rows = spark.createDataFrame([("p", c) for c in "aabcde"] + [("q", "a"), ("q", None)], "p string, c string")
    got = quality.category_shares_wide(rows, "p", "c")
    assert got.columns == ["p", "category", "n", "percent"]
    assert {(r.p, r.category): r.percent for r in got.collect()} == pytest.approx({("p", "a"): 100 / 3, **{("p", c): 100 / 6 for c in "bcde"}, ("q", "a"): 100.0})
    assert quality.category_shares_wide(rows.where("c < 'd'"), "p", "c").columns == ["p", "pct_a", "pct_b", "pct_c"]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 3000, p=[0.9, 0.1]), "s": np.round(rng.exponential(3, 3000), 2), "w": 1})
    got = ordering.running_totals(spark.createDataFrame(pdf), ["g"], F.col("s"), {"w": F.col("w")}, descending).toPandas()
    for g, part in pdf.groupby("g"):
        counts = part.groupby("s").w.sum().sort_index(ascending=not descending)
        mine = got[got.g == g].set_index("value").cum_w.reindex(counts.index)
        assert (mine.values == counts.cumsum().values).all()
        assert (got[got.g == g].total_w == len(part)).all()


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 900), "label": rng.integers(0, 2, 900), "score": np.round(rng.random(900), 2)})
    pdf.loc[pdf.g == "a", "score"] = 0.5 + pdf.score * 1e-6  # all in one coarse bucket
    pdf.loc[pdf.g == "c", "label"] = 1
    got = {r.g: r.auc for r in evaluate.auc_by_group(spark.createDataFrame(pdf), ["g"], "label", "score").collect()}
    assert set(got) == {"a", "b"}  # one class only gives no row
    for g in got:
        part = pdf[pdf.g == g]
        assert got[g] == pytest.approx(brute_auc(part.label.values, part.score.values), abs=1e-12)


def test_evaluation_table(spark):
    rng = np.random.default_rng(4)
    n = 500
    pdf = pd.DataFrame({"inference_date": rng.choice(DATES, n), "label": rng.integers(0, 2, n), "default_probability": rng.random(n).round(2)})
    pdf["predicted_default"] = (pdf.default_probability > 0.5).astype(int)
    pdf.loc[pdf.inference_date == DATES[2], "label"] = 0
    got = {r.month: r for r in evaluate.evaluate_by_period(spark.createDataFrame(pdf), "inference_date").collect()}
    assert set(got) == set(DATES[:2])
    for date, r in got.items():
        p = pdf[pdf.inference_date == date]
        tp = ((p.label == 1) & (p.predicted_default == 1)).sum()
        fp = ((p.label == 0) & (p.predicted_default == 1)).sum()
        fn = ((p.label == 1) & (p.predicted_default == 0)).sum()
        assert (r.n_samples, r.true_positives, r.false_positives, r.false_negatives) == (len(p), tp, fp, fn)
        assert r.precision == pytest.approx(tp / (tp + fp))
        assert r.recall == pytest.approx(tp / (tp + fn))
        assert r.f1_score == pytest.approx(2 * tp / (2 * tp + fp + fn))
        assert r.false_negative_rate == pytest.approx(fn / (fn + tp))
        assert r.auc == pytest.approx(brute_auc(p.label.values, p.default_probability.values))
    assert len(got[DATES[0]]) == 15


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([("g", 1, 0), ("g", 0, 0)], "g string, label int, predicted int")
    row = evaluate.confusion_metrics(df, ["g"], "label", "predicted").first()
    assert (row.precision, row.recall, row.f1_score) == (0, 0, 0)


def test_score_histogram_matches_numpy(spark, scores):
    got = evaluate.score_histogram(spark.createDataFrame(scores), "s", "d", 50).toPandas().sort_values(["d", "bin"])
    assert set(got.d) == {DATES[0], DATES[2]}
    for date, part in got.groupby("d"):
        values = scores[scores.d == date].s.values
        counts, _ = np.histogram(values, 50)
        density, _ = np.histogram(values, 50, density=True)
        assert (part.n.values == counts).all()
        assert np.allclose(part.density.values, density)


def test_box_whiskers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -50.0]
    row = evaluate.box_stats(spark.createDataFrame([("k", v) for v in values], "k string, v double"), ["k"], "v").first()
    q1, q3 = np.percentile(values, [25, 75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert (row.q1, row.q3, row.whisker_low, row.whisker_high) == (q1, q3, min(inside), max(inside))


# --- nearest label -----------------------------------------------------------

def shifted(base, months):
    k = base.year * 12 + base.month - 1 + months
    return dt.date(k // 12, k % 12 + 1, 1)


def brute_match(pred, lab):
    out = {}
    for c, d, pd_, pr in pred:
        best = None
        for c2, ld, loan, y in lab:
            gap = (ld.year - d.year) * 12 + ld.month - d.month
            if c2 == c and -6 <= gap <= 12:
                cand = (abs(gap), ld, loan, y)
                best = cand if best is None or cand < best else best
        if best:
            mine = (pr, pd_)
            prev = out.get((c, d))
            out[(c, d)] = (min(mine, prev[0]) if prev else mine, best)
    return out


def test_nearest_label_against_all_pairs(spark):
    rng = np.random.default_rng(11)
    base = dt.date(2022, 1, 1)
    # one customer holds a third of the rows on both sides
    who = lambda: "hot" if rng.random() < 0.34 else f"c{rng.integers(0, 40)}"
    pred = [(who(), shifted(base, int(rng.integers(0, 40))), int(rng.integers(0, 2)), float(round(rng.random(), 2))) for _ in range(400)]
    lab = [(who(), shifted(base, int(rng.integers(0, 60))), f"L{i}", int(rng.integers(0, 2))) for i in range(300)]
    p = spark.createDataFrame(pred, "Customer_ID string, inference_date date, predicted_default int, default_probability double")
    y = spark.createDataFrame([(*r, "30dpd_6mob") for r in lab], "Customer_ID string, label_date date, loan_id string, label int, label_def string")
    got = {(r.Customer_ID, r.inference_date): ((r.default_probability, r.predicted_default), (abs(r.date_diff_months), r.label_date, r.loan_id, r.label))
           for r in match.nearest_label(p, y).collect()}
    assert got == brute_match(pred, lab)


@pytest.mark.parametrize("gaps,want", [([-2, 2], -2), ([-7, 13], None), ([-6], -6), ([12], 12), ([0, -1], 0), ([3, -5], 3), ([-7, 12], 12), ([13, -6], -6)])
def test_nearest_label_window(spark, gaps, want):
    base = dt.date(2024, 6, 1)
    p = spark.createDataFrame([("a", base, 1, 0.5)], "Customer_ID string, inference_date date, predicted_default int, default_probability double")
    y = spark.createDataFrame([("a", shifted(base, g), f"L{g}", 1, "x") for g in gaps], "Customer_ID string, label_date date, loan_id string, label int, label_def string")
    row = match.nearest_label(p, y).first()
    assert (row.date_diff_months if row else None) == want


# --- quality and profiles ----------------------------------------------------

def test_duplicates_count_null_once(spark):
    d = DATES[0]
    df = spark.createDataFrame([("a", d, 1.0), ("a", d, None), (None, d, 2.0), (None, d, 3.0)], "Customer_ID string, snapshot_date date, x double")
    row = quality.quality_by_period(df, "snapshot_date", "Customer_ID").first()
    assert (row.n_rows, row.n_duplicates) == (4, 2)
    assert row.missing_rate_pct == pytest.approx(3 / 4 * 100)


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"a": rng.normal(10, 3, 501), "b": rng.integers(0, 5, 501).astype(float)})
    pdf.loc[:20, "a"] = np.nan
    got = profile.describe_columns(spark.createDataFrame(pdf), ["a", "b"]).toPandas().set_index("column_name")
    want = pdf.describe().T
    for mine, theirs in (("n", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert np.allclose(got[mine].reindex(want.index), want[theirs])


def test_numeric_quality_with_nulls_only(spark):
    df = spark.createDataFrame([("1", None), ("x", None), ("2", None)], "t string, n double")
    got = {r.column_name: r for r in profile.numeric_quality(df, ["t", "n"]).collect()}
    assert (got["t"].non_numeric, got["t"].null_count, got["t"].max) == (1, 0, 2.0)
    assert (got["n"].null_count, got["n"].extreme_outliers, got["n"].min) == (3, 0, None)


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.random((200, 3)), columns=list("abc"))
    pdf["c"] = pdf.a * 2 + pdf.c * 0.01
    pdf.loc[:30, "a"] = np.nan
    pdf.loc[25:60, "b"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = profile.correlation_long(df, list("abc")).toPandas().pivot(index="feature_1", columns="feature_2", values="correlation")
    assert np.allclose(got.values, pdf.corr().values)
    pairs = profile.high_correlations(profile.correlation_long(df, list("abc")), list("abc")).collect()
    assert [(r.feature_1, r.feature_2) for r in pairs] == [("a", "c")]


def test_key_checks(spark):
    rows = [("l1", "a", DATES[0]), ("l2", "a", DATES[1]), (None, "b", DATES[1])]
    row = profile.key_checks(spark.createDataFrame(rows, "k string, c string, d date"), "k", "c", "d").first()
    assert (row.key_is_unique, row.n_entities, row.n_rows, row.n_dates, row.snapshot_days) == (True, 2, 3, 2, [1])
    row = profile.key_checks(spark.createDataFrame(rows + [(None, "b", DATES[1])], "k string, c string, d date"), "k", "c", "d").first()
    assert row.key_is_unique is False


# --- preparation -------------------------------------------------------------

def test_temporal_split_sizes(spark):
    base = dt.date(2023, 1, 1)
    df = spark.createDataFrame([(shifted(base, i),) for i in range(21)], "d date")
    got = prepare.split_dates(df, "d").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"train": 14, "val": 3, "test": 3, "oot": 1}


def test_scaler_is_population_std_and_zero_becomes_one(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    scaled = prepare.scale(df, prepare.fit_scaler(df, ["a", "b"]), ["a", "b"]).toPandas()
    a = np.array([1.0, 2.0, 4.0])
    assert np.allclose(sorted(scaled.a), (a - a.mean()) / a.std())
    assert (scaled.b == 0).all()


def test_unseen_categories(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    fresh = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    coded = [r.c for r in prepare.encode(fresh, prepare.fit_encoder(train, ["c"]), ["c"]).collect()]
    assert sorted(coded) == [0, 0, 1]  # "Unknown" sorts before lower case and takes the unseen value
    no_unknown = prepare.fit_encoder(train.na.drop(), ["c"])
    assert sorted(r.c for r in prepare.encode(fresh, no_unknown, ["c"]).collect()) == [0, 2, 2]


def test_codes_are_ordered_over_many_beginnings(spark):
    words = sorted({f"{a}{b}{i}" for a in ("", "a", "Ab", "zz", "\u00e9") for b in ("", "x", "yq") for i in range(40)} | {"", "a", "ab"})
    got = prepare.fit_encoder(spark.createDataFrame([(w,) for w in words], "c string"), ["c"]).collect()
    assert {r.value: r.code for r in got} == {w: i for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}


def test_folds_are_stratified_and_gap_free(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("label"))
    counts = prepare.stratified_folds(df, "label", ["id"]).groupBy("label").pivot("fold", [0, 1, 2]).count().collect()
    for r in counts:
        sizes = [r["0"], r["1"], r["2"]]
        assert max(sizes) - min(sizes) <= 1


def test_folds_with_many_copies_of_a_row(spark):
    df = spark.range(3000).select(F.lit(1).alias("label"), F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("key"))
    numbered = ordering.numbered_in_strata(df, "label", F.xxhash64("key"), "i")
    assert sorted(r.i for r in numbered.collect()) == list(range(3000))
    sizes = [r["count"] for r in prepare.stratified_folds(df, "label", ["key"]).groupBy("fold").count().collect()]
    assert sizes == [1000, 1000, 1000]


@pytest.mark.parametrize("low,high", [(0.0, 3e-6), (1e9, 1e9 + 2000), (0.0, 1.0), (-5.0, 5.0)])
def test_no_bucket_holds_many_values(spark, low, high):
    """Values that stand close together are still ordered by many tasks."""
    n = 50_000
    df = spark.range(n).select(F.lit("k").alias("k"), (F.lit(low) + (F.lit(high) - F.lit(low)) * F.col("id") / n).alias("v"))
    counts = ordering.value_counts_ordered(df, ["k"], F.col("v"), {"n": F.lit(1)}).cache()
    total = counts.count()
    for group, order in ordering.levels(["k"]):
        held = counts.groupBy(*group).agg(F.countDistinct(order).alias("n"))
        assert held.agg(F.max("n")).first()[0] <= 0.02 * total if group != ["k"] else True
    # Buckets keep the order of the values.
    names = [order for _, order in ordering.levels(["k"])][::-1]
    by_value = counts.orderBy("__value").select(*names).collect()
    assert by_value == sorted(by_value)
    counts.unpersist()


def test_rows_without_a_score_count(spark):
    rows = [("m", 1, 1, 0.9), ("m", 0, 1, None), ("m", 1, 0, float("nan")), ("m", 0, 0, 0.2), ("n", 1, 1, None), ("n", 0, 0, None)]
    df = spark.createDataFrame(rows, "month string, label int, predicted int, score double")
    got = {r.month: r for r in evaluate.evaluate_by_period(df, "month", "label", "predicted", "score").collect()}
    assert (got["m"].n_samples, got["m"].auc, got["m"].accuracy) == (4, 1.0, 0.5)
    assert (got["n"].n_samples, got["n"].auc, got["n"].accuracy) == (2, None, 1.0)
    same = {r.month: r for r in evaluate.confusion_metrics(df, ["month"], "label", "predicted").collect()}
    assert all((got[m].true_positives, got[m].false_positives) == (same[m].tp, same[m].fp) for m in got)


def test_pivots_take_all_values_found(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "new one"), (2, "a"), (2, None)], "d int, c string")
    got = {r.d: r for r in quality.category_shares_wide(df, "d", "c").collect()}
    assert sum(v for k, v in got[1].asDict().items() if k != "d") == pytest.approx(100)
    assert got[2]["pct_a"] == 100 and got[2]["pct_new one"] == 0


def test_bins_follow_the_edges_for_any_number(spark):
    for n in (2, 10, 16, 17, 50):
        edges = bins.edges(n)
        values = sorted({v for e in edges for v in (e, np.nextafter(e, 2), np.nextafter(e, -1))})
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        got = {r.x: r.b for r in df.select("x", bins.bin_index(F.col("x"), n).alias("b")).collect()}
        for v in values:
            want = None if not 0 <= v <= 1 else min(n - 1, sum(v >= e for e in edges[1:-1]))
            assert got[float(v)] == want


def test_cumulative_importance(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "feature string, importance double")
    rows = prepare.cumulative_importance(df).orderBy("position").collect()
    assert [r.feature for r in rows] == ["a", "b", "c"]
    assert [r.within_cutoff for r in rows] == [True, True, False]
