"""Mixing against a plain calculation in Python."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def frame(spark, sizes, words=5):
    """sizes: source -> number of documents, ``words`` words each."""
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i, f"{i} " + "w " * (words - 1), s))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def counted(df):
    return mixing.token_counts(df, "doc_id", "text", "source").cache()


SIZES = {"big": 600, "mid": 90, "small": 30, None: 15}


def plain_entropy(sizes, a):
    w = [n**a for n in sizes.values()]
    w = [x / sum(w) for x in w]
    return -sum(x * math.log(x) for x in w)


def test_exponent_for_entropy(spark):
    counts = counted(frame(spark, SIZES))
    per = mixing.shares(counts)
    a = mixing.find_exponent(per, entropy=1.2)
    assert plain_entropy(SIZES, a) == pytest.approx(1.2, abs=1e-6)
    assert mixing.find_exponent(per, entropy=0.1) == 1.0  # the corpus itself has more
    assert mixing.find_exponent(per, entropy=9.0) == 0.0  # equal weights have less
    with pytest.raises(ValueError):
        mixing.find_exponent(per)


def test_exponent_for_repetitions(spark):
    counts = counted(frame(spark, SIZES))
    mix = {r["source"]: r for r in mixing.weights(counts, max_epochs=3.0).collect()}
    epochs = {s: r["budget"] / r["tokens"] for s, r in mix.items()}
    assert epochs["big"] == pytest.approx(1.0, abs=1e-3) and epochs[None] == pytest.approx(3.0, rel=1e-2)
    assert sum(r["weight"] for r in mix.values()) == pytest.approx(1.0)
    assert mixing.find_exponent(mixing.shares(counts), max_epochs=1.0) == pytest.approx(1.0)


@pytest.mark.parametrize("budget", [None, 700, 9000])
def test_budgets_are_met_by_permutations(spark, monkeypatch, budget):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    counts = counted(frame(spark, SIZES))
    mix = mixing.weights(counts, entropy=1.2, budget=budget)
    rows = mixing.shown(counts, mixing.plan(counts, mix)).collect()
    for r in mix.collect():
        mine = [x for x in rows if x["source"] == r["source"]]
        assert 0 <= sum(x["tokens"] for x in mine) - r["budget"] < 5
        by_epoch = {}
        for x in mine:
            by_epoch.setdefault(x["epoch"], []).append(x)
        assert all(len({x["id"] for x in e}) == len(e) for e in by_epoch.values())
        assert all(len(by_epoch[e]) == SIZES[r["source"]] for e in range(r["full"]))
        if r["rest"]:
            # The part epoch is a beginning of that epoch's order.
            ids = {x["id"] for x in by_epoch.get(r["full"], [])}
            order = counts.filter(F.col("source").eqNullSafe(F.lit(r["source"]))).select(
                "id", mixing._place(F.lit(r["full"]).cast("long"), mixing.SEED, F.col("id"), F.col("key")).alias("p")).orderBy("p").collect()
            assert {x["id"] for x in order[: len(ids)]} == ids
    if budget is None:
        assert {x["id"] for x in rows} == set(range(sum(SIZES.values())))
    # Epochs differ in order.
    blocks = [[x["id"] for x in sorted(rows, key=lambda x: x["place"]) if x["source"] is None and x["epoch"] == e] for e in (0, 1)]
    assert not blocks[1] or blocks[0] != blocks[1]


def test_mix_keeps_rows_and_columns(clashing, odd_ids, no_docs):
    mixed = mixing.mix(clashing, max_epochs=2.0)
    assert mixed.columns == clashing.columns
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert len(times) == clashing.count() and set(times.values()) <= {1, 2} and 2 in times.values()
    assert mixing.mix(odd_ids, max_epochs=2.0).distinct().count() == odd_ids.distinct().count()
    assert mixing.mix(no_docs, max_epochs=2.0).count() == 0 and mixing.mix(no_docs, entropy=1.0).count() == 0


def test_sources_without_tokens(spark):
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert sorted(r["doc_id"] for r in mixing.mix(empty, max_epochs=4.0).collect()) == [1, 2]


def test_a_tiny_source_beside_an_entropy_target(spark):
    """One word beside 200,000: equal weights would show it 200,000 times, the limit holds it."""
    rows = [(0, "word", "tiny")] + [(i, "many words here " * 50, "large") for i in range(1, 1335)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = mixing.token_counts(docs, "doc_id", "text", "source")
    target = mixing.entropy_target(counts, 0.95)
    per = mixing.shares(counts)
    assert mixing.find_exponent(per, entropy=target) < mixing.find_exponent(per, entropy=target, max_epochs=20.0)
    shown = mixing.mix(docs, entropy=target, max_epochs=20.0).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in shown}
    assert n["tiny"] <= 20 and n["large"] == 1334
    # A limit that the entropy does not touch changes nothing.
    loose = mixing.find_exponent(per, entropy=target, max_epochs=1e9)
    assert loose == mixing.find_exponent(per, entropy=target)
