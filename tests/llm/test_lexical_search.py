"""Ranked search against scoring every document."""

import math
import re

import numpy as np
import pytest

from llm_tables import CLASHING, DOCS
from tidemark.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def plain(items, docs, k=10):
    """(item, rank, id, score) by scoring every document for every item."""
    bags = [(i, terms(t)) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            score = 0
            for t in set(terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * len(bag) * n_docs) // total
                score += w * ((1_000_000_000 * bag.count(t)) // (1000 * bag.count(t) + 8 * m))
            if score > 0:
                found.append((-score, i if i is not None else 1 << 63))
        out += [(item, r + 1, i if i < 1 << 63 else None, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def searched(items, docs, **kwargs):
    return sorted((tuple(r) for r in lexical_search.search(items, docs, **kwargs).collect()), key=str)


@pytest.fixture(scope="module")
def questions(rows):
    texts = [" ".join((r[1] or "").split()[:25]) for r in rows[:30]] + ["", None, "Été ÉTÉ A", "zzz unknown", "!!", "ban Ban BAN koran"]
    return list(enumerate(texts))


@pytest.mark.parametrize("shard,read", [(7, 1), (64, 4), (8192, 32)])
def test_like_scoring_all(spark, monkeypatch, docs, rows, questions, shard, read):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical_search, "FIRST_READ", read)
    got = searched(spark.createDataFrame(questions, ITEMS), docs)
    assert got == plain(questions, [r[:2] for r in rows]) and got


def test_groups_of_queries(spark, monkeypatch, docs, rows, questions):
    monkeypatch.setattr(lexical_search, "GROUP_TERMS", 300)
    assert searched(spark.createDataFrame(questions, ITEMS), docs, k=3) == plain(questions, [r[:2] for r in rows], 3)


def test_odd_rows(spark, odd_ids, no_docs, rows, questions):
    items = spark.createDataFrame([(i, t, 1.0) for i, t in questions + questions[:2]], ITEMS + ", rank double")
    odd = [(r["doc_id"], r["text"]) for r in odd_ids.collect()]
    assert searched(items, odd_ids) == plain(questions + questions[:2], odd)
    assert searched(items, no_docs) == [] and searched(items.limit(0), odd_ids) == []
    wide = spark.createDataFrame([(*r, *([1.5] * 10)) for r in rows], CLASHING)
    assert searched(items, wide.limit(30)) == plain(questions + questions[:2], [(r["doc_id"], r["text"]) for r in wide.limit(30).collect()])


def test_ties_take_small_ids(spark):
    docs = [(i, "same words here") for i in range(50)] + [(i, f"other text {i}") for i in range(50, 200)]
    got = searched(spark.createDataFrame([(1, "words")], ITEMS), spark.createDataFrame(docs, "doc_id long, text string").repartition(6))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(10))


def test_stops_early():
    """Long lists with few high impacts are not read to their ends."""
    rng = np.random.default_rng(2)
    n, t = 20_000, 4
    doc = np.concatenate([np.sort(rng.permutation(n)[: n // 2]) for _ in range(t)])
    term = np.repeat(np.arange(t), n // 2)
    impact = np.floor(1e6 * rng.random(len(doc)) ** 8).astype(np.int64) + 1
    shard = lexical_search.Shard(np.arange(n), doc, term, impact, t)
    found, score = shard.search(np.arange(t), 10)
    whole = np.zeros(n, np.int64)
    np.add.at(whole, doc, impact)
    want = np.lexsort((np.arange(n), -whole))[:10]
    assert found.tolist() == want.tolist() and score.tolist() == whole[want].tolist()
    assert shard.read < shard.there / 4


def test_documents_without_terms(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "b"), (5, "a a b")]
    items = [(1, "a"), (2, "b"), (3, "a b")]
    got = searched(spark.createDataFrame(items, ITEMS), spark.createDataFrame([(*d, None, None, None) for d in docs], DOCS))
    assert got == plain(items, docs)
