"""Recall and exact scores of the neighbour search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neighbours

EVERY = 20


def is_query(i):
    return F.pmod(i, F.lit(EVERY)) == 0


def plain(vectors, k=20):
    """vectors: id -> array; the best k of every query."""
    ids = np.array(sorted(vectors))
    m = np.stack([vectors[i] for i in ids])
    out = {}
    for at, i in enumerate(ids.tolist()):
        if i % EVERY == 0:
            s = m @ m[at]
            s[at] = -np.inf
            best = np.lexsort((ids, -s))[: min(k, len(ids) - 1)]
            out[i] = [(int(ids[b]), float(s[b])) for b in best]
    return out


def searched(frame, **kwargs):
    out = {}
    for r in neighbours.nearest(frame, is_query, **kwargs).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    return out


@pytest.mark.parametrize("spread", [0.3, 3.0])
def test_recall(spark, monkeypatch, spread):
    """Clusters and loose clouds, vectors of different lengths, several blocks."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 1500)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 32))
    m = (centres[rng.integers(0, 30, 4000)] + spread * rng.standard_normal((4000, 32))) * rng.uniform(0.5, 2.0, (4000, 1))
    vectors = {i: m[i].astype(np.float32).astype(float) for i in range(4000)}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>").repartition(4)
    got, want = searched(frame), plain(vectors)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    for q, found in got.items():
        assert all(s == pytest.approx(float(vectors[i] @ vectors[q]), rel=1e-12, abs=1e-12) for i, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, []), (10, [1.0, 2.0, 3.0]), (20, [2.0, 0.0]), (40, None), (60, [0.0, 0.0]), (None, [1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = searched(frame)
    assert got == {0: [(20, 2.0), (1, 1.0), (None, 1.0), (2, 0.0), (3, -1.0)], 20: [(0, 2.0), (1, 2.0), (None, 2.0), (2, 0.0), (3, -2.0)]}
    assert neighbours.nearest(frame.limit(0), is_query).count() == 0
    assert neighbours.nearest(frame.filter("vec_id = 3"), is_query).count() == 0


def test_ties_and_repeated_rows(spark, monkeypatch):
    """Most rows are one vector; the smallest ids win, and a row with the query's id is a candidate."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(500)] + [(i, [1.0, 0.0, float(i)]) for i in range(500, 540)] + [(0, [1.0, 1.0, 0.0])]
    got = searched(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    assert [i for i, _ in got[100]] == [0, 0, *range(1, 19)]
    assert len(got[0]) == 40 and sorted(i for i, _ in got[0])[:2] == [0, 0]
    assert [i for i, _ in got[500]][:3] == [539, 538, 537]


@pytest.mark.parametrize("sizes", [[1e-200] * 50, [1.0] * 50 + [1e200], [1e-300, 1.0, 1e300] * 20, [1e308] * 30])
def test_extreme_lengths(spark, sizes):
    """Lengths that under- or overflow: the search ends, and with ``exact`` gives what doubles give."""
    rng = np.random.default_rng(1)
    m = rng.uniform(0.1, 1, (len(sizes), 8)) * rng.choice([-1, 1], (len(sizes), 8)) * np.array(sizes)[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    with np.errstate(all="ignore"):
        scores = np.nan_to_num(np.einsum("ij,kj->ik", m, m), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
    got = searched(frame, exact=True, k=5)
    for q, found in got.items():
        order = [i for i in np.lexsort((np.arange(len(m)), -scores[q])) if i != q][:5]
        assert [s for _, s in found] == pytest.approx([scores[q][i] for i in order])
        if np.isfinite(scores[q]).all():
            assert [i for i, _ in found] == order
    assert {q: len(f) for q, f in searched(frame, k=5).items()} == {q: 5 for q in got}


def test_exact_setting(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 300)
    m = np.random.default_rng(8).standard_normal((1000, 16))
    vectors = {i: m[i] for i in range(1000)}
    got = searched(spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>"), exact=True)
    want = plain(vectors)
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}


def test_verified_vectors_grow_slower_than_the_table():
    sizes = [neighbours.share_verified(n) * n for n in (2_000, 20_000, 200_000, 2_000_000)]
    assert all(1 < b / a < 10 ** 0.86 for a, b in zip(sizes, sizes[1:]))
