"""Codebooks, codes and the tree of entries against brute force in whole numbers."""

import math

import numpy as np
import pytest

from tidemark.llm import vector_codes
from tidemark.llm.vector_codes import Gnat


def plain(vectors, entries=64, rounds=2, parts=16):
    """vectors: list of (id, components); (codes, errors, books)."""
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors]
    width = len(ints[0][1]) // parts
    first = sorted(ints)[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v in first] for p in range(parts)]

    def nearest(book, w):
        return min((sum((a - b) ** 2 for a, b in zip(w, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for _, v in ints:
                w = v[p * width : (p + 1) * width]
                mine.setdefault(nearest(books[p], w)[1], []).append(w)
            books[p] = [[sum(c) // len(mine[k]) for c in zip(*mine[k])] if k in mine else e for k, e in enumerate(books[p])]
    codes, errors = {}, {}
    for i, v in ints:
        found = [nearest(books[p], v[p * width : (p + 1) * width]) for p in range(parts)]
        codes[i], errors[i] = "".join(f"{k:02x}" for _, k in found), sum(g for g, _ in found)
    return codes, errors, np.array(books)


@pytest.mark.parametrize("spread,n", [(2, 40), (300, 200), (1, 90), (1 << 26, 70)])
def test_tree_finds_the_first_of_the_nearest(spread, n):
    """Small grids make ties and equal entries; large ones need distances beyond a double."""
    rng = np.random.default_rng(n)
    points = rng.integers(-spread, spread + 1, (n, 4))
    asked = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (500, 4)) // 2, points[::3], (points[:-1] + points[1:]) // 2])
    tree = Gnat(points)
    entry, gap = tree.nearest(asked)
    gaps = ((asked[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (entry == gaps.argmin(axis=1)).all() and (gap == gaps.min(axis=1)).all()
    assert tree.measured < gaps.size or spread == 1


def test_codes_like_brute_force(spark):
    rng = np.random.default_rng(1)
    m = np.round(rng.standard_normal((300, 32)) * 3) / 8  # a coarse grid: many ties
    vectors = [(int(i), m[i].tolist()) for i in rng.permutation(300)]
    rows = vector_codes.usable(spark.createDataFrame([(i, v, i % 3) for i, v in vectors], "vec_id long, embedding array<float>, label int").repartition(5))
    books = vector_codes.codebooks(rows)
    codes, errors, want = plain(vectors)
    assert (books == want).all()
    got = vector_codes.encode(rows, books).collect()
    assert {r["id"]: r["code"] for r in got} == codes and {r["id"]: r["error"] for r in got} == errors
    back = vector_codes.decode(vector_codes.encode(rows, books), books).where("id = 7").first()
    flat = [x / 256 for p in range(16) for x in books[p][int(codes[7][2 * p : 2 * p + 2], 16)]]
    assert back["decoded"] == flat


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5, -0.25] * 8
    rows = [(0, good, 1), (1, good, None), (1, good, None), (2, None, 1), (3, [nan] + good[1:], 1), (4, good[1:] + [-inf], 1), (5, [None] + good[1:], 1),
            (6, [], 1), (7, good[:5], 1), (8, good * 2, 1), (9, [1e300] + good[1:], 1), (None, [x + 1 for x in good], None)]
    frame = spark.createDataFrame([(*r, 2.5) for r in rows], "vec_id long, embedding array<double>, label int, vec double")
    used = vector_codes.usable(frame)
    assert sorted((r["id"] for r in used.collect()), key=str) == [0, 1, 1, None]
    books = vector_codes.codebooks(used)
    assert books.shape == (16, 4, 1) and len(vector_codes.digest(books)) == 64
    found = {r["id"]: (r["code"], r["error"]) for r in vector_codes.encode(used, books).collect()}
    assert found == {0: ("00" * 16, 0), 1: ("00" * 16, 0), None: ("03" * 16, 0)}  # equal entries: the first
    none = vector_codes.usable(frame.limit(0))
    assert vector_codes.encode(none, vector_codes.codebooks(none)).count() == 0
