"""Exact dedup, SimHash and substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, simhash, substring_dedup


def norm(t):
    return (t or "").encode().lower()


def test_exact_decisions(docs, rows):
    best, size = {}, {}
    for i, t, *_ in rows:
        best[norm(t)] = max(i, best.get(norm(t), -1))
        size[norm(t)] = size.get(norm(t), 0) + 1
    want = {i: (best[norm(t)], size[norm(t)], best[norm(t)] == i, hashlib.sha256(norm(t)).digest()) for i, t, *_ in rows}
    got = {r["id"]: (r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"])) for r in exact_dedup.decisions(docs).collect()}
    assert got == want


def test_exact_runs_over_many_partitions(spark):
    """One group holds most rows and is cut by partition edges."""
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 8, "Same Text").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    got = exact_dedup.decisions(many.repartition(6)).collect()
    hot = [r for r in got if r["group_size"] > 1]
    assert len(got) == 3000 and len(hot) == 2400
    assert {(r["keep_id"], r["group_size"]) for r in hot} == {(2997, 2400)} and [r["id"] for r in hot if r["kept"]] == [2997]
    left = exact_dedup.keep_one(many.repartition(6))
    assert left.count() == 601 and left.filter("text = 'Same Text'").first()["doc_id"] == 2997


def test_texts_that_share_a_digest(spark, monkeypatch):
    """Neighbours are compared in full: equal digests don't make equal texts."""
    near = exact_dedup._Neighbours.__new__(exact_dedup._Neighbours)
    near.base, near.n, near.digest, near.texts = 0, -1, None, []
    found = [near.run_of(b"d", t) for t in (b"a", b"b", b"a", b"b")] + [near.run_of(b"e", b"a")]
    assert [f[0] for f in found] == [0, 1, 0, 1, 2] and [f[1] for f in found] == [True, True, False, False, True]


def test_exact_keeps_columns_and_one_row_of_repeated_ids(clashing, odd_ids, no_docs):
    left = exact_dedup.keep_one(clashing)
    assert left.columns == clashing.columns
    assert left.count() == clashing.select(F.sha2(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256)).distinct().count()
    odd = exact_dedup.decisions(odd_ids).collect()
    assert len(odd) == odd_ids.count()
    groups = {}
    for r in odd:
        groups.setdefault(bytes(r["digest"]), []).append(r)
    assert all(sum(r["kept"] for r in g) == 1 for g in groups.values())
    assert all(len({r["group_size"] for r in g}) == 1 and g[0]["group_size"] == len(g) for g in groups.values())
    assert exact_dedup.decisions(no_docs).count() == 0 and exact_dedup.keep_one(no_docs).count() == 0


def plain_fingerprint(t, width=3):
    w = norm(t).split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + width]), seed=42) for k in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """prints: id -> fingerprint; smallest reachable id of each."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_simhash_groups(docs, rows):
    prints = {i: plain_fingerprint(t) for i, t, *_ in rows}
    want = plain_components(prints)
    got = {r["id"]: (r["fp"] % 2**64, r["component"]) for r in simhash.near_groups(docs).collect()}
    assert got == {i: (prints[i], want[i]) for i in prints}
    assert len(set(want.values())) < len(want)


@pytest.mark.parametrize("hot", [4096, 3])
def test_links_of_dense_balls(spark, hot):
    """Fingerprints packed around centres, so groups are large; dealt once and twice."""
    rng = random.Random(2)
    prints = {}
    for c in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            prints.setdefault(x, len(prints))
    by_id = {i: x for x, i in prints.items()}
    want = plain_components(by_id)
    frame = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x, i) for x, i in prints.items()], "fp long, rep long")
    found = {r["node"]: r["component"] for r in simhash.components(simhash.links(frame, hot)).collect()}
    assert {i: found.get(i, i) for i in by_id} == want


def test_gray_index_search():
    rng = np.random.default_rng(1)
    codes = np.unique(np.concatenate([rng.integers(0, 2**63, 300, np.uint64), np.uint64(1) << rng.integers(0, 64, 40, np.uint64)]))
    q, member = simhash.GrayIndex(codes).search(codes[:100], 2)
    near = np.bitwise_count(codes[:100, None] ^ codes[None]) <= 2
    assert set(zip(q.tolist(), member.tolist())) == set(zip(*[x.tolist() for x in np.nonzero(near)]))
    ranks = simhash.gray_rank(np.array([0, 1, 3, 2, 6, 7, 5, 4], np.uint64))
    assert ranks.tolist() == list(range(8))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(300, 400)] + [(399, 130), (7, 7)]
    found = {r["node"]: r["component"] for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert set(found.values()) == {5} and len(found) == 61 + 100


def test_simhash_edges(clashing, odd_ids, no_docs):
    left = simhash.keep_one(clashing)
    assert left.columns == clashing.columns
    found = simhash.near_groups(odd_ids).collect()
    assert len(found) == odd_ids.count()
    assert all(r["component"] is not None for r in found if r["id"] is not None)
    known = {plain_fingerprint(r["text"]) for r in odd_ids.collect() if r["doc_id"] is not None}
    assert all((r["component"] is None) == (r["fp"] % 2**64 not in known) for r in found if r["id"] is None)
    assert None in {r["component"] for r in found}
    assert simhash.near_groups(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_simhash_keeps_a_row_of_every_component(spark, odd_ids, clashing):
    """A shared id that goes from one component stays in another, whose smallest it is."""
    a, b = "first text with several words of its own", "second one that shares nothing at all with it"
    shared = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (3, b), (None, a)], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(shared).collect()), key=repr) == [(1, a), (2, b), (None, a)]
    near = " ".join(["start", *(f"word{k}" for k in range(400))])
    chained = spark.createDataFrame([(1, near), (2, near + " end"), (2, b), (3, b)], "doc_id long, text string")
    assert 0 < (simhash.fingerprint(near.encode()) ^ simhash.fingerprint((near + " end").encode())).bit_count() <= 2
    assert sorted(map(tuple, simhash.keep_one(chained).collect()), key=repr) == [(1, near), (2, b)]
    for frame in (odd_ids.unionByName(odd_ids.selectExpr("doc_id + 1 AS doc_id", "text", "lang", "source", "n_chars")), clashing):
        groups = simhash.near_groups(frame).collect()
        left = simhash.keep_one(frame)
        stays = [(r["id"], r["fp"]) for r in groups if r["id"] is None or r["id"] == r["component"]]
        got = simhash.fingerprints(left, "doc_id", "text").collect()
        assert left.columns == frame.columns and sorted(map(repr, stays)) == sorted(repr((r["id"], r["fp"])) for r in got)
        component = {(r["id"], r["fp"]): r["component"] for r in groups}
        assert {component[r["id"], r["fp"]] for r in got} == {r["component"] for r in groups}


def plain_repeats(rows, width=50):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).digest()))
    return sorted(out)


@pytest.mark.parametrize("buckets", [None, 1, 64])
def test_repeats(docs, rows, buckets):
    got = substring_dedup.remove_repeats(docs, buckets=buckets).collect()
    assert sorted((r["id"], r["n_words"], r["n_removed"], bytes(r["digest"])) for r in got) == plain_repeats([(r[0], r[1]) for r in rows])
    assert sum(r["n_removed"] > 0 for r in got) > 10
    for r in got:
        assert sum(b - a for a, b in zip(r["spans"][::2], r["spans"][1::2])) == r["n_removed"]


def test_repeats_with_odd_ids(odd_ids, no_docs):
    with_id = [(r["doc_id"], r["text"]) for r in odd_ids.collect() if r["doc_id"] is not None]
    got = substring_dedup.remove_repeats(odd_ids).collect()
    assert len(got) == odd_ids.count()
    assert sorted((r["id"], r["n_words"], r["n_removed"], bytes(r["digest"])) for r in got if r["id"] is not None) == plain_repeats(with_id)
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_repeats_at_the_edge_of_a_window(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    texts = [base, base[100:149], base[100:150], ["x"] * 7 + base[33:83] + ["y"], base[200:260] + base[10:59], ["z"] * 60, ["z"] * 70, ["z"] * 49]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["id"]: r["n_removed"] for r in substring_dedup.remove_repeats(frame).collect()}
    assert got == {0: 0, 1: 0, 2: 50, 3: 50, 4: 60, 5: 0, 6: 70, 7: 0}


@pytest.mark.parametrize("h0,met", [(5, True), (5 + (1 << 32), False), (5 + (1 << 50), False)])
def test_windows_of_two_chunks_are_compared_by_all_bits(monkeypatch, h0, met):
    rows = []
    for chunk, lanes in ((1, (5, 9)), (2, (h0, 9))):
        monkeypatch.setattr(substring_dedup.Words, "hashes", lambda self, lane, at, *_, lanes=lanes: np.full(len(at), lanes[lane], np.uint64))
        rows += substring_dedup._window_rows(chunk, 1, [chunk], [b"w " * 50], [[0, 0]])
    found = [r for batch in substring_dedup._meet_windows(iter([substring_dedup._rows(rows)])) for r in batch.to_pylist()]
    kind = list(found[0])[2]
    assert [r[list(r)[1]] for r in found if r[kind] == substring_dedup.PROBES] == ([2] if met else [])


def test_packed_places():
    for gaps in ([0], [0, 0, 3, 254, 255, 256, 70_000, 1], [300]):
        places = np.cumsum(gaps)
        assert substring_dedup._unpack_places(substring_dedup._pack_places(places), len(places)).tolist() == places.tolist()
