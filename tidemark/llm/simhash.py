"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: words of the text (A-Z lower-cased, split at ASCII white space) in
shingles of ``width``, repeats included, joined by one space; a bit is set if it
is set in over half of the shingles' XXH64 (seed 42).  Shorter texts hash their
whole word sequence; texts without words have fingerprint zero and are linked
like any other.  Null texts count as empty.

Links: fingerprints at most two bits apart.  Of four blocks of 16 bits at least
two agree for such a pair, so each fingerprint goes to six groups, one for each pair of
blocks; a group that is larger than ``hot`` is dealt once more by the other 32
bits, after which it holds 2**16 fingerprints at most.  Within a group the
fingerprints are sorted by Gray rank and a tree over them factors the bits that
all fingerprints below a node share.  A search adds up differences from the
root down and leaves a node, with all that is below it, once they pass the limit.
A group emits a spanning set of its links, not all pairs.

Components of fingerprints follow by alternating large and small stars.
``component_id`` is the smallest id that a component holds, and null only if no
row of it has one; a shared id does not link texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, query, stored, table

SEED = 42
WIDTH = 3
MAX_BITS = 2
#: Members above which a group is dealt once more.
HOT_GROUP = 4096
_FAN = 8
_CHUNK = 1 << 16


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The 64-bit fingerprint of one UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    whole = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(words) - width + 1)]
    ends = ends[min(width, len(words)) - 1 :]
    of = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = [of(whole[s:e], SEED) for s, e in zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist())]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts)).view(">u8")[0])


def printer(width: int = WIDTH):
    """Column function: text to the fingerprint's bits as a signed long."""

    @F.arrow_udf("long")
    def fp(text: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, width) for t in as_bytes(text)], np.uint64).view(np.int64))

    return fp


def fingerprints(df: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """id and fp of every row."""
    return df.select(F.col(id_col).cast("long").alias("id"), printer(width)(F.col(text_col)).alias("fp"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A tree over fingerprints in Gray order; a node holds the bits that all below it share."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        pattern, mask = codes[self.order], np.full(len(codes), ~np.uint64(0))
        self.levels = [(pattern, mask)]
        while len(pattern) > 1:
            starts = np.arange(0, len(pattern), _FAN)
            first = np.repeat(pattern[starts], np.diff(np.append(starts, len(pattern))))
            differ = np.bitwise_or.reduceat((pattern ^ first) | ~mask, starts)
            pattern, mask = pattern[starts] & ~differ, ~differ
            self.levels.append((pattern, mask))

    def search(self, wanted: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) of all members at most ``most`` bits from a query."""
        q = np.arange(len(wanted))
        pattern, mask = self.levels[-1]
        node, sum_ = np.zeros(len(wanted), np.int64), np.bitwise_count((wanted ^ pattern[0]) & mask[0]).astype(np.int64)
        q, node, sum_ = q[sum_ <= most], node[sum_ <= most], sum_[sum_ <= most]
        for above, (pattern, mask) in zip(self.levels[:0:-1], self.levels[-2::-1]):
            child = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
            own, gone = np.repeat(q, _FAN), np.repeat(sum_, _FAN)
            up = np.repeat(above[1][node], _FAN)
            real = child < len(pattern)
            child, own, gone, up = child[real], own[real], gone[real], up[real]
            gone = gone + np.bitwise_count((wanted[own] ^ pattern[child]) & mask[child] & ~up)
            near = gone <= most
            q, node, sum_ = own[near], child[near], gone[near]
        return q, self.order[node]


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest-member labels after joining a[i] with b[i]; ``label`` points at roots."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low != high
        if not open_.any():
            return label
        np.minimum.at(label, high[open_], low[open_])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def group_links(codes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (root, member) of one group's pairs within ``most`` bits."""
    index = GrayIndex(codes)
    label = np.arange(len(codes))
    step = max(1, (1 << 20) // len(codes))
    for at in range(0, len(codes), step):
        q, member = index.search(codes[at : at + step], most)
        label = unite(label, q + at, member)
    member = np.flatnonzero(label != np.arange(len(codes)))
    return label[member], member


def _links(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] | None = None

        def complete(keys, codes, reps):
            cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            a, b = [], []
            for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(codes))):
                if hi - lo > 1:
                    root, member = group_links(codes[lo:hi], most)
                    a.append(reps[lo:hi][root])
                    b.append(reps[lo:hi][member])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("k0", "k1", "k2", "k3", "fp", "rep")]
            keys, codes, reps = np.stack(now[:4]), now[4].view(np.uint64), now[5]
            if rest is not None:
                keys, codes, reps = np.concatenate([rest[0], keys], axis=1), np.concatenate([rest[1], codes]), np.concatenate([rest[2], reps])
            last = np.flatnonzero((keys != keys[:, -1:]).any(axis=0)) if len(codes) else []
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield complete(keys[:, :cut], codes[:cut], reps[:cut])
            rest = keys[:, cut:], codes[cut:], reps[cut:]
        if rest is not None and len(rest[1]):
            yield complete(*rest)

    return run


def _pairs_of_blocks(fp, bits: list[int], parts: int) -> list[tuple]:
    """(key, bits left) for each way to keep all but MAX_BITS of ``parts`` blocks of these bit places."""
    size = len(bits) // parts
    blocks = [bits[i * size : (i + 1) * size] for i in range(parts)]
    out = []
    for kept in combinations(range(parts), parts - MAX_BITS):
        key = F.lit(0).cast("long")
        for k in kept:  # a block is a run of neighbouring bit places
            low = blocks[k][0]
            key = F.shiftleft(key, size).bitwiseOR(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << size) - 1)))
        left = [b for i, block in enumerate(blocks) if i not in kept for b in block]
        out.append((key, left))
    return out


def links(prints: DataFrame, hot: int = HOT_GROUP) -> DataFrame:
    """(a, b) that connect all fingerprints at most MAX_BITS apart; ``prints`` has distinct fp with rep."""
    fp = F.col("fp")
    first = _pairs_of_blocks(fp, list(range(64)), 4)
    dealt = prints.select("fp", "rep", F.posexplode(F.array(*[k for k, _ in first])).alias("k0", "k1"))
    sizes = stored(dealt.groupBy("k0", "k1").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-groups")
    rows = dealt.join(sizes, ["k0", "k1"])
    cold = rows.filter(F.col("n") <= hot).select("fp", "rep", "k0", "k1", F.lit(-1).alias("k2"), F.lit(0).cast("long").alias("k3"))
    second = F.array(*[F.array(*[key for key, _ in _split_rest(fp, left)]) for _, left in first])
    warm = rows.filter(F.col("n") > hot).select("fp", "rep", "k0", "k1", F.posexplode(F.element_at(second, F.col("k0") + 1)).alias("k2", "k3"))
    keys = ["k0", "k1", "k2", "k3"]
    return cold.unionByName(warm).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links(MAX_BITS), "a long, b long")


def _split_rest(fp, left: list[int]) -> list[tuple]:
    """The second deal: four blocks of eight of the 32 places that the first left open."""
    return _pairs_of_blocks(fp, left, 4)


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reached) of every node of ``edges`` (a, b).

    Alternating stars: each node's larger neighbours move to its smallest one,
    then each node and its smaller neighbours do, until all edges lead to roots.
    Both sides of every join are stored tables, so a hub's rows can be split.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "links-low")
        large = stored(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links-large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "links-low")
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").filter("u <> v").distinct(), "links")


def grouped(rows: DataFrame, hot: int = HOT_GROUP) -> DataFrame:
    """fp, component of every distinct fingerprint of ``rows`` (id, fp; a stored table)."""
    # Classes meet under their fingerprints, not under ids: texts that differ may share an id.
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-distinct")
    found = components(links(prints.select("fp", F.col("fp").alias("rep")), hot))
    rooted = stored(
        prints.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("component", "fp").alias("root")), "simhash-rooted")
    least = stored(rooted.groupBy("root").agg(F.min("least_id").alias("component")), "simhash-least")
    return stored(rooted.join(least, "root").select("fp", "component"), "simhash-components")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, hot: int = HOT_GROUP) -> DataFrame:
    """id, fp, component of every row."""
    rows = stored(fingerprints(df, id_col, text_col, width), "simhash-fingerprints")
    return rows.join(grouped(rows, hot), "fp", "left").select("id", "fp", "component")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows that stay, with all their columns: of each component the one with the smallest id.

    Rows without an id and rows that share the smallest id of a component stay.  Rows are removed by id and
    fingerprint, since texts of several components may share an id.  The rows are stored once with their
    fingerprint, which is made once.
    """
    own_fp = "simhash_of_row"
    while own_fp in df.columns:
        own_fp += "_"
    own = stored(df.withColumn(own_fp, printer(width)(F.col(text_col))), "simhash-rows")
    rows = own.select(F.col(id_col).cast("long").alias("id"), F.col(own_fp).alias("fp"))
    found = rows.join(grouped(rows), "fp")
    gone = stored(found.filter("id <> component").select(F.col("id").alias("gone_id"), F.col("fp").alias("gone_fp")).distinct(), "simhash-gone")
    return own.join(gone, (F.col(id_col).cast("long") == F.col("gone_id")) & (F.col(own_fp) == F.col("gone_fp")), "left_anti").select(
        *[F.col(f"`{c}`") for c in df.columns])


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of every document."""
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
