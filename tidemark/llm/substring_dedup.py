"""Substring dedup with fixed-block anchors.

A window is ``WINDOW`` consecutive words of one text.  Words covered by a window
whose words also start in a document with a smaller id are removed.

1. Anchors: each document gives its non-overlapping blocks of ``BLOCK`` words as
   reference, and every rolling stretch of ``BLOCK`` words as a probe.  A window holds at least one
   whole block (2 * BLOCK - 1 <= WINDOW), so a window that two documents share
   shows up as a block of one that a probe of the other meets.  Probes travel as
   packed short hashes, dealt by hash; a false match only costs work later.
2. Extension: around each hit all windows that hold the block are taken.  The
   word sequences of windows are compared by 128-bit hashes, dealt by hash, and
   each finds its smallest document.  Adjoining windows make up the maximal repeats.
   Hits are never paired, so a passage that thousands of documents share costs
   a row per place, not a row per pair.

Stretches that meet within a chunk (a few MB of text) are settled there; a chunk
sends each hash on once, so a passage that a third of all documents hold sends one entry per chunk.

Null texts have no words.  Documents that share an id don't remove each other's
words.  Those without an id come after all ids, ordered by a hash of their text.
Ids are below 2**62.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, power_of_two, query, shuffle_partitions, stored, table

WINDOW = 50
BLOCK = 25
#: Text of a chunk; the arrays over it take about a hundred times as much.
CHUNK_BYTES = 1 << 19
#: Buckets of hashes for each shuffle partition; a task holds one bucket at a time.
BUCKETS_PER_PARTITION = 4
#: From here on numbers stand for rows without an id.
NO_ID = 1 << 62
_LANES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)  # odd bases of the two rolling hashes
_TABLE = np.random.default_rng(42).integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)


class Words:
    """The words of some texts, one after another, with rolling hashes over any stretch."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]
        self.per_text = np.array([len(w) for w in split], np.int64)
        self.first = np.cumsum(self.per_text) - self.per_text
        self.joined = b" ".join([w for words in split for w in words])
        n = int(self.per_text.sum())
        lengths = np.fromiter((len(w) for words in split for w in words), np.int64, n)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths

    def lane(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of byte * base**place, and the inverse powers that shift a stretch to place 0."""
        data = np.frombuffer(self.joined, np.uint8)
        base = int(_LANES[k])
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[k][data] * _powers(base, len(data)), out=sums[1:])
        return sums, _powers(pow(base, -1, 1 << 64), len(data))

    def hashes(self, k: int, at: np.ndarray, width: int, lane) -> np.ndarray:
        """Hash of ``width`` words from each word place in ``at``."""
        sums, inverse = lane
        h = (sums[self.ends[at + width - 1]] - sums[self.starts[at]]) * inverse[self.starts[at]]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.ones(power_of_two(max(n, 1 << 18)), np.uint64)
        size = 1
        while size < len(known):
            known[size : 2 * size] = known[:size] * np.uint64(pow(base, size, 1 << 64))
            size *= 2
        _POWERS[base] = known
    return known[:n]


def _stretches(per_text: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Places (in all words) where a stretch of ``width`` words of one text starts."""
    fits = np.maximum(per_text - width + 1, 0)
    fits[per_text < WINDOW] = 0
    return np.repeat(first - (np.cumsum(fits) - fits), fits) + np.arange(int(fits.sum()))


def _pack_places(places: np.ndarray) -> bytes:
    """Ascending places: a byte for a gap below 255, else 255 and the gap in four bytes behind."""
    gaps = np.diff(places, prepend=0)
    wide = gaps >= 255
    return np.minimum(gaps, 255).astype(np.uint8).tobytes() + gaps[wide].astype("<u4").tobytes()


def _unpack_places(data: bytes, n: int) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint8, n).astype(np.int64)
    wide = gaps == 255
    gaps[wide] = np.frombuffer(data, "<u4", int(wide.sum()), n)
    return np.cumsum(gaps)


_SCHEMA = "bucket int, chunk long, kind int, n int, payload binary, ids array<long>, counts array<long>, texts array<binary>, local binary, keys array<long>, digests array<binary>"
_FIELDS = pa.schema([
    ("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("payload", pa.binary()),
    ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary())), ("local", pa.binary()),
    ("keys", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary()))])
PROBES, CHUNK = 0, 1


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)], schema=_FIELDS)


def _bucket_of(chunk: int, buckets: int) -> int:
    """Where a chunk's own row goes: evenly, whatever the pattern of chunk numbers."""
    return (chunk * int(_LANES[0]) % (1 << 64) >> 40) % buckets


def _dealt(hashes: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, entries in order of place) by the top bits of the hash."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    bucket = (hashes >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(hashes), np.int64)
    order = np.lexsort((places, bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if cuts[b] < cuts[b + 1]:
            yield b, order[cuts[b] : cuts[b + 1]]


def _anchor_chunks(buckets: int):
    """Packed probes of each chunk, and the chunk's documents with the places settled here."""
    short = np.uint64(64 - (buckets.bit_length() - 1) - 39)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for piece in pieces(batches, most_bytes=CHUNK_BYTES):
            texts = as_bytes(piece.column("text"))
            words = Words(texts)
            chunk = part << 24 | seq
            seq += 1
            at = _stretches(words.per_text, words.first, BLOCK)
            if not len(at):
                continue
            h = words.hashes(0, at, BLOCK, words.lane(0))
            block = (at - np.repeat(words.first, words.per_text)[at]) % BLOCK == 0
            order = np.argsort(h, kind="stable")
            head = np.append(True, h[order][1:] != h[order][:-1])
            runs = np.flatnonzero(head)
            size = np.diff(np.append(runs, len(order)))
            has_block = np.logical_or.reduceat(block[order], runs)
            local = np.sort(at[order[np.repeat(size > 1, size)]])
            once = order[runs]  # the first place of each hash
            entry_h, entry_at = h[once], at[once]
            rows = []
            for b, which in _dealt(entry_h, entry_at, buckets):
                # 39 bits of the hash and whether a block has it, in five bytes.
                code = ((entry_h[which] >> short) & np.uint64((1 << 39) - 1)) << np.uint64(1) | has_block[which].astype(np.uint64)
                planes = code.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                rows.append((b, chunk, PROBES, len(which), planes.tobytes() + _pack_places(entry_at[which]), *[None] * 6))
            rows.append((_bucket_of(chunk, buckets), chunk, CHUNK, len(local), None, piece.column("id").to_pylist(), words.per_text.tolist(), None,
                         _pack_places(local), piece.column("key").to_pylist(), None))
            yield _rows(rows)

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one bucket at a time, from sorted batches."""
    now, held = None, []
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
            if row[0] != now and held:
                yield held
                held = []
            now = row[0]
            held.append(row)
    if held:
        yield held


def _meet_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of each chunk whose stretch another chunk has too, one of them as a block."""
    for group in _by_bucket(batches):
        out = [row for row in group if row[2] == CHUNK]
        probes = [row for row in group if row[2] == PROBES]
        if len(probes) > 1:
            planes = np.frombuffer(b"".join(r[4][: 5 * r[3]] for r in probes), np.uint8).reshape(-1, 5)
            code = np.zeros(len(planes), np.uint64)
            for k in range(5):
                code |= planes[:, k].astype(np.uint64) << np.uint64(8 * k)
            order = np.argsort(code, kind="stable")
            ranked = code[order]
            runs = np.flatnonzero(np.append(True, (ranked[1:] >> np.uint64(1)) != (ranked[:-1] >> np.uint64(1))))
            size = np.diff(np.append(runs, len(ranked)))
            live = (size > 1) & ((ranked[runs + size - 1] & np.uint64(1)) == 1)  # sorted: a block's entry is the last
            hit = np.zeros(len(code), bool)
            hit[order[np.repeat(live, size)]] = True
            at = 0
            for r in probes:
                mine = hit[at : at + r[3]]
                at += r[3]
                if mine.any():
                    places = _unpack_places(r[4][5 * r[3] :], r[3])[mine]
                    out.append((r[0], r[1], PROBES, len(places), _pack_places(places), *[None] * 6))
        if out:
            yield _rows(out)


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    """(chunk row, all places found for it), from rows sorted by chunk with the chunk row first."""
    head, places = None, []
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
            if row[2] == CHUNK:
                if head is not None:
                    yield head, np.concatenate(places)
                head, places = row, [_unpack_places(row[8], row[3])]
            else:
                places.append(_unpack_places(row[4], row[3]))
    if head is not None:
        yield head, np.concatenate(places)


def _chunked(found: DataFrame) -> DataFrame:
    return found.repartition("chunk").sortWithinPartitions("chunk", F.col("kind").desc())


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document with hits: window starts to examine, as (from, to) pairs of word places."""
    for head, places in _by_chunk(batches):
        counts = np.array(head[6], np.int64)
        first = np.cumsum(counts) - counts
        doc = np.searchsorted(first, places, side="right") - 1
        order = np.lexsort((places, doc))
        ids, spans = [], []
        for k, at in zip(*_split_at(doc[order], places[order])):
            p = at - first[k]
            lo, hi = np.maximum(p - (WINDOW - BLOCK), 0), np.minimum(p, counts[k] - WINDOW)
            keep = lo <= hi
            lo, hi = lo[keep], hi[keep]
            if len(lo):
                cut = np.flatnonzero(lo[1:] > np.maximum.accumulate(hi)[:-1] + 1)
                lo, hi = lo[np.append(0, cut + 1)], np.maximum.accumulate(hi)[np.append(cut, len(hi) - 1)]
                ids.append((head[5][k], head[9][k], np.stack([lo, hi], 1).ravel().tolist()))
        if ids:
            yield pa.RecordBatch.from_pydict({
                "id": pa.array([i for i, _, _ in ids], pa.int64()), "key": pa.array([k for _, k, _ in ids], pa.int64()),
                "spans": pa.array([s for _, _, s in ids], pa.list_(pa.int64()))})


def _split_at(keys: np.ndarray, values: np.ndarray) -> tuple[list, list]:
    """Distinct keys of a sorted array, and the values of each."""
    if not len(keys):
        return [], []
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return keys[np.append(0, cuts)].tolist(), np.split(values, cuts)


DONE = 2
_WINDOW_BYTES = 16


def _window_chunks(buckets: int):
    """Finished rows of documents without spans; packed window hashes of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for piece in pieces(batches, most_bytes=CHUNK_BYTES):
            chunk = part << 24 | seq
            seq += 1
            ids, texts = piece.column("id").to_pylist(), as_bytes(piece.column("text"))
            spans = piece.column("spans").to_pylist()
            rows = []
            done = [k for k, s in enumerate(spans) if s is None]
            if done:
                split = [texts[k].split() for k in done]
                rows.append((_bucket_of(chunk, buckets), chunk, DONE, 0, None, [ids[k] for k in done], [len(w) for w in split],
                             None, None, None, [hashlib.sha256(b" ".join(w)).digest() for w in split]))
            todo = [k for k, s in enumerate(spans) if s is not None]
            if todo:
                rows += _window_rows(chunk, buckets, [ids[k] for k in todo], [texts[k] for k in todo], [spans[k] for k in todo])
            yield _rows(rows)

    return run


def _window_rows(chunk: int, buckets: int, ids: list, texts: list[bytes], spans: list[list[int]]) -> list[tuple]:
    words = Words(texts)
    at = np.concatenate([np.arange(words.first[k] + s[i], words.first[k] + s[i + 1] + 1) for k, s in enumerate(spans) for i in range(0, len(s), 2)])
    doc = np.searchsorted(words.first, at, side="right") - 1
    owner = np.array(ids, np.int64)[doc]
    h0, h1 = words.hashes(0, at, WINDOW, words.lane(0)), words.hashes(1, at, WINDOW, words.lane(1))
    order = np.lexsort((owner, h1, h0))
    s0, s1, so = h0[order], h1[order], owner[order]
    runs = np.flatnonzero(np.append(True, (s0[1:] != s0[:-1]) | (s1[1:] != s1[:-1])))
    size = np.diff(np.append(runs, len(order)))
    least = np.repeat(so[runs], size)
    local = np.sort(at[order[so > least]])
    stay = order[so == least]  # all places of the smallest document go on
    rows = []
    for b, which in _dealt(h0[stay], at[stay], buckets):
        pick = stay[which]
        code = np.empty((len(pick), _WINDOW_BYTES), np.uint8)
        code[:, :8] = h1[pick].astype("<u8").view(np.uint8).reshape(-1, 8)
        code[:, 8:] = h0[pick].astype("<u8").view(np.uint8).reshape(-1, 8)
        owners, cuts = owner[pick], np.flatnonzero(np.diff(owner[pick])) + 1
        starts = np.append(0, cuts)
        rows.append((b, chunk, PROBES, len(pick), code.tobytes() + _pack_places(at[pick]), owners[starts].tolist(),
                     np.diff(np.append(starts, len(pick))).tolist(), None, None, None, None))
    rows.append((_bucket_of(chunk, buckets), chunk, CHUNK, len(local), None, ids, words.per_text.tolist(), texts, _pack_places(local), None, None))
    return rows


def _meet_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of each chunk whose window starts in a smaller document of another chunk."""
    for group in _by_bucket(batches):
        out = [row for row in group if row[2] != PROBES]
        probes = [row for row in group if row[2] == PROBES]
        if len(probes) > 1:
            planes = np.frombuffer(b"".join(r[4][: _WINDOW_BYTES * r[3]] for r in probes), np.uint8).reshape(-1, _WINDOW_BYTES)
            h1 = planes[:, :8].copy().view("<u8").ravel()
            h0 = planes[:, 8:].copy().view("<u8").ravel()
            owner = np.concatenate([np.repeat(np.array(r[5], np.int64), r[6]) for r in probes])
            order = np.lexsort((owner, h0, h1))
            s0, s1, so = h0[order], h1[order], owner[order]
            runs = np.flatnonzero(np.append(True, (s0[1:] != s0[:-1]) | (s1[1:] != s1[:-1])))
            least = np.repeat(so[runs], np.diff(np.append(runs, len(order))))
            hit = np.zeros(len(order), bool)
            hit[order[so > least]] = True
            at = 0
            for r in probes:
                mine = hit[at : at + r[3]]
                at += r[3]
                if mine.any():
                    places = _unpack_places(r[4][_WINDOW_BYTES * r[3] :], r[3])[mine]
                    out.append((r[0], r[1], PROBES, len(places), _pack_places(places), *[None] * 6))
        if out:
            yield _rows(out)


_RESULT = "id long, n_words long, n_removed long, digest binary, spans array<long>"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the windows found from each document."""
    for head, places in _by_chunk(batches):
        counts = np.array(head[6], np.int64)
        first = np.cumsum(counts) - counts
        cover = np.zeros(int(counts.sum()) + 1, np.int64)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + WINDOW, -1)
        gone = np.cumsum(cover)[:-1] > 0
        removed, digests, cuts = [], [], []
        for k, text in enumerate(head[7]):
            mine = gone[first[k] : first[k] + counts[k]]
            kept = [w for w, g in zip(text.split(), mine.tolist()) if not g]
            removed.append(int(counts[k]) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).digest())
            cuts.append(np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8))).tolist())
        yield pa.RecordBatch.from_pydict({
            "id": pa.array(head[5], pa.int64()), "n_words": pa.array(counts), "n_removed": pa.array(removed, pa.int64()),
            "digest": pa.array(digests, pa.binary()), "spans": pa.array(cuts, pa.list_(pa.int64()))})


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """id, n_words, n_removed, digest (sha256 of the kept words) and spans (word ranges removed) of every row."""
    spark = df.sparkSession
    buckets = buckets or power_of_two(max(16, BUCKETS_PER_PARTITION * shuffle_partitions(spark)))
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    docs = docs.withColumn("id", F.coalesce("id", F.shiftrightunsigned("key", 2).bitwiseOR(F.lit(NO_ID))))

    anchors = docs.mapInArrow(_anchor_chunks(buckets), _SCHEMA).repartition("bucket").sortWithinPartitions("bucket")
    hits = stored(anchors.mapInArrow(_meet_anchors, _SCHEMA), "repeat-anchors")
    spans = _chunked(hits).mapInArrow(_spans, "id long, key long, spans array<long>")
    # Equal rows have equal spans: every stretch of theirs meets the other's.
    merged = spans.groupBy(F.col("id").alias("i"), F.col("key").alias("k")).agg(F.max("spans").alias("spans"))
    windows = (
        docs.join(merged, (F.col("id") == F.col("i")) & (F.col("key") == F.col("k")), "left").select("id", "text", "spans")
        .mapInArrow(_window_chunks(buckets), _SCHEMA).repartition("bucket").sortWithinPartitions("bucket")
    )
    found = stored(windows.mapInArrow(_meet_windows, _SCHEMA), "repeat-windows")
    cut = _chunked(found.filter(F.col("kind") != DONE)).mapInArrow(_remove, _RESULT)
    done = found.filter(F.col("kind") == DONE).select(F.explode(F.arrays_zip("ids", "counts", "digests")).alias("d")).select(
        F.col("d.ids").alias("id"), F.col("d.counts").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.col("d.digests").alias("digest"), F.array().cast("array<long>").alias("spans"))
    return cut.unionByName(done).withColumn("id", F.when(F.col("id") < NO_ID, F.col("id")))


@query("op9_substring_dedup")
def op9_substring_dedup(spark, sf_dir):
    """Every document with its repeated passages cut."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.lower(F.hex("digest")).alias("kept_sha256"))
