"""Token-id files with Elias-Fano document boundaries.

A shard is a pair of files.  ``ids-<n>.bin`` holds the token ids of its documents
one after another, little-endian unsigned 16-bit, or 32-bit if the vocabulary
needs it.  ``ends-<n>.ef`` holds two monotone sequences in Elias-Fano code: the
end offset of each document in the id array, and the document ids.  Each value
is split into low bits, packed, and a high part, written in unary into a bit
vector; the place of every ``SAMPLE``-th one bit is sampled, so ``select(i)`` reads
a bounded stretch.  That takes about 2 + log2(n_ids / n_docs) bits a document and no
table of 64-bit offsets.

A text is encoded whole however long it is, and a document's ids stand in one shard, so a shard
is as large as its longest document at least.  Extra columns are not read, whatever their names; an empty table
writes no shard and reads back empty.

Documents stand in ascending order of their id; those that share an id stand next
to each other, in order of their text, and those without an id come last.  Null texts count as empty.
A written file is complete under its final name, so a repeated task replaces it
by an equal one.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, query, stored, table
from tidemark.session import shared_dir

MAGIC = b"TMEF0001"
#: One bits between two samples of a select structure.
SAMPLE = 256
END_ID = 2
#: Bytes that the words kept in a worker may take, with their ids, and the length from which on a word is not kept.
CACHE_BYTES, LONGEST_KEPT = 96 << 20, 64
#: What a kept word takes besides its characters and ids.
_KEPT_OVERHEAD = 200
#: New words that are encoded as one text.
TOGETHER = 64
#: Bytes of texts that are cut at once.
PIECE_BYTES = 4 << 20


class EliasFano:
    """A non-decreasing sequence of integers from 0 in near-minimal space."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n == 0:
            return cls(0, 0, np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, np.uint64))
        per = (int(values[-1]) + 1) // n
        width = max(0, per.bit_length() - 1)
        shifts = np.arange(width, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places.astype(np.int64)] = 1
        return cls(n, width, low, np.packbits(bits, bitorder="little"), places[::SAMPLE].copy())

    def select(self, index: np.ndarray) -> np.ndarray:
        """Values at the given places, without decoding the rest."""
        index = np.asarray(index, np.int64)
        out = np.empty(len(index), np.uint64)
        for block in np.unique(index // SAMPLE):
            here = np.flatnonzero(index // SAMPLE == block)
            first = int(self.samples[block])
            last = int(self.samples[block + 1]) if block + 1 < len(self.samples) else len(self.high) * 8
            ones = np.flatnonzero(np.unpackbits(self.high[first // 8 : last // 8 + 1], bitorder="little"))
            ones = ones[ones >= first % 8] + (first - first % 8)
            out[here] = ones[index[here] - block * SAMPLE].astype(np.uint64) - index[here].astype(np.uint64)
        if self.width:
            at = index[:, None] * self.width + np.arange(self.width)
            bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            out = (out << np.uint64(self.width)) | (bits.astype(np.uint64) << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out

    def dump(self) -> bytes:
        head = struct.pack("<QQQQQ", self.n, self.width, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u8").tobytes()

    @classmethod
    def load(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, width, n_low, n_high, n_samples = struct.unpack_from("<QQQQQ", data, at)
        at += 40
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(data, "<u8", n_samples, at + n_low + n_high)
        return cls(n, width, low, high, samples), at + n_low + n_high + 8 * n_samples


# A text is cut before each run of these four characters and between an ASCII letter or digit
# and ASCII punctuation.  The tokenizer's own word pattern has a boundary there too, so the
# words encode one by one; texts with any other white space are encoded whole.
_SPACE = b" \n\r\t"
_OTHER_SPACE = "".join(map(chr, (
    0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)))


def _kinds() -> np.ndarray:
    """1 for the bytes of ``_SPACE``, 2 for letters and digits, 3 for punctuation, 0 for others."""
    kinds = np.zeros(256, np.uint8)
    kinds[33:127] = [2 if chr(c).isalnum() else 3 for c in range(33, 127)]
    kinds[list(_SPACE)] = 1
    return kinds


_KIND = _kinds()
#: Whether a word starts at a byte of the second kind behind one of the first.
_STARTS = np.array([[False, True, False, False], [False] * 4, [False, True, False, True], [False, True, False, False]]).ravel()


class Encoder:
    """Ids of whole texts by a byte-level model of the tokenizers library; words that come again are looked up.

    With ``plain_special`` the strings of added tokens in a text are ordinary text; else
    they give their own ids, as the library has it by default.
    """

    def __init__(self, path: str, plain_special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_special
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # A byte-level token is written with one character per byte.
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())])
        added = [] if plain_special else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Texts that are encoded whole: with white space that the cut does not know, or an added token.
        self.whole = re.compile("|".join(["[" + _OTHER_SPACE + "]", *map(re.escape, added)]))
        # Only texts with one of these bytes can be such.
        self.doubtful = np.zeros(256, bool)
        self.doubtful[[x.encode()[0] for x in [*_OTHER_SPACE, *added] if x]] = True
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.kept = 0

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that end without white space, many to a call.

        One behind the other they have a boundary at each joint, where a word without white space
        in front gets a line feed, an id of its own; how many bytes each id stands for tells the words apart again.
        """
        out: list[bytes] = []
        size = self.dtype.itemsize
        groups = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        bare = [[w[0] not in _SPACE for w in g] for g in groups]
        joined = [b"".join([b"\n" + w if b else w for w, b in zip(g, of)]).decode() for g, of in zip(groups, bare)]
        for group, of, e in zip(groups, bare, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            front = np.array(of)
            ends = np.cumsum(np.array(list(map(len, group))) + front)
            cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            begins = np.append(0, cuts[:-1]) + front
            packed = ids.tobytes()
            out += [packed[a:b] for a, b in zip((begins * size).tolist(), (cuts * size).tolist())]
        return out

    def _look_up(self, wanted: list[bytes]) -> list[bytes]:
        """Ids of distinct words that are not among the recent ones; they are kept from now on."""
        found = list(map(self.older.get, wanted))
        new = [i for i, ids in enumerate(found) if ids is None]
        inner = [i for i in new if wanted[i][-1] not in _SPACE]
        outer = [i for i in new if wanted[i][-1] in _SPACE]
        for which, ids in ((inner, self._word_ids([wanted[i] for i in inner])), (outer, self._ids([wanted[i].decode() for i in outer]))):
            for i, x in zip(which, ids):
                found[i] = x
        keep = [(w, ids) for w, ids in zip(wanted, found) if len(w) <= LONGEST_KEPT]
        self.recent.update(keep)
        self.kept += sum([len(w) + len(ids) for w, ids in keep]) + _KEPT_OVERHEAD * len(keep)
        # Two generations: a word that is used again moves to the recent ones before its generation goes.
        if self.kept > CACHE_BYTES // 2:
            self.recent, self.older, self.kept = {}, self.recent, 0
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        return self.encode_utf8([t.encode() for t in texts])

    def encode_utf8(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text.

        All texts are cut at once and each distinct word of theirs is looked up once.
        """
        ends = np.cumsum(list(map(len, texts)), dtype=np.int64)
        joined = b"".join(texts)
        doubt = np.flatnonzero(self.doubtful[np.frombuffer(joined, np.uint8)])
        doubt = np.unique(np.searchsorted(ends, doubt, side="right")).tolist()
        whole = [i for i in doubt if self.whole.search(texts[i].decode())]
        if whole:
            cut = list(texts)
            for i in whole:
                cut[i] = b""
            ends = np.cumsum(list(map(len, cut)), dtype=np.int64)
            joined = b"".join(cut)
        begins = np.append(0, ends[:-1])
        if joined:
            kinds = _KIND[np.frombuffer(joined, np.uint8)]
            starts = np.append(False, _STARTS[kinds[:-1] << 2 | kinds[1:]])
            starts[begins[begins < ends]] = True
            at = np.append(np.flatnonzero(starts), len(joined))
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(joined)]).dictionary_encode()
            distinct = words.dictionary.to_pylist()
            parts = list(map(self.recent.get, distinct))
            missing = [i for i, p in enumerate(parts) if p is None]
            for i, ids in zip(missing, self._look_up([distinct[i] for i in missing])):
                parts[i] = ids
            packed = pa.array(parts, pa.large_binary()).take(words.indices)
            _, places, ids = packed.buffers()
            places, ids = np.frombuffer(places, np.int64), memoryview(ids)
            first, last = places[np.searchsorted(at, begins)].tolist(), places[np.searchsorted(at, ends)].tolist()
            out = [bytes(ids[a:b]) for a, b in zip(first, last)]
        else:
            out = [b""] * len(texts)
        for i, ids in zip(whole, self._ids([texts[i].decode() for i in whole])):
            out[i] = ids
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _store_file(root: str, name: str, parts: list[bytes]) -> None:
    fs, path = pafs.FileSystem.from_uri(root)
    fs.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    fs.move(draft, f"{path}/{name}")


def _read_file(root: str, name: str) -> bytes:
    fs, path = pafs.FileSystem.from_uri(root)
    with fs.open_input_stream(f"{path}/{name}") as f:
        return f.read()


#: Ids above all others stand for rows without one.
NO_ID = (1 << 63) - 1
#: Bytes of ids after which a partition starts its next shard.
SHARD_BYTES = 32 << 20


def _write_shards(root: str, tokenizer: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encoder = _encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], encoder.dtype).tobytes()
        ids: list[bytes] = []
        docs: list[int] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal seq, size
            name = f"{part:06d}-{seq:04d}"
            item = encoder.dtype.itemsize
            ends = np.cumsum([len(x) // item for x in ids])
            base = min(docs)
            _store_file(root, f"ids-{name}.bin", ids)
            codes = EliasFano.encode(ends), EliasFano.encode(np.array([d - base for d in docs], np.uint64))
            _store_file(root, f"ends-{name}.ef", [MAGIC + struct.pack("<qq", item, base), *(c.dump() for c in codes)])
            out = pa.RecordBatch.from_pydict({"shard": pa.array([name]), "place": pa.array([part << 24 | seq], pa.int64()),
                                              "n_docs": pa.array([len(docs)], pa.int64()), "n_ids": pa.array([int(ends[-1])], pa.int64())})
            seq, size = seq + 1, 0
            ids.clear()
            docs.clear()
            return out

        for batch in batches:
            for piece in pieces([batch], most_bytes=PIECE_BYTES):
                for doc, packed in zip(piece.column("id").to_pylist(), encoder.encode_utf8(as_bytes(piece.column("text")))):
                    ids.append(packed + end)
                    docs.append(doc)
                    size += len(ids[-1])
                    if size >= SHARD_BYTES:
                        yield shard()
        if docs:
            yield shard()

    return run


def write_tokens(df: DataFrame, root: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = None) -> DataFrame:
    """Write the ids of ``df``'s texts under ``root`` in id order; return the stored table of shards."""
    keys = ["id", "tie"]
    ordered = (
        df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*keys).sortWithinPartitions(*keys, "text").select("id", "text")
    )
    shards = ordered.mapInArrow(_write_shards(root, tokenizer, end_id), "shard string, place long, n_docs long, n_ids long")
    return stored(shards, "token-shards")


def _read_shards(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist()):
                meta = _read_file(root, f"ends-{name}.ef")
                if meta[:8] != MAGIC:
                    raise ValueError(f"not a boundary file: ends-{name}.ef")
                item, base = struct.unpack_from("<qq", meta, 8)
                ends, at = EliasFano.load(meta, 24)
                docs, _ = EliasFano.load(meta, at)
                ids = np.frombuffer(_read_file(root, f"ids-{name}.bin"), f"<u{item}")
                for lo in range(0, ends.n, 4096):
                    which = np.arange(lo, min(ends.n, lo + 4096))
                    stop = ends.select(which).astype(np.int64)
                    begin = np.append(ends.select([lo - 1]).astype(np.int64) if lo else 0, stop[:-1])
                    doc = docs.select(which).astype(np.int64) + base
                    yield pa.RecordBatch.from_pydict({
                        "id": pa.array(doc, mask=doc == NO_ID),
                        "start": pa.array(begin + start),
                        "ids": pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(begin, stop)], pa.binary())})

    return run


def read_tokens(spark: SparkSession, root: str, shards: DataFrame) -> DataFrame:
    """id, start and ids (little-endian unsigned 32-bit) of every document, from the files.

    Offsets come from a running sum over groups of shards, so no task holds all shards.
    """
    group = F.shiftrightunsigned("place", 24 + 10)
    sums = shards.groupBy(group.alias("g")).agg(F.sum("n_ids").alias("in_group"))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("g", F.coalesce(F.sum("in_group").over(before), F.lit(0)).alias("group_start"))
    within = Window.partitionBy("g").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        shards.withColumn("g", group).join(sums, "g")
        .select("shard", "place", (F.col("group_start") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("start"))
    )
    starts = stored(starts, "token-starts")
    # As many tasks as shards: a number that is given is not joined up again at run time.
    starts = starts.repartition(max(1, starts.count()), "place")
    return starts.select("shard", "start").mapInArrow(_read_shards(root), "id long, start long, ids binary")


@query("op3_elias_fano_tokens")
def op3_elias_fano_tokens(spark, sf_dir):
    """Write all documents' ids, read the files back, report offsets and checksums."""
    import public_tokenizers

    root = shared_dir(spark, "tokens")
    root = root if "://" in root else f"file://{root}"
    path = public_tokenizers.path("byte_bpe_50k.json")
    shards = write_tokens(table(spark, sf_dir, "documents"), root, path, end_id=END_ID)
    return read_tokens(spark, root, shards).select(
        F.col("id").alias("doc_id"), "start", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
