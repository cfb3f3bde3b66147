"""SentencePiece encoding and decoding in batches of words.

The model is a public BPE model with byte fallback.  A plain Viterbi pass over piece
scores finds the best-scored split, which for a BPE model is not the split that its
merges give.  The pass here keeps the method and gives the merges' result: a piece sequence is the
model's own encoding exactly if each two neighbouring pieces are, so a step into
place e may use a piece only behind a last piece that it may follow.  For each end
one candidate is left; the maximum over candidates by score stores its backpointer.

Texts are cut between any two neighbouring characters that no piece has side by side, since
no merge joins what stands on both sides; a mark behind another character is always such a place.  All texts of a batch are
cut at once, at first only where one byte tells a character; long words are cut further.  Distinct words of a batch are grouped by
length and advance together, a character at a time: hashes of all substrings that end there
are looked up in the sorted hashes of the pieces; the pieces found must spell the word.  Whether a piece may follow
another is found by taking back their merges, for all open pairs together.

Encoding follows the model's settings: white space becomes the mark, a mark is put in front, other characters
without a piece become their bytes.  Null and empty texts have no ids.  Texts are encoded whole; empty tables give
empty results and other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, query, table

MARK = chr(0x2581)
_MARK = MARK.encode()
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Distinct words that advance together.
BATCH_WORDS = 1 << 13
#: Bytes that the encoded words kept in a worker may take, and the bytes of a word from which on it is cut and not kept.
CACHE_BYTES, LONG = 64 << 20, 48
#: Bytes of texts that are cut at once.
PIECE_BYTES = 1 << 20
#: What a kept word takes besides its characters and ids.
_KEPT_OVERHEAD = 220
#: Slots of the table of neighbouring pieces.
PAIRS = 1 << 21


def _roll(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of strings after one more character."""
    h = (hashes ^ codes.astype(np.uint64)) * _MIX
    return h ^ (h >> np.uint64(31))


class Pieces:
    """The pieces of a model and the words they encode."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.byte_id = {int(self.text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.unk = model.unk_id()
        self.bytes = [b"" if model.is_control(i) else bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace(MARK, " ").encode() for i, t in enumerate(self.text)]
        self.n = n
        self.score = np.array([model.get_score(i) for i in range(n)])
        self.longest = max(len(self.text[i]) for i in normal)
        if any(MARK in self.text[i].lstrip(MARK) for i in normal):
            raise ValueError("a piece spans two words")
        by_text = {self.text[i]: i for i in normal}
        reachable = self._learn_merges(normal)
        hashes = np.array([self._hash(self.text[i]) for i in reachable], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.key_ids = hashes[order], np.array(reachable)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.codes = np.zeros((n, self.longest), np.uint32)
        self.sizes = np.zeros(n, np.int64)
        for i in reachable:
            self.sizes[i] = len(self.text[i])
            self.codes[i, : len(self.text[i])] = [ord(c) for c in self.text[i]]
        # Characters that stand side by side in a piece.
        self.joints = np.unique(np.array([ord(a) << 21 | ord(b) for i in normal for a, b in zip(self.text[i], self.text[i][1:])], np.int64))
        # Keys that begin with the same 20 bits stand behind one another, from ``first`` on.
        top = (self.keys >> np.uint64(44)).astype(np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[top] = True
        self.first = np.searchsorted(top, np.arange(1 << 20)).astype(np.int32)
        self.deepest = int(np.bincount(top, minlength=1).max(initial=0))
        self.borders = self._borders(set(by_text))
        self.pair_seen, self.pair_answer = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)
        self.spelt = pa.array(self.bytes, pa.large_binary())
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.kept = 0

    def _borders(self, texts: set[str]) -> np.ndarray:
        """Whether a word ends between two bytes, by first byte << 8 | second byte; marks are spaces."""
        borders = np.zeros((256, 256), bool)
        borders[:128, :128] = True
        left, right = self.joints >> 21, self.joints & ((1 << 21) - 1)
        left, right = (np.where(x == ord(MARK), 32, x) for x in (left, right))
        both = (left < 128) & (right < 128)
        borders[left[both], right[both]] = False
        # Beside a character of several bytes: no piece has a mark there, and characters without a piece never merge.
        borders[128:, 32] = True
        for c in range(128):
            if c != 32 and chr(c) not in texts:
                borders[128:, c] = borders[c, 128:] = True
        return borders.ravel()

    def _learn_merges(self, normal: list[int]) -> list[int]:
        """Which merges make each piece; the pieces that the model's own merges reach.

        A piece's last merge joins the only two shorter pieces that may stand side by
        side until then, so pieces are settled in order of length.
        """
        by_text = {self.text[i]: i for i in normal}
        place = {i: k for k, i in enumerate(sorted(normal, key=lambda i: -self.score[i]))}
        self.made_at = np.full(self.n, -1, np.int64)  # order of the merge that makes a piece; -1 for a character
        self.half = np.zeros((self.n, 2), np.int64)
        splits = sorted(
            (len(t), by_text[t[:c]], by_text[t[c:]], i)
            for t, i in by_text.items() for c in range(1, len(t)) if t[:c] in by_text and t[c:] in by_text)
        split = np.array(splits, np.int64).reshape(-1, 4)
        keys = split[:, 1] * self.n + split[:, 2]
        order = np.argsort(keys)
        self.pairs, self.pair_at = keys[order], np.array([place[i] for i in split[:, 3].tolist()], np.int64)[order]
        reached = {i for i in normal if len(self.text[i]) == 1}
        for length in np.unique(split[:, 0]).tolist():
            rows = split[split[:, 0] == length]
            known = np.array([a in reached and b in reached for _, a, b, _ in rows.tolist()], bool)
            rows = rows[known]
            rows = rows[self._undo(rows[:, 1], rows[:, 2], joined=True)]
            self.half[rows[:, 3]] = rows[:, 1:3]
            for i in rows[:, 3].tolist():
                self.made_at[i] = place[i]
                reached.add(i)
        return sorted(reached)

    def _undo(self, left: np.ndarray, right: np.ndarray, joined: bool = False) -> np.ndarray:
        """Whether merges leave ``left`` and ``right`` as they are, side by side.

        Takes back their merges, last one first, and asks each time whether the two
        pieces that then meet at the border would have merged before.  ``joined``
        skips the question for the two pieces themselves.
        """
        answer = np.ones(len(left), bool)
        row = np.arange(len(left))
        limit = np.full(len(left), np.iinfo(np.int64).max)
        first = joined
        while len(row):
            if not first:
                keys = left * self.n + right
                at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
                bad = (self.pairs[at] == keys) & (self.pair_at[at] < limit)
                answer[row[bad]] = False
                row, left, right = row[~bad], left[~bad], right[~bad]
            first = False
            a, b = self.made_at[left], self.made_at[right]
            on = np.maximum(a, b) >= 0
            row, left, right, a, b = row[on], left[on], right[on], a[on], b[on]
            # Of equal merges the leftmost is made first, so the right one is taken back first.
            from_left = a > b
            limit = np.where(from_left, a, b + 1)
            left, right = np.where(from_left, self.half[left, 1], left), np.where(from_left, right, self.half[right, 0])
        return answer

    @staticmethod
    def _hash(text: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in text:
            h = _roll(h, np.array([ord(c)]))
        return int(h[0])

    def may_follow(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece may stand behind each last piece; answers stay in a table of fixed size."""
        pairs = last * self.n + piece
        slot = (pairs.astype(np.uint64) * _MIX >> np.uint64(64 - PAIRS.bit_length() + 1)).astype(np.int64)
        new = np.flatnonzero(self.pair_seen[slot] != pairs)
        answers = self.pair_answer[slot]
        if len(new):
            ask, back = np.unique(pairs[new], return_inverse=True)
            found = self._undo(ask // self.n, ask % self.n)
            answers[new] = found[back]
            self.pair_seen[slot[new]], self.pair_answer[slot[new]] = pairs[new], answers[new]
        return answers

    def _advance(self, codes: np.ndarray, compare: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Piece that ends at each place (-1 none, -2 a character without a piece) and where it starts.

        With ``compare`` the characters of each hit are compared with the piece's.
        """
        n, length = codes.shape
        last = np.full((n, length + 1), -3, np.int64)
        back = np.zeros((n, length + 1), np.int64)
        # Hashes of the substrings that start at each place, grown by a character a step.
        open_ = np.zeros((n, 0), np.uint64)
        for end in range(1, length + 1):
            open_ = _roll(np.concatenate([open_, np.zeros((n, 1), np.uint64)], axis=1)[:, -self.longest :], codes[:, end - 1 : end])
            begin = end - open_.shape[1]
            row, col = np.nonzero(self.maybe[open_ >> np.uint64(44)])
            wanted = open_[row, col]
            at = self.first[wanted >> np.uint64(44)]
            for _ in range(self.deepest - 1):
                at = at + (self.keys[at] < wanted)
                at = np.minimum(at, len(self.keys) - 1)
            hit = self.keys[at] == wanted
            row, col, cand = row[hit], col[hit], self.key_ids[at[hit]]
            start = begin + col
            if compare:
                same = self.sizes[cand] == end - start
                for back_by in range(1, int((end - start).max(initial=0)) + 1):
                    same &= (back_by > end - start) | (codes[row, end - back_by] == self.codes[cand, np.maximum(self.sizes[cand] - back_by, 0)])
                row, col, cand, start = row[same], col[same], cand[same], start[same]
            single = np.ones(n, bool)
            single[row[col == open_.shape[1] - 1]] = False
            before = last[row, start]
            ok = before != -1
            check = before >= 0
            ok[check] = self.may_follow(before[check], cand[check])
            row, start, cand = row[ok], start[ok], cand[ok]
            best = np.full(n, -np.inf)
            np.maximum.at(best, row, self.score[cand])
            top = self.score[cand] == best[row]
            last[:, end] = -1
            last[row[top], end], back[row[top], end] = cand[top], start[top]
            found = best > -np.inf
            alone = single & ~found & (last[:, end - 1] != -1)  # merges never join a character without a piece
            last[alone, end], back[alone, end] = -2, end - 1
        return last, back

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word; the words are distinct.

        Pieces that spell the word and may follow one another are its encoding, however
        they were found; a word that its pieces do not spell met a false hash and is done again by characters.
        """
        out = self._encode_words(words)
        wanted = [w.encode("utf-8", "surrogatepass") for w in words]
        spelt, places = self.spell(np.frombuffer(b"".join(out), np.int32))
        ends = places[np.cumsum(list(map(len, out)), dtype=np.int64) // 4]
        if spelt == b"".join(wanted) and np.array_equal(ends, np.cumsum(list(map(len, wanted)))):
            return out
        begins = [0, *ends[:-1].tolist()]
        wrong = [k for k, (w, a, b) in enumerate(zip(wanted, begins, ends.tolist())) if spelt[a:b] != w]
        for k, ids in zip(wrong, self._encode_words([words[k] for k in wrong], compare=True)):
            out[k] = ids
        return out

    def spell(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes that ids stand for, one behind the other, and where those of each id begin, with the end."""
        if not len(ids):
            return b"", np.zeros(1, np.int64)
        _, places, spelt = self.spelt.take(pa.array(ids)).buffers()
        places = np.frombuffer(places, np.int64)[: len(ids) + 1]
        return spelt.to_pybytes()[: places[-1]], places

    def _encode_words(self, words: list[str], compare: bool = False) -> list[bytes]:
        out: list[bytes] = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w), []).append(k)
        for length, group in by_length.items():
            step = max(1, min(BATCH_WORDS, (1 << 21) // max(1, length)))
            for at in range(0, len(group), step):
                some = group[at : at + step]
                codes = np.frombuffer("".join([words[k] for k in some]).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(some), length)
                codes = np.where(codes == 32, ord(MARK), codes)
                last, back = self._advance(codes, compare)
                self._trace(codes, last, back, some, out)
        return out

    def _trace(self, codes, last, back, some, out) -> None:
        """Follow all backpointers together, then put each word's ids in order."""
        n, length = codes.shape
        row, place = np.arange(n), np.full(n, length)
        rows, ids, depth = [], [], 0
        depths = []
        while len(row):
            rows.append(row)
            ids.append(last[row, place])
            depths.append(np.full(len(row), depth))
            place = back[row, place]
            row, place = row[place > 0], place[place > 0]
            depth += 1
        rows, ids, depths = np.concatenate(rows), np.concatenate(ids), np.concatenate(depths)
        order = np.lexsort((-depths, rows))
        rows, ids = rows[order], ids[order]
        cuts = np.searchsorted(rows, np.arange(n + 1))
        plain = np.ones(n, bool)
        plain[rows[ids == -2]] = False
        packed, cuts = ids.astype(np.int32).tobytes(), cuts.tolist()
        for i, k in enumerate(some):
            if plain[i]:
                out[k] = packed[4 * cuts[i] : 4 * cuts[i + 1]]
            else:
                out[k] = self._with_bytes(codes[i], back[i], ids[cuts[i] : cuts[i + 1]])

    def _with_bytes(self, codes, back, ids) -> bytes:
        ends, place = [], len(codes)
        while place > 0:
            ends.append(place)
            place = back[place]
        out: list[int] = []
        for end, i in zip(reversed(ends), ids.tolist()):
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.byte_id.get(b, self.unk) for b in chr(codes[end - 1]).encode())
        return np.array(out, np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, ends = self.encode_utf8([t.encode("utf-8", "surrogatepass") for t in texts])
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode_utf8(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and where those of each text begin, with the end."""
        joined = b" ".join([b"", *texts]) if all(texts) else b"".join([b" " + t if t else t for t in texts])
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        if _MARK in joined:
            # Words keep spaces for marks until their characters are looked up.
            sizes -= (len(_MARK) - 1) * np.array([t.count(_MARK) for t in texts], np.int64)
            joined = joined.replace(_MARK, b" ")
        ends = np.append(0, np.cumsum(sizes))
        if not joined:
            return np.empty(0, np.int32), ends
        data = np.frombuffer(joined, np.uint8)
        cut = np.append(True, self.borders[data[:-1].astype(np.uint16) << 8 | data[1:]])
        cut[ends[:-1][sizes > 0]] = True
        at = np.append(np.flatnonzero(cut), len(joined))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(joined)]).dictionary_encode()
        coded = self._look_up(words.dictionary.to_pylist())
        _, places, ids = pa.array(coded, pa.large_binary()).take(words.indices).buffers()
        places = np.frombuffer(places, np.int64)[: len(at)] // 4
        return np.frombuffer(ids, np.int32, places[-1]), places[np.searchsorted(at, ends)]

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of distinct words; short ones are kept from now on."""
        out = list(map(self.recent.get, words))
        missing = [i for i, ids in enumerate(out) if ids is None]
        apart = {i: [w.encode("utf-8", "surrogatepass") for w in self.apart(words[i].decode("utf-8", "surrogatepass"))] for i in missing if len(words[i]) > LONG}
        wanted = [words[i] for i in missing if i not in apart]
        if apart:
            wanted = list({*wanted, *(w for some in apart.values() for w in some)} - self.recent.keys())
        coded = list(map(self.older.get, wanted))
        new = [k for k, ids in enumerate(coded) if ids is None]
        for k, ids in zip(new, self.encode_words([wanted[k].decode("utf-8", "surrogatepass") for k in new])):
            coded[k] = ids
        fresh = dict(zip(wanted, coded))
        for i in missing:
            if i not in apart:
                out[i] = fresh[words[i]]
            else:
                out[i] = b"".join([fresh[w] if w in fresh else self.recent[w] for w in apart[i]])
        keep = [(w, ids) for w, ids in fresh.items() if len(w) <= LONG] if max(map(len, wanted), default=0) > LONG else fresh.items()
        self.recent.update(keep)
        self.kept += sum([2 * len(w) + len(ids) for w, ids in keep]) + _KEPT_OVERHEAD * len(keep)
        # Two generations: a word that is used again moves to the recent ones before its generation goes.
        if self.kept > CACHE_BYTES // 2:
            self.recent, self.older, self.kept = {}, self.recent, 0
        return out

    def apart(self, word: str) -> list[str]:
        """A word cut where no piece joins."""
        codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        codes = np.where(codes == 32, ord(MARK), codes)
        pairs = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.joints, pairs), len(self.joints) - 1)
        ends = [0, *(np.flatnonzero(self.joints[at] != pairs) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(ends, ends[1:])]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_utf8(ids, np.array([0, len(ids)]))[0].decode("utf-8", "replace")

    def decode_utf8(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Bytes of the texts whose ids begin at the given places, without the mark that was put in front."""
        spelt, places = self.spell(ids)
        places = places[ends].tolist()
        return [spelt[a + (spelt[a : a + 1] == b" " and a < b) : b] for a, b in zip(places, places[1:])]


_MODELS: dict[str, Pieces] = {}


def _model(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def encoder(path: str):
    """Column function: text to array of ids."""

    @F.arrow_udf("array<int>")
    def ids_of(text: pa.Array) -> pa.Array:
        model = _model(path)
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        chunks = []
        for piece in pieces([batch], most_bytes=PIECE_BYTES):
            ids, ends = model.encode_utf8(as_bytes(piece.column("text")))
            chunks.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)))
        pa.default_memory_pool().release_unused()  # what the cut took goes back before the next stage runs beside it
        return pa.concat_arrays(chunks) if chunks else pa.array([], pa.list_(pa.int32()))

    return ids_of


def decoder(path: str):
    """Column function: array of ids to text; null gives an empty text."""

    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        model = _model(path)
        flat, offsets = ids.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum([0 if x is None else x for x in ids.value_lengths().to_pylist()]))
        return pa.array([t.decode("utf-8", "replace") for t in model.decode_utf8(flat, offsets)], pa.string())

    return text_of


def encode(df: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of its texts in column ``out``, which replaces one of that name."""
    return df.withColumn(out, encoder(path)(F.col(text_col)))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    return df.withColumn(out, decoder(path)(F.col(ids_col)))


_SUMMARY = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())])


def same_text(decoded: bytes, text: bytes) -> bool:
    """Whether decoded bytes, with what is no UTF-8 replaced, are the text."""
    return decoded == text or decoded.decode("utf-8", "replace") == text.decode()


def _summaries(path: str):
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for piece in pieces(batches, most_bytes=PIECE_BYTES):
            texts = as_bytes(piece.column("text"))
            ids, ends = model.encode_utf8(texts)
            packed, places = memoryview(ids.astype("<u4", copy=False)).cast("B"), (4 * ends).tolist()
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array(np.diff(ends), pa.int64()),
                pa.array([zlib.crc32(packed[a:b]) for a, b in zip(places, places[1:])], pa.int64()),
                pa.array([same_text(x, t) for x, t in zip(model.decode_utf8(ids, ends), texts)], pa.bool_())], schema=_SUMMARY)

    return run


@query("op5_sentence_pieces")
def op5_sentence_pieces(spark, sf_dir):
    """Ids of every document (as number and checksum) and whether they decode to its text."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_summaries(public_tokenizers.path("piece_bpe_32k.model")), "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
