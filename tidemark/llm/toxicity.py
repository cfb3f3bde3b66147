"""Toxicity by a weighted lexicon.

Text is folded first: compatibility forms, marks and zero-width characters go, then lower
case, homoglyphs of Latin letters, digits and signs that stand for letters; ``1``, ``l``, ``i`` and ``|``
are one letter.  All other signs cut words, and what holds a bar is read both with and without
it as a letter.  The lexicon is folded likewise.  An Aho-Corasick automaton finds the lexicon's
entries: whole words, and word beginnings (an entry with ``*``).  Hits
that an exception phrase covers don't count.  The rest are summed by
weight, normalised by the length of the text, and a logistic curve gives a score
from 0 to 1.

Lexicon, weights and curve are learned from labelled rows: at most
``SAMPLE_ROWS`` of each label, taken by a hash of their id.  An entry's weight is
a cautious log ratio of the shares of toxic and of clean texts that hold it: what is left after
``CAUTION`` standard errors, so an entry that few texts hold weighs little.  The curve
weighs each sampled row by the rows of its label that it stands for, so its scores follow the label
mix of all labelled rows and not the sample's.

A text takes time and memory in proportion to its length.  Tables without rows give no rows; columns besides
text and id are not read.  Null and empty texts have no hits and take the curve's lowest score.  Labels of rows without a
text, and null labels, are not used.  Without toxic or clean rows to learn from, the
lexicon is empty and every score is 0.
"""

from __future__ import annotations

import json
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, query, stored, table

#: Labelled rows of each label that are learned from, at most.
SAMPLE_ROWS = 6000
#: Entries of the lexicon, at most.
MAX_ENTRIES = 150
#: Toxic texts that must hold an entry, at least, as a share of the sample, and as a number.
MIN_SHARE, MIN_TEXTS = 0.005, 5
#: Weight from which on an entry is used, and the standard errors taken off it.
MIN_WEIGHT, CAUTION = 1.5, 1.64
PREFIXES = range(4, 9)
#: Phrases in which an entry is harmless.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "sore loser wins")

# Characters that are written for Latin letters.
_LOOKS = {
    "0": "o", "1": "i", "l": "i", "|": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
    "\N{CYRILLIC SMALL LETTER A}": "a", "\N{CYRILLIC SMALL LETTER IE}": "e", "\N{CYRILLIC SMALL LETTER O}": "o",
    "\N{CYRILLIC SMALL LETTER ER}": "p", "\N{CYRILLIC SMALL LETTER ES}": "c", "\N{CYRILLIC SMALL LETTER U}": "y",
    "\N{CYRILLIC SMALL LETTER HA}": "x", "\N{CYRILLIC SMALL LETTER BYELORUSSIAN-UKRAINIAN I}": "i",
    "\N{CYRILLIC SMALL LETTER DZE}": "s", "\N{CYRILLIC SMALL LETTER JE}": "j",
    "\N{CYRILLIC SMALL LETTER KA}": "k", "\N{CYRILLIC SMALL LETTER EM}": "m", "\N{CYRILLIC SMALL LETTER TE}": "t",
    "\N{CYRILLIC SMALL LETTER EN}": "h", "\N{CYRILLIC SMALL LETTER VE}": "b", "\N{CYRILLIC SMALL LETTER PALOCHKA}": "i",
    "\N{GREEK SMALL LETTER KAPPA}": "k", "\N{GREEK SMALL LETTER TAU}": "t", "\N{GREEK SMALL LETTER UPSILON}": "u",
    "\N{LATIN SMALL LETTER DOTLESS I}": "i", "\N{GREEK SMALL LETTER ALPHA}": "a", "\N{GREEK SMALL LETTER EPSILON}": "e", "\N{GREEK SMALL LETTER IOTA}": "i",
    "\N{GREEK SMALL LETTER OMICRON}": "o", "\N{GREEK SMALL LETTER RHO}": "p", "\N{GREEK SMALL LETTER NU}": "v",
}

class _Fold(dict):
    """str.translate table: letters stay, looks become letters, marks and format characters go, all else becomes a space."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", chr(code)).lower())
        kept = [c for c in plain if unicodedata.category(c) not in ("Mn", "Mc", "Me", "Cf")]
        self[code] = out = "".join(_LOOKS.get(c) or (c if c.isalpha() else " ") for c in kept)
        return out


_FOLD = _Fold()


def _read_bars(word: str) -> str:
    apart = word.replace("|", " ")
    return f"{word} {apart}" if apart.strip() else ""


def fold(text: str) -> str:
    """Words of the folded text, one space between them and at both ends."""
    if "|" in text:
        text = " ".join([_read_bars(w) if "|" in w else w for w in text.split()])
    return " " + " ".join(text.translate(_FOLD).split()) + " "


def fold_entry(entry: str) -> str:
    """An entry of the lexicon as it stands in folded texts."""
    return fold(entry.removesuffix("*")).strip() + "*" * entry.endswith("*")


def features(folded: str) -> set[str]:
    """Words of a folded text, and their beginnings with a star."""
    out = set()
    for w in set(folded.split()):
        out.add(w)
        out.update(w[:n] + "*" for n in PREFIXES if n < len(w))
    return out


class Lexicon:
    """Finds weighted entries in texts; both are folded."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS, curve: tuple[float, float] = (0.0, 0.0)):
        self.weights: dict[str, float] = {}
        for entry, w in weights.items():  # of entries that fold to one, the largest weight
            folded = fold_entry(entry)
            self.weights[folded] = max(w, self.weights.get(folded, w))
        self.exceptions, self.curve = tuple(fold(x).strip() for x in exceptions), tuple(curve)
        self.find = ahocorasick.Automaton()
        for entry, w in self.weights.items():
            self.find.add_word(" " + entry[:-1] if entry.endswith("*") else f" {entry} ", (entry, w))
        for phrase in self.exceptions:
            known = self.find.get(f" {phrase} ", None)
            self.find.add_word(f" {phrase} ", (phrase, None) if known is None else known)
        if len(self.find):
            self.find.make_automaton()

    def raw(self, text: str) -> tuple[float, int]:
        """Summed weight of the words hit, and the number of words."""
        folded = fold(text)
        n = folded.count(" ") - 1 if folded.strip() else 0
        if not len(self.find) or not n:
            return 0.0, n
        hits: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        for end, (entry, w) in self.find.iter(folded):
            size = len(entry) if entry.endswith("*") else len(entry) + 2
            begin = end - size + 1  # the space in front of the first word
            if w is None:
                free.append((begin, end))
            else:
                hits[begin] = max(hits.get(begin, 0.0), w)
        total, covered, k = 0.0, -1, 0
        free.sort()
        for at in sorted(hits):  # hits and phrases walk along the text together
            while k < len(free) and free[k][0] <= at:
                covered, k = max(covered, free[k][1]), k + 1
            if at >= covered:
                total += hits[at]
        return total, n

    def signal(self, text: str) -> float:
        """Weight per hundred words, damped."""
        total, n = self.raw(text)
        return math.log1p(100.0 * total / max(n, 1))

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        a, b = self.curve
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, a * self.signal(text) + b))))

    def dump(self) -> str:
        return json.dumps([self.weights, self.exceptions, self.curve])

    @classmethod
    def load(cls, text: str) -> Lexicon:
        weights, exceptions, curve = json.loads(text)
        return cls(weights, tuple(exceptions), tuple(curve))


_COUNTS = "entry string, toxic long, clean long"


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that hold an entry, summed within the task."""
    seen: dict[bool, Counter] = {True: Counter(), False: Counter()}

    def flush() -> pa.RecordBatch:
        entries = list(seen[True].keys() | seen[False].keys())
        out = pa.RecordBatch.from_pydict({
            "entry": pa.array(entries, pa.string()), "toxic": pa.array([seen[True][e] for e in entries], pa.int64()),
            "clean": pa.array([seen[False][e] for e in entries], pa.int64())})
        seen[True].clear()
        seen[False].clear()
        return out

    for piece in pieces(batches):
        for text, toxic in zip(as_bytes(piece.column("text")), piece.column("toxic").to_pylist()):
            seen[bool(toxic)].update(features(fold(text.decode())))
            if len(seen[True]) + len(seen[False]) > 500_000:
                yield flush()
    if seen[True] or seen[False]:
        yield flush()


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                  sample: int = SAMPLE_ROWS) -> DataFrame:
    """text, toxic, stands_for of at most ``sample`` labelled rows of each label; held-out ids stay out.

    ``stands_for``: usable rows of the label by rows taken of it.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("lid"), F.col(label_col).cast("int").alias("toxic")).filter(
        "lid IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(F.col("lid")))
    usable = usable.groupBy("lid").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("lid"))
    sizes = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def taken(label: int) -> DataFrame:
        share = max(1.0, sizes.get(label, 0) / sample)
        return usable.filter(F.col("toxic") == label).orderBy("h", "lid").limit(sample).withColumn("stands_for", F.lit(share))

    chosen = taken(1).unionByName(taken(0))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    # At most 2 * sample ids of a few bytes each.
    return stored(texts.join(F.broadcast(stored(chosen, "toxic-sample")), F.col("id") == F.col("lid")).select("text", "toxic", "stands_for"), "toxic-training")


def held_out(id_):
    return F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(5)) == 0


def learn(rows: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Lexicon and curve from (text, toxic, stands_for) rows."""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, exceptions)
    spread = rows.repartition(max(1, min(200, (n_toxic + n_clean) // 200)))
    counts = spread.mapInArrow(_count_features, _COUNTS).groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = F.log(((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1)))
    weight = ratio - CAUTION * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    least = max(MIN_TEXTS, math.ceil(MIN_SHARE * n_toxic))
    best = counts.withColumn("w", weight).filter((F.col("toxic") >= least) & (F.col("w") >= MIN_WEIGHT)).orderBy(F.desc("w"), "entry").limit(MAX_ENTRIES)
    lexicon = Lexicon({r["entry"]: r["w"] for r in best.collect()}, exceptions)
    wire = lexicon.dump()

    def signals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Lexicon.load(wire)
        for piece in pieces(batches):
            yield pa.RecordBatch.from_pydict({
                "x": pa.array([mine.signal(t.decode()) for t in as_bytes(piece.column("text"))], pa.float64()), "toxic": piece.column("toxic"),
                "stands_for": piece.column("stands_for")})

    points = np.array([tuple(r) for r in spread.mapInArrow(signals, "x double, toxic int, stands_for double").collect()])
    return Lexicon(lexicon.weights, exceptions, _fit_curve(*points.T))


def _fit_curve(x: np.ndarray, y: np.ndarray, stands_for: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset by Newton steps over rows weighed by ``stands_for``, with a slight pull to 0."""
    weight = stands_for / stands_for.sum()
    design, beta, pull = np.stack([x, np.ones_like(x)], 1), np.zeros(2), np.diag([1e-4, 1e-6])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + pull @ beta
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + pull, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def scorer(lexicon: Lexicon):
    """Column function: text to score."""
    wire = lexicon.dump()
    held: dict[str, Lexicon] = {}

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        if wire not in held:
            held[wire] = Lexicon.load(wire)
        return pa.array([held[wire].score(t.decode()) for t in as_bytes(text)], pa.float64())

    return score


def learned_scorer(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    return scorer(learn(training_rows(docs, labels, id_col, text_col)))


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    """Score of every document; those with a crc32 remainder of 0 are not learned from."""
    docs = table(spark, sf_dir, "documents")
    score = learned_scorer(docs, table(spark, sf_dir, "labels"))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
