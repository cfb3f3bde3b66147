"""Ranked lexical search by the Best Position Algorithm.

Terms are the maximal runs of ASCII digits, ASCII letters (A-Z lower-cased) and characters
beyond ASCII.  With N documents that hold a term, L terms in them, n terms in one document,
df documents that hold a term and tf places of it in a document, a term weighs
w = floor(1000 * ln((2N + 2) / (2df + 1))), a document has m = 100 - B + (B * n * N) div L
with B = 90, and a term adds w * ((10^9 * tf) div (1000 * tf + 8 * m)) to its score: whole
numbers, so scores don't depend on the order of addition.

One pass counts the terms that some query holds; N, L and df are sums over all documents.
A second pass cuts every partition of documents into shards of ``SHARD_DOCS``.  A shard holds
an impact list for each term, largest impact first, and answers every query by itself: it
reads the query's lists in step (sorted access); each document met is looked up in all the other
lists (direct access), which gives its whole score and its positions there.  The best
position of a list is the last one before which all have been seen in either way, so impacts there
bound what an unseen document may still reach.  A query stops when the sum of these bounds
is strictly below its k-th score, so ties are complete.  A term that all documents hold is dealt over
all shards; no shuffle moves postings.  The shards' k best meet in a merge of k rows a (query, shard).

Queries are taken in groups of about ``GROUP_TERMS`` distinct terms, each group in passes of its own,
so what a task holds of the queries is bounded however many there are.

Null texts have no term.  Null ids count as largest in ties; rows that share an id are ranked each
by itself.  Queries without a term and queries whose terms no document holds give no row, as do empty
tables.  A text is tokenised whole; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, query, stored, table

K = 10
SHARD_DOCS = 8192
GROUP_TERMS = 1 << 18
#: Positions that each list gives at first; later rounds read twice as many.
FIRST_READ = 32
NO_ID = (1 << 63) - 1
B = 90

# Bytes of a term stay, A-Z as a-z; all others become blanks.  In UTF-8 a byte from 0x80 belongs to a character beyond ASCII.
_TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(0x80)) + bytes(range(0x80, 0x100))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _count_terms(known: dict[bytes, int]):
    """Per document its terms and, of those that queries hold, number and places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            n, terms, places = [], [], []
            for text in as_bytes(piece.column("text")):
                words = terms_of(text)
                n.append(len(words))
                found, counts = np.unique(np.array([i for i in map(known.get, words) if i is not None], np.int32), return_counts=True)
                terms.append(found)
                places.append(counts.astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "id": piece.column("id"), "n": pa.array(n, pa.int64()), "terms": pa.array(terms, pa.list_(pa.int32())), "tf": pa.array(places, pa.list_(pa.int32()))})

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Impact lists of some documents: ``ids`` ascending, (doc, term, impact) with doc a place in ``ids``."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids = ids
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        # For direct access: postings by (term, doc) and where each stands in its impact list.
        by_doc = np.lexsort((doc[order], term[order]))
        self.key = term[order][by_doc].astype(np.int64) * len(ids) + self.doc[by_doc]
        self.place = by_doc - self.start[term[order][by_doc]]
        #: Postings read by sorted access, and those of all lists asked for.
        self.read = self.there = 0

    def _direct(self, docs: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Position of each document in each term's list, -1 where it is not (terms, docs)."""
        wanted = terms[:, None].astype(np.int64) * len(self.ids) + docs[None, :]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return np.where(self.key[at] == wanted, self.place[at], -1)

    def search(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best with a score above 0, best first, ties to the smaller place."""
        start, size = self.start[terms], self.start[terms + 1] - self.start[terms]
        terms, start, size = terms[size > 0], start[size > 0], size[size > 0]
        # Terms of weight 0 add nothing, and a list that begins with 0 is of such a term.
        live = self.impact[start] > 0
        terms, start, size = terms[live], start[live], size[live]
        self.there += int(size.sum())
        scores = np.full(len(self.ids), -1, np.int64)
        seen = [np.zeros(s + 1, bool) for s in size.tolist()]  # the place behind the last is never seen
        best = np.zeros(len(terms), np.int64)  # first position not seen
        at, step = 0, FIRST_READ
        while len(terms):
            met = np.unique(np.concatenate([self.doc[s + at : s + min(at + step, n)] for s, n in zip(start.tolist(), size.tolist())]))
            self.read += int(np.clip(size - at, 0, step).sum())
            met = met[scores[met] < 0]
            if len(met):
                position = self._direct(met, terms)
                there = position >= 0
                scores[met] = np.where(there, self.impact[np.where(there, start[:, None] + position, 0)], 0).sum(axis=0)
                for i in range(len(terms)):
                    seen[i][position[i][there[i]]] = True
                    best[i] += seen[i][best[i] :].argmin()
            at, step = at + step, step * 2
            bound = np.where(best < size, self.impact[start + np.minimum(np.maximum(best - 1, 0), size - 1)], 0).sum()
            if at >= size.max():
                break
            known = scores[scores > 0]
            if len(known) >= k and bound < np.partition(known, len(known) - k)[len(known) - k]:
                break
        found = np.flatnonzero(scores > 0)
        found = found[np.lexsort((found, -scores[found]))[:k]]
        return found, scores[found]


def _mean_part(n: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    if int(n.max(initial=0)) * n_docs * B < 1 << 63:
        return 100 - B + B * n * n_docs // n_all
    return np.array([100 - B + B * x * n_docs // n_all for x in n.tolist()], np.int64)


def _answer(queries: list[tuple[int, np.ndarray]], weights: np.ndarray, n_docs: int, n_all: int, k: int):
    def shard_rows(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        ids = t["id"].fill_null(NO_ID).to_numpy()
        lengths, term, tf = (x.combine_chunks() for x in (t["n"], t["terms"], t["tf"]))
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        per = np.diff(term.offsets.to_numpy())
        owner = np.repeat(np.arange(len(ids)), per)
        term, tf = term.flatten().to_numpy(), tf.flatten().to_numpy().astype(np.int64)
        m = _mean_part(lengths.to_numpy(), n_docs, n_all)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[owner]))
        shard = Shard(ids[order], rank[owner], term, impact, len(weights))
        out = [(q, *shard.search(terms, k)) for q, terms in queries]
        return pa.RecordBatch.from_pydict({
            "q": pa.array(np.repeat([q for q, _, _ in out], [len(f) for _, f, _ in out]), pa.int64()),
            "id": pa.array(shard.ids[np.concatenate([f for _, f, _ in out])], pa.int64()),
            "score": pa.array(np.concatenate([s for _, _, s in out]), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD_DOCS):
                some = batch.slice(at, SHARD_DOCS)
                if n and n + some.num_rows > SHARD_DOCS:
                    yield shard_rows(rows)
                    rows, n = [], 0
                rows.append(some)
                n += some.num_rows
        if n:
            yield shard_rows(rows)

    return run


def _group(spark: SparkSession, docs: DataFrame, asked: list, k: int) -> DataFrame:
    """q, id, score: the best of every shard for a group of queries (rows of q and text)."""
    terms = {r["q"]: {*terms_of((r["text"] or "").encode())} for r in asked}
    known = {t: i for i, t in enumerate(sorted(set().union(*terms.values())))}
    counted = stored(docs.mapInArrow(_count_terms(known), "id long, n long, terms array<int>, tf array<int>"), "lexical-terms")
    total = counted.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(len(known), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row a term of this group
        df[r["t"]] = r["count"]
    weights = np.array([weight(total["docs"], d) if d else 0 for d in df.tolist()], np.int64)
    queries = [(q, np.array(sorted(known[t] for t in ts), np.int64)) for q, ts in terms.items() if ts]
    if not queries or not total["docs"]:
        return spark.createDataFrame([], "q long, id long, score long")
    found = counted.filter(F.size("terms") > 0).mapInArrow(_answer(queries, weights, total["docs"], total["terms"], k), "q long, id long, score long")
    return stored(found, "lexical-found")


def search(items: DataFrame, df: DataFrame, k: int = K, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """item, rank (from 1), id, score: the ``k`` best rows of ``df`` for every row of ``items``."""
    spark = df.sparkSession
    asked = stored(items.select(F.monotonically_increasing_id().alias("q"), F.col(item_col).alias("item"), F.col(item_text).alias("text")), "lexical-items")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # A query has fewer terms than half its characters and one; the sum bounds the terms of all.
    groups = 1 + int((asked.agg(F.sum(F.length("text") + 1)).first()[0] or 0) // 2 // GROUP_TERMS)
    found = None
    for g in range(groups):
        mine = asked.filter(F.pmod(F.xxhash64("q"), F.lit(groups)) == g).select("q", "text").collect()
        one = _group(spark, docs, mine, k)
        found = one if found is None else found.unionByName(one)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    top = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return top.join(asked.select("q", "item"), "q").select("item", "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "score")


@query("op13_lexical_search", r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // whole.terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), whole
  GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10""")
def op13_lexical_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    found = search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
