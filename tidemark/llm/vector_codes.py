"""Vector code compression: integer product codes, nearest entries found by a GNAT.

A component x becomes the integer floor(256 * x).  Vectors are cut into ``parts`` equal
consecutive parts; each part position has a codebook, which starts as that part of the
``entries`` smallest ids (ascending, nulls last, equal ids by their components).  A round
assigns every part to its codebook's nearest entry by squared Euclidean distance, ties to
the lower index, and replaces each entry by its parts' componentwise floor(sum / count);
entries without parts stay.

The nearest entry comes from a geometric near-neighbour access tree over the codebook: a
node picks split points far from each other, every other entry goes to the child of its
nearest split point, and for each (split, child) the node keeps the least and greatest
distance from the split point to the child's entries.  A search measures a query against
the split points; a child is left out, with all that is below it, if some split point shows
that its entries are strictly farther than the best one so far.  Distances are compared as
doubles rounded away from a wrong exclusion; what is left is decided on exact integers, so
ties reach the lower index.

The tree is over codebook entries, whose number is a parameter; vectors stay in their
partitions, and a round sends one sum a (task, part, entry, position).

Rows whose vector is null, empty or holds null or non-finite components take no part, nor do
those with a component of magnitude ``LARGEST`` or more (an error would leave 64 bits), a
length that is no multiple of ``parts``, or another length than most of the rest.  Fewer rows
than ``entries`` give codebooks of as many entries; repeated rows count as often as they come;
empty tables give empty results; columns besides id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import query, stored, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = float(1 << 19)
#: Split points of a node, and entries up to which a node is a leaf.
DEGREE = 6
LEAF = 6
#: Vectors that are searched together.
TOGETHER = 4096


def squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row for each query."""
    out = np.zeros((len(queries), len(points)), np.int64)
    for q, p in zip(queries.T, points.T):
        gap = q[:, None] - p[None, :]
        out += gap * gap
    return out


def _below(square: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(square.astype(np.float64)), -1.0)


def _above(square: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(square.astype(np.float64)), np.inf)


class Gnat:
    """Nearest of a few integer points: rows of ``points`` named by ``index``."""

    def __init__(self, points: np.ndarray, index: np.ndarray | None = None):
        self.points = points
        self.index = np.arange(len(points)) if index is None else index
        self.children: list[Gnat | None] = []
        #: Distances that a search has measured.
        self.measured = 0
        if len(self.index) > LEAF:
            self._split()

    def _split(self) -> None:
        here = self.points[self.index]
        chosen = [0]
        nearest = squared(here, here[:1])[:, 0]
        while len(chosen) < DEGREE and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, squared(here, here[chosen[-1:]])[:, 0])
        if len(chosen) == 1:  # all entries are one point
            return
        gaps = squared(here, here[chosen])
        home = gaps.argmin(axis=1)
        home[chosen] = -1
        self.splits = self.index[chosen]
        self.low, self.high = np.empty((2, len(chosen), len(chosen)))
        for c in range(len(chosen)):
            own = np.flatnonzero(home == c)
            self.children.append(Gnat(self.points, self.index[own]) if len(own) else None)
            if len(own):
                self.low[:, c], self.high[:, c] = _below(gaps[own].min(axis=0)), _above(gaps[own].max(axis=0))

    def _measure(self, which: np.ndarray, queries: np.ndarray, at: np.ndarray, best: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Compare queries ``at`` with the entries ``which``."""
        gaps = squared(queries[at], self.points[which])
        self.measured += gaps.size
        order = np.argsort(which)  # argmin takes the first of equals
        first = order[gaps[:, order].argmin(axis=1)]
        gap, name = gaps[np.arange(len(at)), first], which[first]
        better = (gap < best[at]) | ((gap == best[at]) & (name < found[at]))
        best[at[better]], found[at[better]] = gap[better], name[better]
        return gaps

    def _descend(self, queries: np.ndarray, at: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
        if not self.children:
            self._measure(self.index, queries, at, best, found)
            return
        gaps = self._measure(self.splits, queries, at, best, found)
        near, far = _below(gaps), _above(gaps)
        home = gaps.argmin(axis=1)
        for own_turn in (True, False):  # a query's nearest child first: it shrinks the reach for the others
            for c, child in enumerate(self.children):
                if child is None:
                    continue
                some = np.flatnonzero((home == c) == own_turn)
                reach = _above(best[at[some]])[:, None]
                out = (near[some] - reach > self.high[:, c]) | (far[some] + reach < self.low[:, c])
                some = some[~out.any(axis=1)]
                if len(some):
                    child._descend(queries, at[some], best, found)
                    self.measured, child.measured = self.measured + child.measured, 0

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each query, ties to the lower entry."""
        best, found = np.full(len(queries), np.iinfo(np.int64).max), np.full(len(queries), len(self.points))
        self._descend(queries, np.arange(len(queries)), best, found)
        return found, best


def usable(df: DataFrame, parts: int = PARTS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """id, label, vec (integers) of the vectors that take part, stored."""
    vec = F.col(vector_col).cast("array<double>")
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), vec.alias("v")).filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(LARGEST))) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    # The product with a power of two is exact, so the floor goes down from the component itself.
    rows = stored(rows.select("id", "label", F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE))).cast("int")).alias("vec")), "code-vectors")
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the batches with their vectors cut into parts, the entries and the squared distances (vector, part)."""
    trees = [Gnat(b) for b in books]
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            some = batch.slice(at, TOGETHER)
            cut = _matrix(some.column("vec")).reshape(some.num_rows, len(books), -1)
            pairs = [t.nearest(cut[:, p]) for p, t in enumerate(trees)]
            yield some, cut, np.stack([e for e, _ in pairs], 1), np.stack([g for _, g in pairs], 1)


def _sums(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for _, cut, entries, _ in _assigned(batches, books):
            for p in range(len(books)):
                np.add.at(total[p], entries[:, p], cut[:, p])
                count[p] += np.bincount(entries[:, p], minlength=books.shape[1])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int64()), "entry": pa.array(entry, pa.int64()), "n": pa.array(count[part, entry]),
            "totals": pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))})

    return run


def codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """(part, entry, position) after all rounds; ``rows`` comes from ``usable``.

    The driver holds ``entries`` vectors and one sum a (part, entry, position).
    """
    first = rows.select("id", "vec").orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()
    if not first:
        return np.empty((parts, 0, 0), np.int64)
    books = np.array([r["vec"] for r in first], np.int64).reshape(len(first), parts, -1).swapaxes(0, 1).copy()
    for _ in range(rounds):
        each = rows.select("vec").mapInArrow(_sums(books), "part long, entry long, n long, totals array<long>")
        sums = each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(books.shape[2])])
        for r in sums.collect():
            books[r["part"], r["entry"]] = [r[f"t{i}"] // r["n"] for i in range(books.shape[2])]
    return books


def _codes(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, _, entries, gaps in _assigned(batches, books):
            width = entries.shape[1]
            codes = entries.astype(np.uint8).tobytes()
            names = [codes[i : i + width].hex() for i in range(0, len(codes), width)]
            yield pa.RecordBatch.from_arrays(
                [some.column("id"), some.column("label"), pa.array(names, pa.string()), pa.array(gaps.sum(axis=1))], names=["id", "label", "code", "error"])

    return run


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """id, label, code (two hex digits a part), error of every row of ``usable``."""
    if books.shape[1] > 256:
        raise ValueError("two hex digits name 256 entries at most")
    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(_codes(books), f"id long, label {label}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, code_col: str = "code") -> DataFrame:
    """``codes`` with ``decoded``: the entries' components, divided by the scale."""
    flat = F.array(*[F.array(*[F.array(*[F.lit(int(x) / SCALE) for x in entry]) for entry in book]) for book in books])
    part = lambda p: F.get(F.get(flat, F.lit(p)), F.conv(F.substring(code_col, 2 * p + 1, 2), 16, 10).cast("int"))
    return codes.withColumn("decoded", F.flatten(F.array(*[part(p) for p in range(len(books))])))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _oracle() -> str:
    """The same rounds in SQL: every part against every entry."""
    steps = ["""
kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS (
  SELECT vec_id, label, p.i AS part, v[p.i * (len(v) // 16) + 1 : (p.i + 1) * (len(v) // 16)] AS w
  FROM kept, (SELECT unnest(range(16)) AS i) p),
book0 AS (
  SELECT part, rank() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, w FROM pieces
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
near{r} AS (
  SELECT vec_id, label, part, w, min(struct_pack(gap := gap, entry := entry)) AS best FROM (
    SELECT q.vec_id, q.label, q.part, q.w, b.entry, list_sum(list_transform(range(1, len(q.w) + 1), lambda i: (q.w[i] - b.w[i]) * (q.w[i] - b.w[i]))) AS gap
    FROM pieces q JOIN book{r} b USING (part))
  GROUP BY ALL)""")
        if r < ROUNDS:
            steps.append(f"""
mean{r} AS (
  SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS w FROM (
    SELECT part, best.entry AS entry, i, sum(w[i]) AS total, count(*) AS n
    FROM near{r}, (SELECT unnest(range(1, 257)) AS i) WHERE i <= len(w) GROUP BY part, best.entry, i)
  GROUP BY part, entry),
book{r + 1} AS (
  SELECT part, entry, coalesce(m.w, b.w) AS w FROM book{r} b LEFT JOIN mean{r} m USING (part, entry))""")
    return f"""
WITH {",".join(steps)},
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(lower(lpad(to_hex(best.entry), 2, '0')), '' ORDER BY part) AS code,
         CAST(sum(best.gap) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded"""


@query("op11_vector_codes", _oracle())
def op11_vector_codes(spark, sf_dir):
    """Code and error of every vector, the errors of its label, and the digest of the codebooks."""
    rows = usable(table(spark, sf_dir, "embeddings"))
    books = codebooks(rows)
    coded = stored(encode(rows, books), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
