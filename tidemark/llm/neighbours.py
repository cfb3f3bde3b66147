"""Approximate nearest neighbours by collision-counting hashing.

Nearness is the inner product.  Each vector, divided by the largest norm, gets one
more component that makes its length 1; for a query of length 1 the nearest vector by distance is then the
one with the largest inner product.

Vectors are dealt at random over blocks of bounded size.  A block projects its
vectors on ``PROJECTIONS`` random directions and keeps one sorted array for each.  A query opens a
window around its own projection in each array, and counts for every vector
the arrays in which it collides with the query.  Virtual rehashing widens all
windows by a factor until enough vectors reach the collision threshold; those are
verified by their inner product with the original vector in double precision.
Every query visits every block, so all vectors are searched; the best of all blocks are merged.

How many are verified in all grows slower than the table (``share_verified``), since the
nearest of more vectors stand out more; a larger share gives a higher recall, and
``exact`` verifies every vector.

Vectors that are null, empty, zero or hold a null or non-finite component take no
part, nor do those of another length than most.  A query's own row is no
candidate; other rows with its id or its vector are.  Vectors are scaled by the largest
component of all before lengths are taken, so none over- or underflows there; a score is
the inner product of the original components, 0 or infinite where doubles end.
Empty tables and tables without a query give empty results; columns besides id and
vector are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, stored, table

K = 20
PROJECTIONS = 96
#: Share of the projections in which a vector must collide.
THRESHOLD = 0.5
#: Half width of the first windows, in units of the projections' standard deviation, and the growth of each round.
FIRST_WIDTH, GROWTH = 0.8, 1.08
#: Vectors of a block that are verified at least, and the share of a table of ``SHARE_OF`` rows; it falls with this power of the rows.
VERIFY, VERIFY_SHARE, SHARE_OF, SHARE_POWER = 100, 0.3, 2000, 0.15
#: Queries that widen their windows together.
TOGETHER = 256
BLOCK_ROWS = 4096
QUERY_ROWS = 16384
SEED = 7


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """uid, id, vec (doubles), peak (largest absolute component) of the vectors that take part."""
    vec = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0))
    rows = rows.withColumn("peak", F.array_max(F.transform("vec", F.abs)))
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten().to_numpy(zero_copy_only=False) if len(flat) else np.empty(0)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def directions(d: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((d, PROJECTIONS))


def share_verified(rows: int) -> float:
    """The share of a table of ``rows`` vectors that a query verifies."""
    return min(1.0, VERIFY_SHARE * (max(rows, 1) / SHARE_OF) ** -SHARE_POWER)


class Block:
    """Sorted projections of some vectors (n, d); ``peak`` is the largest component of all vectors, ``largest`` the largest norm in units of it."""

    def __init__(self, vectors: np.ndarray, peak: float, largest: float):
        self.vectors, self.n = vectors, len(vectors)
        self.axes = directions(vectors.shape[1] + 1)
        unit = vectors / peak / largest
        lift = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        projected = np.concatenate([unit, lift[:, None]], 1) @ self.axes
        self.order = np.argsort(projected, axis=0).T.copy()
        self.sorted = np.take_along_axis(projected.T, self.order, 1).copy()
        self.unit = np.linalg.norm(self.axes, axis=0) / np.sqrt(len(self.axes))

    def candidates(self, queries: np.ndarray, enough: int) -> list[np.ndarray]:
        """For each query the vectors that reach the collision threshold, after widening until there are enough."""
        scaled = queries / np.abs(queries).max(axis=1)[:, None]
        centre = ((scaled / np.linalg.norm(scaled, axis=1)[:, None]) @ self.axes[:-1]).T
        # From this width on every window covers its whole array.
        widest = (np.abs(centre).max(initial=0.0) + np.abs(self.sorted).max(initial=0.0)) / self.unit.min()
        need, width = int(np.ceil(THRESHOLD * PROJECTIONS)), FIRST_WIDTH
        found: list[np.ndarray] = [None] * len(queries)
        counts = np.zeros((len(queries), self.n), np.int64)
        active = np.arange(len(queries))
        low = high = None
        while len(active):
            reach = width * self.unit
            new_low = [np.searchsorted(a, c[active] - r, "left") for a, c, r in zip(self.sorted, centre, reach)]
            new_high = [np.searchsorted(a, c[active] + r, "right") for a, c, r in zip(self.sorted, centre, reach)]
            new_low, new_high = np.array(new_low).T.tolist(), np.array(new_high).T.tolist()
            stay = []
            for i, q in enumerate(active.tolist()):
                if low is None:
                    gained = [o[a:b] for o, a, b in zip(self.order, new_low[i], new_high[i])]
                else:  # only what the wider windows add
                    gained = [o[a:b] for o, a, b in zip(self.order, new_low[i], low[i])] + [o[a:b] for o, a, b in zip(self.order, high[i], new_high[i])]
                counts[q] += np.bincount(np.concatenate(gained), minlength=self.n)
                hit = np.flatnonzero(counts[q] >= need)
                if len(hit) >= min(enough, self.n):
                    found[q] = hit
                else:
                    stay.append(i)
            active, low, high = active[stay], [new_low[i] for i in stay], [new_high[i] for i in stay]
            if width > widest:
                break
            width *= GROWTH
        found = [np.arange(self.n) if f is None else f for f in found]
        return found

    def search(self, queries: np.ndarray, k: int, ids: np.ndarray, skip: list[int], share: float = 1.0) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query places and inner products of the best ``k`` found, best first, ties to smaller ids.

        ``skip`` has the place of each query's own row, or -1; ``share`` of the block, and ``VERIFY`` vectors, are verified at least.
        """
        enough = max(VERIFY, k + 1, int(np.ceil(share * self.n)))
        out = []
        for at in range(0, len(queries), TOGETHER):
            some = queries[at : at + TOGETHER]
            for query, found, own in zip(some, self.candidates(some, enough), skip[at:]):
                found = found[found != own]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = np.nan_to_num(np.einsum("ij,j->i", self.vectors[found], query), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                best = np.lexsort((ids[found], -score))[:k]
                out.append((found[best], score[best]))
        return out


_SCHEMA = "q_uid long, query_id long, ids array<long>, scores array<double>, uids array<long>"


def _search(k: int, share: float):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("q_uid", "query_id", "ids", "scores", "uids")}
        if vectors.num_rows and queries.num_rows:
            uid, ids = vectors["uid"].to_numpy(), vectors["id"].to_numpy()
            block = Block(_matrix(vectors["vec"]), vectors["peak"][0].as_py(), vectors["largest"][0].as_py())
            place = {u: i for i, u in enumerate(uid.tolist())}
            q_uid, q_id = queries["q_uid"].to_pylist(), queries["query_id"].to_pylist()
            found = block.search(_matrix(queries["q_vec"]), k, ids, [place.get(q, -1) for q in q_uid], share)
            for q, i, (at, score) in zip(q_uid, q_id, found):
                for c, v in (("q_uid", q), ("query_id", i), ("ids", ids[at].tolist()), ("scores", score.tolist()), ("uids", uid[at].tolist())):
                    out[c].append(v)
        types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.int64()))
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    return run


def nearest(df: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", share: float | None = None, exact: bool = False) -> DataFrame:
    """query_id, rank, id, score: the best ``k`` found for every row of ``df`` that ``is_query`` (a predicate on ``id``) picks.

    ``share`` of the vectors is verified for each query (by default ``share_verified``), with ``exact`` all of them.
    Null ids never are queries; as candidates they come last in ties.
    """
    rows = usable(df, id_col, vector_col)
    queries = rows.filter(is_query(F.col("id")))
    n = rows.agg(F.count("*").alias("n"), F.max("peak").alias("peak"), F.count_if(is_query(F.col("id"))).alias("q")).first()
    peak = n["peak"] or 1.0
    scaled = F.aggregate(F.transform("vec", lambda x: (x / F.lit(peak)) * (x / F.lit(peak))), F.lit(0.0), lambda s, x: s + x)
    largest = rows.agg(F.sqrt(F.max(scaled))).first()[0] or 1.0
    share = 1.0 if exact else share_verified(n["n"]) if share is None else share
    blocks, groups = max(1, -(-n["n"] // BLOCK_ROWS)), max(1, -(-n["q"] // QUERY_ROWS))
    spread = lambda parts: F.pmod(F.xxhash64("uid"), F.lit(parts))
    each = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    vectors = rows.select("uid", F.coalesce("id", F.lit((1 << 63) - 1)).alias("id"), "vec", F.lit(peak).alias("peak"), F.lit(largest).alias("largest"), spread(blocks).alias("block"), each(groups).alias("part"))
    asked = queries.select(F.col("uid").alias("q_uid"), F.col("id").alias("query_id"), F.col("vec").alias("q_vec"), spread(groups).alias("part"), each(blocks).alias("block"))
    found = vectors.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(_search(k, share), _SCHEMA)
    best = Window.partitionBy("q_uid").orderBy(F.desc("score"), "id", "uid")
    return (
        found.select("q_uid", "query_id", F.explode(F.arrays_zip("ids", "scores", "uids")).alias("f"))
        .select("q_uid", "query_id", F.col("f.ids").alias("id"), F.col("f.scores").alias("score"), F.col("f.uids").alias("uid"))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.when(F.col("id") != (1 << 63) - 1, F.col("id")).alias("id"), "score")
    )


@query("op2_nearest_vectors")
def op2_nearest_vectors(spark, sf_dir):
    """The 20 nearest of every 20th vector."""
    found = nearest(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
