"""Mixing sources to target weights by temperature.

Each source has a share p of all tokens (words).  Its weight is p**a, normalised.
Smaller exponents flatten the mix; the exponent is bisected in [0, 1] until the mix meets a target
entropy, or until no source repeats more often than a limit; with both, the limit goes first.  All sums over sources are
Spark aggregates; one pass evaluates several halvings at once.

A budget of tokens is dealt to the sources by weight.  ``budget=None`` takes the
least one that shows every document once.  A source's documents stand in an order
that a hash of (seed, epoch, id, text) permutes anew for each epoch.  Its budget is
realised as whole epochs and the beginning of one more, up to the first document that
reaches the budget.  That order is kept in blocks of hash ranges: token sums per
block, then sums within the one block that the budget cuts, so that
no task orders a whole source.

A null source is a source of its own; null and empty texts have no tokens, take part in whole epochs and
in the beginning of one more by their hash.  Rows that are equal in id and text
share their hash and stay together.  Texts are counted whole, extra columns of any name pass through ``mix``, empty
tables give empty mixes.  Without any token every weight is zero and each document
is shown once.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.common import as_bytes, query, stored, table

SEED = 20
#: Halvings that one pass over the sources evaluates.
HALVINGS = 5
PASSES = 8
#: Rows of one source and epoch that share a block, on average.
BLOCK_ROWS = 4096


@F.arrow_udf(LongType())
def _n_words(text: pa.Array) -> pa.Array:
    return pa.array([len(t.split()) for t in as_bytes(text)], pa.int64())


def token_counts(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, key (a hash of the text) and tokens of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                     F.xxhash64(text).alias("key"), _n_words(text).alias("tokens"))


def shares(counts: DataFrame) -> DataFrame:
    """source, rows, tokens, share (of all tokens)."""
    per = counts.groupBy("source").agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens"))
    per = stored(per, "mix-sources")
    total = per.agg(F.sum("tokens").alias("all_tokens"))
    return per.join(total).select("*", F.coalesce(F.try_divide("tokens", "all_tokens"), F.lit(0.0)).alias("share")).drop("all_tokens")


def _entropy(per: DataFrame, exponents: list[float]) -> list[float]:
    """Entropy (nats) of the mix at each exponent: log Z - a * sum(p**a log p) / Z."""
    p = F.col("share")
    sums = per.filter(p > 0).agg(
        *[F.sum(F.pow(p, F.lit(a))).alias(f"z{k}") for k, a in enumerate(exponents)],
        *[F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"s{k}") for k, a in enumerate(exponents)]).first()
    n = len(exponents)
    return [math.log(sums[k]) - a * sums[n + k] / sums[k] if sums[k] else 0.0 for k, a in enumerate(exponents)]


def _repetition(per: DataFrame, exponents: list[float]) -> list[float]:
    """Most epochs of any source, when the budget shows each document once: max p**(a-1) / min p**(a-1)."""
    ends = per.filter("share > 0").agg(F.min("share").alias("low"), F.max("share").alias("high")).first()
    if ends["low"] is None:
        return [1.0] * len(exponents)
    return [(ends["high"] / ends["low"]) ** (1.0 - a) for a in exponents]


def find_exponent(per: DataFrame, entropy: float | None = None, max_epochs: float | None = None) -> float:
    """The largest exponent whose entropy is at least ``entropy``, or the least one
    whose repetitions stay within ``max_epochs``; the nearer end of [0, 1] if none does.

    With both the limit goes first: the larger of the two exponents, whose entropy may be below the target.
    """
    if entropy is None and max_epochs is None:
        raise ValueError("give a target entropy or a repetition limit")
    if entropy is not None and max_epochs is not None:
        return max(find_exponent(per, entropy=entropy), find_exponent(per, max_epochs=max_epochs))
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        steps = 1 << HALVINGS
        grid = [low + (high - low) * k / steps for k in range(steps + 1)]
        # Both measures fall as the exponent grows.
        values, target = (_entropy(per, grid), entropy) if entropy is not None else (_repetition(per, grid), max_epochs)
        k = sum(v >= target for v in values) if entropy is not None else sum(v > target for v in values)
        if k == 0:
            return low
        if k > steps:
            return high
        low, high = grid[k - 1], grid[k]
    return low if entropy is not None else high


def weights(counts: DataFrame, entropy: float | None = None, max_epochs: float | None = None, budget: int | None = None) -> DataFrame:
    """source, rows, tokens, share, exponent, weight, budget, full (whole epochs), rest (tokens of one more)."""
    per = shares(counts)
    exponent = find_exponent(per, entropy, max_epochs)
    power = F.when(F.col("share") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0)
    raw = per.withColumn("raw", power)
    total = raw.agg(F.sum("raw").alias("z"), F.max(F.try_divide("tokens", "raw")).alias("most"))
    dealt = raw.join(total).withColumn("weight", F.coalesce(F.try_divide("raw", "z"), F.lit(0.0)))
    # The least budget that shows every document once gives the source with the most tokens per weight one epoch.
    amount = F.lit(budget).cast("double") if budget is not None else F.coalesce(F.col("most") * F.col("z"), F.lit(0.0))
    dealt = dealt.withColumn("budget", F.round(F.col("weight") * amount).cast("long")).withColumn("exponent", F.lit(exponent))
    full = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(1)).cast("long")
    dealt = dealt.withColumn("full", full).withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens"))
    return stored(dealt.select("source", "rows", "tokens", "share", "exponent", "weight", "budget", "full",
                               F.when(F.col("tokens") > 0, F.col("rest")).otherwise(0).alias("rest")), "mix-weights")


def _place(epoch: Column, seed: int, id_: Column, key: Column) -> Column:
    """Where a document stands in its source's order in an epoch, as a non-negative long."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, F.coalesce(id_, F.lit(-1)), key), 1)


def _block(place: Column, rows: Column) -> Column:
    """The hash range that holds ``place``; a source has about rows / BLOCK_ROWS of them."""
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(rows / F.lit(BLOCK_ROWS)))
    return F.floor(F.shiftrightunsigned(place, 31) / F.lit(1 << 32) * blocks).cast("long")


def cuts(counts: DataFrame, mix: DataFrame, seed: int = SEED) -> DataFrame:
    """source and cut: the place up to which documents belong to the source's part epoch (null: none)."""
    same = F.col("source").eqNullSafe(F.col("s"))
    part = mix.filter("rest > 0").select(F.col("source").alias("s"), "rows", "full", "rest")
    rows = counts.join(part, same).withColumn("place", _place(F.col("full"), seed, F.col("id"), F.col("key")))
    rows = rows.withColumn("block", _block(F.col("place"), F.col("rows")))
    sums = stored(rows.groupBy("source", "rest", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    order = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("tokens").over(order), F.lit(0))
    edge = (
        sums.withColumn("before", before).filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("tokens") >= F.col("rest")))
        .select(F.col("source").alias("es"), F.col("block").alias("eb"), "before")
    )
    edge = stored(edge, "mix-edge")  # the one block of a source that the budget cuts
    within = Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.join(edge, F.col("source").eqNullSafe(F.col("es")) & (F.col("block") == F.col("eb")))
    inside = inside.withColumn("sum", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    return stored(inside.filter("sum < rest").groupBy("source").agg(F.max("place").alias("cut")), "mix-cuts")


def plan(counts: DataFrame, mix: DataFrame, seed: int = SEED) -> DataFrame:
    """source, source_rows, full, cut: all that decides how often a document is shown."""
    cut = cuts(counts, mix, seed).select(F.col("source").alias("cs"), "cut")
    found = mix.join(cut, F.col("source").eqNullSafe(F.col("cs")), "left")
    return stored(found.select(F.col("source").alias("mix_source"), F.col("rows").alias("mix_rows"), F.col("full").alias("mix_full"),
                               F.col("cut").alias("mix_cut"), F.col("weight").alias("mix_weight")), "mix-plan")


def _epochs(id_: Column, key: Column, seed: int) -> Column:
    """Epochs in which a document is shown, from the columns of ``plan``."""
    last = F.col("mix_full")
    extra = F.coalesce(_place(last, seed, id_, key) <= F.col("mix_cut"), F.lit(False))
    n = last + extra.cast("long")
    return F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))


def shown(counts: DataFrame, mix_plan: DataFrame, seed: int = SEED) -> DataFrame:
    """A row for each time a document is shown: epoch, block and place within its source's epoch."""
    rows = counts.join(mix_plan, F.col("source").eqNullSafe(F.col("mix_source")))
    rows = rows.withColumn("epoch", F.explode(_epochs(F.col("id"), F.col("key"), seed)))
    place = _place(F.col("epoch"), seed, F.col("id"), F.col("key"))
    return rows.select("id", "source", "tokens", F.col("mix_weight").alias("weight"), "epoch",
                       _block(place, F.col("mix_rows")).alias("block"), place.alias("place"))


def mix(df: DataFrame, entropy: float | None = None, max_epochs: float | None = None, budget: int | None = None, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` as often as the mix shows them, with their columns."""
    counts = stored(token_counts(df, id_col, text_col, source_col), "mix-counts")
    chosen = plan(counts, weights(counts, entropy, max_epochs, budget), seed)
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    row = packed["row"]
    joined = packed.join(chosen, row[source_col].cast("string").eqNullSafe(F.col("mix_source")))
    times = _epochs(row[id_col].cast("long"), F.xxhash64(F.coalesce(row[text_col], F.lit(""))), seed)
    return joined.select("row", F.explode(times)).select("row.*")


#: Share of the largest possible entropy that the registered query asks for, and the epochs that a source may take for it.
TARGET_ENTROPY, MOST_EPOCHS = 0.95, 64.0


def entropy_target(counts: DataFrame, share: float) -> float:
    """``share`` of the entropy of equal weights for all sources that have tokens."""
    n = counts.filter("tokens > 0").select("source").distinct().count()
    return share * math.log(n) if n > 1 else 0.0


@query("op1_mix_sources")
def op1_mix_sources(spark, sf_dir):
    """Every showing of every document in a mix with 95 % of the largest entropy, no source shown more than ``MOST_EPOCHS`` times."""
    counts = stored(token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", "source"), "mix-counts")
    mixed = weights(counts, entropy=entropy_target(counts, TARGET_ENTROPY), max_epochs=MOST_EPOCHS)
    return shown(counts, plan(counts, mixed)).select(
        F.col("id").alias("doc_id"), "source", "epoch", "block", "place", F.col("tokens").alias("n_tokens"), F.round("weight", 12).alias("weight"))
