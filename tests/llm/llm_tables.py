"""Small tables that the tests of this folder share."""

import random

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType())])
#: Columns that operators use inside under the same names.
CLASHING = StructType([*DOCS, *[StructField(c, DoubleType()) for c in ("id", "run", "digest", "row", "key", "rank", "place", "block", "component", "tokens")]])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType())])

WORDS = [a + b for a in ("ba", "ko", "mi", "ru", "te", "lo", "sa") for b in ("n", "ra", "vel", "x", "do", "stin", "")]


def prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "  ", "\n", ", ", "\t"]) for _ in range(n))


def edit(rng: random.Random, text: str, n: int) -> str:
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def documents() -> list[tuple]:
    """Prose with exact and near copies, shared passages, nulls, empty, tiny and very long texts, and repeated rows."""
    rng = random.Random(5)
    passage = prose(rng, 80)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(40)]
    texts += [None, "", " ", "a", "A", "one two", "One Two", "ÉTÉ été", "Été été", "x " * 3, "\x00\x1f", passage]
    texts += [texts[0], texts[0].upper(), texts[1].title(), texts[2]] + [texts[3]] * 30
    texts += [edit(rng, texts[k], 1) for k in range(4, 16)] + [edit(rng, passage, 1) for _ in range(4)]
    texts += [prose(rng, 20) + passage + prose(rng, 30) for _ in range(6)] + [prose(rng, 40) + texts[5][:200] + prose(rng, 10)]
    texts += [prose(rng, 20_000), ("same line again " * 4 + "\n") * 400, "word" * 20_000]
    rows = [(i * 3, t, "en", None if i % 17 == 5 else f"s{i % 5 if i % 2 else 0}", len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows
