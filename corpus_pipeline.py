"""From documents to token ids: five stages over the operators of ``tidemark.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
one's result as Parquet and rereads it as the next one's docs.  All stages but the
last return the columns of documents.

1. toxicity: documents that score 0.5 or more go.
2. exact dedup: of equal texts (A-Z folded) the largest doc_id stays.
3. SimHash near-dedup: of each component the smallest doc_id stays.
4. mixing: the temperature that lets no source repeat more than ``MAX_EPOCHS`` times,
   with the least budget that shows every document once.  No document goes.
5. SentencePiece: token ids of every showing.

A mix repeats documents, so a doc_id may come twice after stage 4.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing, sentence_pieces, simhash, toxicity
from tidemark.llm.common import small_batches, stored, table

REJECT_FROM = 0.5
MAX_EPOCHS = 2.0
MODEL = "piece_bpe_32k.model"

#: No SQL counterpart: stages 1, 3, 4 and 5 can't be expressed; tests hold run() against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = toxicity.learned_scorer(docs, table(spark, sf_dir, "labels"))
    return docs.filter(score(F.col("text")) < REJECT_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.mix(docs, max_epochs=MAX_EPOCHS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    encoded = sentence_pieces.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path(MODEL), out="ids")
    return encoded.select("doc_id", "source", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentence_pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
