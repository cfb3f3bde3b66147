"""The registered queries against SQL, and the pipeline against brute force."""

import math
import os
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from llm_tables import DOCS, LABELS  # noqa: E402
from test_dedup import plain_components, plain_fingerprint, plain_repeats  # noqa: E402
from test_scans import plain_findings, plain_scan  # noqa: E402
from tidemark.llm import toxicity  # noqa: E402
from tidemark.llm.queries import ORACLES, QUERIES  # noqa: E402

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_like_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    mine = QUERIES[name](spark, SF_DIR)
    columns = ", ".join(sorted(mine.columns))
    theirs = con.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in mine.select(*sorted(mine.columns)).collect()))) == sorted(map(repr, theirs))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_its_table(spark, name):
    con = duckdb.connect()
    out = QUERIES[name](spark, SF_DIR)
    if name.startswith("op2_"):
        ids = {r[0] for r in con.execute(f"SELECT vec_id FROM '{SF_DIR}/embeddings.parquet' WHERE vec_id % 20 = 0").fetchall()}
        assert {r["query_id"] for r in out.select("query_id").collect()} == ids
    else:
        ids = {r[0] for r in con.execute(f"SELECT doc_id FROM '{SF_DIR}/documents.parquet'").fetchall()}
        assert {r["doc_id"] for r in out.select("doc_id").collect()} == ids


@pytest.fixture(scope="module")
def given():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables not present")
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


def collected(spark, name, *columns):
    return sorted(tuple(r) for r in QUERIES[name](spark, SF_DIR).select(*columns).collect())


def test_token_files_of_the_given_table(spark, given):
    library, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i, t in given:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert collected(spark, "op3_elias_fano_tokens", "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_fingerprints_of_the_given_table(spark, given):
    prints = {i: plain_fingerprint(t) for i, t in given}
    component = plain_components(prints)
    want = [(i, f"{prints[i]:016x}", component[i]) for i, _ in given]
    assert collected(spark, "op4_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == want


def test_pieces_of_the_given_table(spark, given):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    ids = {i: np.array(library.encode(t or ""), "<u4") for i, t in given}
    want = [(i, len(x), zlib.crc32(x.tobytes())) for i, x in ids.items()]
    assert collected(spark, "op5_sentence_pieces", "doc_id", "n_tokens", "ids_crc32") == want


def test_licences_of_the_given_table(spark, given):
    want = [(i, *plain_scan(t), ",".join(sorted({label for _, label in plain_findings(t)}))) for i, t in given if "spdx" not in (t or "").lower()]
    got = {r[0]: r for r in collected(spark, "op6_license_scan", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")}
    assert len(got) == len(given) and [got[r[0]] for r in want] == want


def test_repeats_of_the_given_table(spark, given):
    want = [(i, n, gone, digest.hex()) for i, n, gone, digest in plain_repeats(given)]
    assert collected(spark, "op9_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_toxicity_of_the_given_table(spark, given):
    """Scores follow plainly from the learned lexicon: hits of whole words and beginnings, damped weight, logistic curve."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))
    a, b = lexicon.curve

    def plain_score(text):
        words = toxicity.fold(text or "").split()
        total = 0.0
        for k, w in enumerate(words):
            if any(words[j : j + len(p.split())] == p.split() and j <= k < j + len(p.split()) for p in lexicon.exceptions for j in range(max(0, k - 3), k + 1)):
                continue
            total += max((x for e, x in lexicon.weights.items() if w == e or e.endswith("*") and w.startswith(e[:-1])), default=0.0)
        signal = math.log1p(100.0 * total / max(len(words), 1))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, a * signal + b)))) if lexicon.weights else 0.0

    got = {r[0]: r for r in collected(spark, "op7_toxicity", "doc_id", "held_out", "score", "predicted")}
    assert got.keys() == {i for i, _ in given}
    for i, t in given:
        assert got[i][1] == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i][3] == (got[i][2] >= 0.5)
        assert got[i][2] == pytest.approx(plain_score(t), abs=1e-9)


def test_mix_of_the_given_table(spark, given):
    """Every document in whole epochs, in blocks by its place, and the budget met by each source's part epoch."""
    rows = QUERIES["op1_mix_sources"](spark, SF_DIR).collect()
    shown = {}
    for r in rows:
        shown.setdefault((r["source"], r["epoch"]), []).append(r)
    words = {i: len((t or "").encode().split()) for i, t in given}
    assert all(r["n_tokens"] == words[r["doc_id"]] for r in rows)
    for (source, epoch), part in shown.items():
        assert len({r["doc_id"] for r in part}) == len(part)
        whole = shown[source, 0]
        assert {r["doc_id"] for r in part} <= {r["doc_id"] for r in whole}
        if (source, epoch + 1) in shown:
            assert len(part) == len(whole)
    assert {r["doc_id"] for r in rows if r["epoch"] == 0} == set(words)
    tokens = {s: sum(r["n_tokens"] for r in rows if r["source"] == s) for s in {r["source"] for r in rows}}
    weight = {r["source"]: r["weight"] for r in rows}
    least = min((s for s in tokens if weight[s]), key=lambda s: tokens[s] / weight[s])
    budget = tokens[least] / weight[least]
    longest = max(words.values())
    assert all(abs(tokens[s] - weight[s] * budget) <= 2 * longest + 2 for s in tokens)


def test_pipeline(spark, docs, rows, tmp_path):
    toxic_rows = [(10_000 + i, f"some vile thing {i} " + "vileword here " * 9 + str(i), "en", "s1", 0) for i in range(60)]
    labels = [(r[0], 1, 0) for r in rows] + [(r[0], 0, 1) for r in toxic_rows]
    spark.createDataFrame(rows + toxic_rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    # Brute force: toxic documents go, then copies, then near copies; what is left is shown once or twice.
    texts = {r[0]: r[1] or "" for r in rows + toxic_rows}
    lexicon = toxicity.learn(toxicity.training_rows(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")))
    clean = {i: t for i, t in texts.items() if lexicon.score(t) < 0.5}
    assert clean.keys() == {r[0] for r in rows}
    last = {}
    for i in sorted(clean):
        last[clean[i].encode().lower()] = i
    left = {i: clean[i] for i in last.values()}
    kept = set(plain_components({i: plain_fingerprint(t) for i, t in left.items()}).values())
    assert kept < left.keys() < clean.keys()
    assert {r["doc_id"] for r in got} == kept
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    shown = {}
    for r in got:
        shown[r["doc_id"]] = shown.get(r["doc_id"], 0) + 1
        assert list(r["ids"]) == library.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
    assert set(shown.values()) <= {1, 2} and 2 in shown.values()


def test_stages_keep_columns_and_take_odd_tables(spark, odd_ids, no_docs, clashing, tmp_path):
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for frame in (odd_ids, clashing, no_docs):
            out = stage(spark, frame, str(tmp_path))
            assert (out.count() > 0) == (frame is not no_docs)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == frame.columns
