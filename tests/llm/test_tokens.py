"""Token files and SentencePiece against the tokenizer libraries."""

import glob
import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import sentence_pieces, token_file

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], list(range(1000)), [5] * 700 + [2**40], sorted(random.Random(1).choices(range(10**6), k=3000))])
def test_elias_fano(values):
    code, _ = token_file.EliasFano.load(b"xx" + token_file.EliasFano.encode(np.array(values)).dump(), 2)
    assert code.select(np.arange(len(values))).tolist() == values
    some = list(range(0, len(values), 7))[::-1]
    assert code.select(np.array(some, np.int64)).tolist() == [values[i] for i in some]


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 50_000))
    size = len(token_file.EliasFano.encode(ends).dump()) * 8 / len(ends)
    assert size < 3 + np.log2(ends[-1] / len(ends))


def whole_texts(rows):
    encoder = Tokenizer.from_file(BYTE_BPE)
    start = 0
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        ids = encoder.encode(t or "", add_special_tokens=False).ids + [2]
        yield i, start, ids
        start += len(ids)


def test_written_ids(spark, docs, rows, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/tokens"
    shards = token_file.write_tokens(docs, root, BYTE_BPE, end_id=2)
    got = {r["id"]: (r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_file.read_tokens(spark, root, shards).collect()}
    assert got == {i: (s, ids) for i, s, ids in whole_texts(rows)}
    assert shards.agg(F.sum("n_docs")).first()[0] == len(rows)
    assert len(glob.glob(f"{tmp_path}/tokens/ids-*.bin")) == shards.count()


def test_written_ids_of_clashing_columns_and_added_tokens(spark, tmp_path):
    texts = ["end <|endoftext|> of", "<|endoftext|>", "plain"]
    frame = spark.createDataFrame([(i, t, 1.5, 2.5) for i, t in enumerate(texts)], "doc_id long, text string, id double, place double")
    shards = token_file.write_tokens(frame, f"file://{tmp_path}/c", BYTE_BPE, end_id=2)
    got = {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_file.read_tokens(spark, f"file://{tmp_path}/c", shards).collect()}
    library = Tokenizer.from_file(BYTE_BPE)
    assert got == {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    assert len(got[1]) == 2


def test_shards_are_read_by_as_many_tasks(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "SHARD_BYTES", 1 << 12)
    shards = token_file.write_tokens(docs, f"file://{tmp_path}/d", BYTE_BPE)
    read = token_file.read_tokens(spark, f"file://{tmp_path}/d", shards)
    assert shards.count() >= 4 and read.rdd.getNumPartitions() == shards.count()


def test_long_words_are_not_kept():
    encoder = token_file.Encoder(BYTE_BPE)
    encoder.encode(["short " + "x" * 10_000 + " words"])
    assert all(len(w) <= token_file.LONGEST_KEPT for w in encoder.recent) and encoder.kept < 1000


def test_written_ids_with_odd_ids(spark, odd_ids, no_docs, tmp_path):
    shards = token_file.write_tokens(odd_ids, f"file://{tmp_path}/a", BYTE_BPE)
    got = token_file.read_tokens(spark, f"file://{tmp_path}/a", shards).orderBy("start", F.length("ids")).collect()
    ids = [r["id"] for r in got]
    assert len(ids) == odd_ids.count() and ids[-4:] == [None] * 4
    assert ids[:-4] == sorted(ids[:-4])
    ends = [r["start"] + len(r["ids"]) // 4 for r in got]
    assert [r["start"] for r in got] == [0, *ends[:-1]]
    nothing = token_file.write_tokens(no_docs, f"file://{tmp_path}/b", BYTE_BPE)
    assert token_file.read_tokens(spark, f"file://{tmp_path}/b", nothing).count() == 0


SPACES = [chr(c) for c in (0x20, 0x20, 0x0A, 0x09, 0x0D, 0x0B, 0x1C, 0x85, 0xA0, 0x2003, 0x2028, 0x3000, 0x200B, 0x180E)]


def odd_texts():
    rng = random.Random(9)
    letters = "abestin's'llreTHE019.,!?-_<|>" + chr(0xE9) + chr(0x4E2D) + chr(0x1F600)
    texts = ["".join(rng.choice(letters) if rng.random() < 0.75 else rng.choice(SPACES) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return texts + ["", " ", "   ", "\n\n\n", " a", "a ", "a  ", "a \n b", "<|endoftext|>", "<s> </s>", "x" * 5000, " " * 300, chr(0x2581) * 3, "a" + chr(0x2581) + "b"]


@pytest.mark.parametrize("special", [False, True])
def test_pieces_of_texts_encode_like_whole_texts(monkeypatch, special):
    """The cut into words and the caches don't change any id; added tokens are what the untouched library makes of them."""
    monkeypatch.setattr(token_file, "CACHE_BYTES", 20_000)
    encoder, plain = token_file.Encoder(BYTE_BPE, special), Tokenizer.from_file(BYTE_BPE)
    if special:
        plain.encode_special_tokens = True
    texts = odd_texts() + ["some <|endoftext|> here", "a<|endoftext|>b<|endoftext|>", " <|endoftext|> ", "<|endoftext|", "< |endoftext|>"]
    for at in range(0, len(texts), 30):
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts[at : at + 30])]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts[at : at + 30]]


def test_words_are_looked_up_once_and_without_punctuation(monkeypatch):
    """Of many texts' words the library gets each once, and the same letters before other punctuation are no new word."""
    encoder, asked = token_file.Encoder(BYTE_BPE), []
    plain = encoder._word_ids
    monkeypatch.setattr(encoder, "_word_ids", lambda words: asked.extend(words) or plain(words))
    texts = ["a word, a word. a word; a word!", "a word; a word", "a word? word" + chr(0x3000) + "apart"]
    library = Tokenizer.from_file(BYTE_BPE)
    for _ in range(2):
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(asked) == sorted([b"a", b" a", b" word", b",", b".", b";", b"!"])


def test_punctuation_like_the_library():
    """Cuts between letters or digits and punctuation change no id; words without a space in front are told apart again."""
    rng = random.Random(11)
    encoder, library = token_file.Encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    parts = [*"ab12.,;!?'\"()/-_#%$", "'s", "'ll", "n't", " ", "  ", "\n", "\r\n", chr(0xE9), chr(0x2026), chr(0x301), chr(0x4E2D), chr(0x2028), "the", "Word", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(2000)]
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.Pieces(PIECES)


def test_pieces_like_the_library(model, rows, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CACHE_BYTES", 40_000)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = odd_texts() + [t or "" for _, t, *_ in rows]
    for at in range(0, len(texts), 40):
        some = texts[at : at + 40]
        got = model.encode(some)
        assert [x.tolist() for x in got] == library.encode(some)
        for ids, t in zip(got, some):
            assert model.decode(ids) == library.decode(ids.tolist()) == t.replace(sentence_pieces.MARK, " ")


def test_long_words_like_the_library(model):
    """Chinese, base64, repeated letters and marks inside: cut at joints, and in time in proportion to the length."""
    rng = random.Random(3)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    han = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(30_000))
    base64 = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(30_000))
    for text in (han, base64, "x" * 3000, "word" * 800, "a" + chr(0x2581) * 99 + "b" * 99, " " * 200 + "end"):
        assert model.encode([text])[0].tolist() == library.encode(text)
        assert all(len(w) <= sentence_pieces.LONG for w in model.recent)
    times = []
    for n in (1, 8):
        began = time.process_time()
        model.encode([han[:3000] * n + base64[:3000] * n])
        times.append(time.process_time() - began)
    assert times[1] < 16 * times[0] + 0.5


def test_a_hash_alone_is_no_hit(model, monkeypatch):
    """Pieces under wrong hashes are not taken for the substrings that have these hashes."""
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = "some words that have pieces of their own"
    monkeypatch.setattr(model, "key_ids", np.roll(model.key_ids, 1))
    monkeypatch.setattr(model, "recent", {})
    monkeypatch.setattr(model, "older", {})
    wrong = model.encode([text])[0].tolist()
    assert wrong != library.encode(text) and all(i in set(model.byte_id.values()) for i in wrong)
    model.recent.clear()


def test_every_piece_encodes_to_itself(model):
    """Behind a mark of its own, each reachable piece is one piece."""
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    some = [t[1:] for t in model.text[259:] if t.startswith(sentence_pieces.MARK) and t.strip(sentence_pieces.MARK)][::37]
    assert [x.tolist() for x in model.encode(some)] == library.encode(some)


def test_piece_words_are_looked_up_once_and_without_punctuation(monkeypatch):
    """Words end where no piece joins, so the same letters before other punctuation are no new word."""
    model, asked = sentence_pieces.Pieces(PIECES), []
    plain = model.encode_words
    monkeypatch.setattr(model, "encode_words", lambda words: asked.extend(words) or plain(words))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["odd word; odd word! odd word~", "odd word? odd word", "", "odd " * 50 + "word;"]
    for _ in range(2):
        assert [x.tolist() for x in model.encode(texts)] == library.encode(texts)
    assert len(asked) == len(set(asked)) and {" odd", " word"} <= set(asked) and not any(w.startswith(" word") and w != " word" for w in asked)


def test_piece_punctuation_like_the_library(model):
    """Cuts by neighbouring bytes change no id, also beside marks, line ends and characters of several bytes."""
    rng = random.Random(12)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    parts = [*"ab12.,;!?'\"()/-_#%$~^", "'s", "...", "://", " ", "  ", "\n", "\r\n", "\t", chr(0), chr(0x7F), chr(0xE9), chr(0x2026), chr(0x301), chr(0x4E2D), chr(0x1F600), chr(0x2581), "the", "Word", "x" * 60]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(2000)]
    got = model.encode(texts)
    assert [x.tolist() for x in got] == library.encode(texts)
    flat, ends = model.encode_utf8([t.encode() for t in texts])
    assert np.array_equal(flat, np.concatenate(got)) and np.diff(ends).tolist() == [len(x) for x in got]
    back = model.decode_utf8(flat, ends)
    assert [x.decode() for x in back] == [model.decode(x) for x in got] == [library.decode(x.tolist()) for x in got]
    assert [sentence_pieces.same_text(x, t.encode()) for x, t in zip(back, texts)] == [sentence_pieces.MARK not in t for t in texts]


def test_decoded_bytes_and_the_text():
    """What is no UTF-8 counts as the character that replaces it."""
    assert sentence_pieces.same_text(b"a\xff", "a\ufffd".encode()) and sentence_pieces.same_text(b"", b"")
    assert not sentence_pieces.same_text(b"a\xff", b"a") and not sentence_pieces.same_text(b"a", b"b")


def test_encode_and_decode_columns(spark, clashing, no_docs):
    coded = sentence_pieces.encode(clashing, PIECES, out="ids")
    back = sentence_pieces.decode(coded, PIECES).select("text", "ids", "decoded").collect()
    assert coded.columns == [*clashing.columns, "ids"]
    assert all(r["decoded"] == (r["text"] or "") and (len(r["ids"]) == 0) == (not r["text"]) for r in back)
    assert sentence_pieces.encode(no_docs, PIECES).count() == 0
    assert sentence_pieces.decode(spark.createDataFrame([(None,)], "ids array<int>"), PIECES).first()["decoded"] == ""
