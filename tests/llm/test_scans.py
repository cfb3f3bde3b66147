"""Licences, toxicity and url rules."""

import random
import re
import time
import zlib

import pytest
from llm_tables import DOCS, LABELS

from tidemark.llm import licenses, toxicity, url_rules

NOTICE = "Released under the MIT License. mit-license; Apache License / apache\x00license GENERAL public\nlicense"
TEXTS = [None, "", " ", "mit license", "MIT LICENSE MIT license", NOTICE, "permit license", "mit licenses", "émit license", "mit é license",
         "the gnu general public license mit license", "x " * 30_000 + "apache license", "SPDX-License-Identifier: (MIT OR GPL-3.0) AND BSD-3-Clause",
         "// SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0\ncode", "SPDX-License-Identifier: MIT AND", "SPDX-License-Identifier:"]


def plain_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(k, label) for k in range(len(words)) for phrase, label in licenses.BASE.items() if words[k : k + len(phrase.split())] == phrase.split()]
    return (len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))


def test_base_phrases(spark, docs, rows):
    texts = TEXTS + [t for _, t, *_ in rows]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["id"]: r for r in licenses.scan(frame).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_scan(t)
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert (r["score"] == 0) == (r["labels"] == "" and not r["expressions"])
    assert got[12]["labels"] == "bsd,gpl,mit" and got[12]["permissive"] is True
    assert got[13]["labels"] == "gpl" and got[13]["permissive"] is False


@pytest.mark.parametrize("expression,labels,free", [
    ("mit", {"mit"}, True), ("mit or gpl-3.0", {"mit", "gpl"}, True), ("mit and gpl-3.0", {"mit", "gpl"}, False),
    ("gpl-2.0 or mit and gpl-3.0", {"mit", "gpl"}, False), ("(gpl-2.0 or mit) and bsd-2-clause", {"mit", "gpl", "bsd"}, True),
    ("gpl-2.0 with gcc-exception or mit", {"gpl", "mit"}, True), ("foo-1.0 or mit", {"mit"}, True), ("zlib or mit", {"zlib", "mit"}, True), ("licenseref-foo-1.0 or mit", {"licenseref-foo-1.0", "mit"}, True),
    ("foo-1.0 and mit", {"mit"}, None), ("zlib and mit", {"zlib", "mit"}, None), ("mit and", {"mit"}, True), ("((mit", {"mit"}, None), ("", set(), None), ("and or", set(), None)])
def test_expressions(expression, labels, free):
    assert licenses.evaluate(expression) == (labels, free)


def test_several_tags_on_a_line():
    tag = "SPDX-License-Identifier: "
    found = licenses.Scanner().scan(f"a {tag}MIT */ b {tag}GPL-3.0-only c {tag}\n{tag}BSD-3-Clause OR {tag}ISC".encode())
    assert found.labels == {"mit", "gpl", "bsd", "isc"} and found.permissive is False
    assert found.expressions == ["mit */ b", "gpl-3.0-only c", "bsd-3-clause or", "isc"]
    assert licenses.Scanner().scan(f"{tag}MIT {tag}GPL-3.0-only".encode()).permissive is False


@pytest.mark.parametrize("line", ["MIT " + "some minified code " * 55_000, "(" * 300_000 + "MIT", "MIT" + " OR (MIT" * 120_000, " OR ".join(f"LicenseRef-x{i}" for i in range(120_000)),
                                  "MIT SPDX-License-Identifier: " * 40_000])
def test_long_lines_take_time_in_proportion(line):
    began = time.process_time()
    found = licenses.Scanner().scan(f"SPDX-License-Identifier: {line}".encode())
    assert time.process_time() - began < 8
    assert found.labels == ({f"licenseref-x{i}" for i in range(120_000)} if line.startswith("L") else {"mit"})


@pytest.mark.parametrize("text,labels", [
    ("SPDX-License-Identifier: (see the file for details", set()), ("SPDX-License-Identifier: see LICENSE", set()),
    ("The spdx license identifier of a file", set()), ("SPDX-License-Identifier: MITNFA", {"mitnfa"}), ("SPDX-License-Identifier: mitten", set()),
    ("SPDX-License-Identifier: cc-by-nc-sa-4.0", {"cc-by-nc-sa"}), ("SPDX-License-Identifier: GPLv2", {"gpl"}), ("SPDX-License-Identifier: gplvisual", set()),
    ("SPDX-License-Identifier: lgpl2.1+", {"lgpl"}), ("SPDX-License-\n * Identifier: MIT", {"mit"}), ("SPDX License\nIdentifier\nMIT", set()),
    ("spdx\xe9 license identifier: MIT", set()), ("x SPDX-License-Identifier MPL-2.0. End", {"mpl"}), ("SPDX-License-Identifier: OpenSSL.", {"openssl"})])
def test_only_licences_are_labels(text, labels):
    found = licenses.Scanner().scan(text.encode())
    assert found.labels == labels
    assert (found.score >= licenses.STRENGTH["tag"]) == bool(labels) == bool(found.expressions) and (found.score > 0) == bool(labels)


def plain_findings(text):
    """(kind, label) of base phrases and notices by looking at every word; a notice inside a longer one is none."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = {kind: [(k, k + len(p.split()), label) for p, label in phrases.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
              for kind, phrases in (("base", licenses.BASE), ("notice", licenses.NOTICES))}
    whole = [x for x in places["notice"] if not any(y[0] <= x[0] and x[1] <= y[1] and y[1] - y[0] > x[1] - x[0] for y in places["notice"])]
    return {("base", label) for *_, label in places["base"]} | {("notice", label) for *_, label in whole}


def test_notices_like_looking_at_every_word():
    rng = random.Random(11)
    vocabulary = sorted({w for p in [*licenses.BASE, *licenses.NOTICES] for w in p.split()})
    scanner = licenses.Scanner()
    for _ in range(300):
        text = " ".join(rng.choice([*licenses.BASE, *licenses.NOTICES]) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))
        found, want = scanner.scan(text.encode()), plain_findings(text)
        miss = 1.0
        for kind, _ in want:
            miss *= 1 - licenses.STRENGTH[kind]
        assert found.labels == {label for _, label in want} and found.score == pytest.approx(1 - miss)


def test_scan_edges(clashing, odd_ids, no_docs):
    assert licenses.scan(clashing).count() == clashing.count()
    assert licenses.scan(odd_ids).count() == odd_ids.count() and licenses.scan(no_docs).count() == 0


def test_folding():
    looks = "1d" + chr(0x456) + chr(0x43E) + "t"
    assert toxicity.fold("IDIOT, Id10t " + looks + "!") == " idiot idiot idiot "
    assert toxicity.fold("") == "  " and toxicity.fold(" .,;") == "  "


@pytest.mark.parametrize("written", [
    "c1own", "c|own", "cIown", "C1OWN", "\uff43\uff4c\uff4f\uff57\uff4e", "\uff23\uff2c\uff2f\uff37\uff2e", "cl\u00f6wn", "clo\u0308wn", "c\u0336l\u0336own",
    "clo\u200bwn", "\ufeffclown", "cl\u00adown", "\U0001d41c\U0001d425\U0001d428\U0001d430\U0001d427", "\u0441lown", "c\u04cfown", "the|clown|here"])
def test_written_otherwise(written):
    lexicon = toxicity.Lexicon({"clown": 3.0, "worthles*": 1.0})
    assert lexicon.raw(f"a {written}!")[0] == 3.0 == toxicity.Lexicon.load(lexicon.dump()).raw(written)[0]


def test_folding_of_looks_and_exceptions():
    for written, word in (("\u043a\u043c\u0442\u043d\u0432", "kmthb"), ("\u039a\u03a4\u03a5", "ktu"), ("\u03cd\u03c4", "ut"), ("worth1ess 1oser", "worthless loser")):
        assert toxicity.fold(written) == toxicity.fold(word)
    assert toxicity.fold("a | b || c") == " a b c " and toxicity.fold("a|b") == " aib a b "
    lexicon = toxicity.Lexicon({"clown": 3.0, "loser": 2.0}, ("clown fish",))
    assert lexicon.raw("c1own fish") == (0.0, 2) and lexicon.raw("c1own fish, c1own") == (3.0, 3) and lexicon.raw("1oser") == (2.0, 1)


def test_lexicon_hits():
    lexicon = toxicity.Lexicon({"trash": 3.0, "low*": 2.0, "lowei*": 4.0}, ("trash can",))
    assert lexicon.raw("Trash!") == (3.0, 1)
    assert lexicon.raw("the trash can is trash") == (3.0, 5)
    assert lexicon.raw("trashy below") == (0.0, 2)
    assert lexicon.raw("loweich lows") == (6.0, 2)  # the larger of two entries at one word
    assert lexicon.raw("") == (0.0, 0)
    again = toxicity.Lexicon.load(lexicon.dump())
    assert again.raw("the trash can is trash") == (3.0, 5)


def test_many_exceptions_take_time_in_proportion():
    lexicon = toxicity.Lexicon({"trash": 3.0}, ("trash can", "can trash can", "big trash"))
    took = []
    for n in (25_000, 100_000):
        text = "trash can trash big trash x " * n
        began = time.process_time()
        assert lexicon.raw(text) == (3.0 * n, 6 * n)
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 1


def labelled(n=400):
    rng = random.Random(4)
    words = ["".join(rng.choice("abdefgilnorst") for _ in range(rng.randint(2, 8))) for _ in range(600)]
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 7 == 0)
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["vileword", "V1leWord", "grobaffe" + rng.choice("xyz"), "grobaff3" + rng.choice("klm")]))
        docs.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_accuracy(spark, no_docs):
    docs, labels = labelled()
    docs_df, labels_df = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], LABELS)
    score = toxicity.learned_scorer(docs_df, labels_df)
    got = docs_df.select("doc_id", toxicity.held_out(docs_df["doc_id"]).alias("h"), score("text").alias("s")).collect()
    held = [(r["s"] >= 0.5, r["doc_id"] % 7 == 0) for r in got if r["h"]]
    assert len(held) > 40 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["s"] <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "vileword " * 30_000), (None, "vileword")], "doc_id long, text string")
    scores = {r["doc_id"]: r["s"] for r in odd.select("doc_id", score("text").alias("s")).collect()}
    assert scores[1] == scores[2] < 0.5 < scores[3]
    nothing = toxicity.learned_scorer(no_docs, spark.createDataFrame([], LABELS))
    assert [r["s"] for r in odd.select(nothing("text").alias("s")).collect()] == [0.0] * 4


def test_held_out_rows_are_not_learned_from(spark):
    docs, labels = labelled(100)
    rows = toxicity.training_rows(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert rows.count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(100))
    few = toxicity.training_rows(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), sample=5)
    assert few.groupBy("toxic").count().orderBy("toxic").collect() == [(0, 5), (1, 5)]


def test_a_smaller_sample_keeps_the_label_mix(spark):
    """A word of clean and toxic texts: its score follows the shares of all labelled rows, not of the sample."""
    rng = random.Random(6)
    docs = [(i, " ".join(["plain"] * 6 + ["weakword"] * (rng.random() < (0.8 if i % 10 == 0 else 0.06))), "en", "s", 0) for i in range(3000)]
    docs_df, labels_df = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i, *_ in docs], LABELS)
    scores = {}
    for sample in (200, 3000):
        rows = toxicity.training_rows(docs_df, labels_df, sample=sample)
        for label in (0, 1):
            usable = sum(zlib.crc32(str(i).encode()) % 5 != 0 and (i % 10 == 0) == label for i in range(3000))
            assert rows.filter(f"toxic = {label}").agg({"stands_for": "sum"}).first()[0] == pytest.approx(usable)
        lexicon = toxicity.learn(rows)
        assert lexicon.weights
        scores[sample] = [lexicon.score("plain " * 6), lexicon.score("plain " * 6 + "weakword")]
    assert scores[200] == pytest.approx(scores[3000], abs=0.12)
    assert scores[200][0] < 0.1


URLS = ["http://a.example.net/en/x", "https://EXAMPLE.net/en/", "http://example.net/en", "http://net/", "http://net", "http://x.net?a=/b", "HTTP://foo.org/fr/1?x#y",
        "http://forg/fr/", "http://m.example.com/de/a/b", "http://notexample.com/de/", "ftp://u@x.example.com:80/de/", "no scheme", "", None, "://", "a://b://c.net/", "http://cheap-pills.example.com/en/",
        "http://x.example.org/fr/#frag", "http://example.com#/de/", "http://..net/", "http://" + "a." * 2000 + "net/" + "p" * 5000, "http://ÉX.Example.NET/en/é"]


def plain_judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
        host, path = re.sub("[A-Z]", lambda x: x.group().lower(), m.group(1)), m.group(2)
    fit = [(len(h + p), h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    return host, path, None, "block" if set(host.split(".")) & set(url_rules.LISTED) else "allow"


def test_url_rules(spark):
    frame = spark.createDataFrame([(i, u, 1.0) for i, u in enumerate(URLS)], "page_id long, url string, id double")
    got = {r["id"]: tuple(r)[1:] for r in url_rules.judge(frame).collect()}
    assert got == {i: plain_judge(u) for i, u in enumerate(URLS)}
    assert {v[3] for v in got.values()} == {"allow", "block"}
    assert url_rules.judge(frame.limit(0)).count() == 0
    assert {r["rule"] for r in url_rules.judge(frame, rules=()).collect()} == {None}


def test_many_rules_and_listed_labels(spark):
    """10^5 entries in the array, urls that meet them and repeated rows."""
    rules = tuple((f"h{i}.site{i % 7}.net", f"/p{i % 5}/", "block" if i % 2 else "allow") for i in range(60_000))
    listed = tuple(f"bad{i}" for i in range(40_000))
    urls = [f"http://www.h{i}.site{i % 7}.net/p{(i + (i % 3 == 0)) % 5}/x" for i in range(0, 60_000, 601)] + [f"http://a.bad{i}.org/" for i in range(0, 50_000, 997)]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls + urls)], "page_id long, url string")
    got = {r["id"]: (r["rule"], r["verdict"]) for r in url_rules.judge(frame, rules, listed).collect()}
    for k, u in enumerate(urls + urls):
        host, path = (x.decode() for x in url_rules.parts(u.encode()))
        i = int(re.search(r"\d+", host).group())
        if "site" in host:
            want = (f"h{i}.site{i % 7}.net/p{i % 5}/", "block" if i % 2 else "allow") if i % 3 else (None, "allow")
        else:
            want = (None, "block" if i < 40_000 else "allow")
        assert got[k] == want


def test_a_long_url_takes_time_in_proportion(spark):
    url = "http://" + "a." * 50_000 + "x.example.net/en/"
    began = time.process_time()
    frame = spark.createDataFrame([(1, url)], "page_id long, url string")
    row = url_rules.judge(frame).first()
    assert (row["rule"], row["verdict"]) == ("example.net/en/", "allow") and time.process_time() - began < 5


def test_stored_strings_settle_collisions(tmp_path, monkeypatch):
    entries = [("block", f"host{i}.net/".encode()) for i in range(200)]
    monkeypatch.setattr(url_rules.xxhash, "xxh64_intdigest", lambda b: len(b))  # nearly all digests collide
    index = url_rules.Index(url_rules.write_index(str(tmp_path), entries))
    assert index.probe([b"host7.net/", b"host199.net/", b"h0st7.net/", b"x"]) == {0: "block", 1: "block"}
