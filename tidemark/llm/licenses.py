"""Licence scan: notice phrases, identifier tags and licence expressions.

Text is lower-cased (A-Z) and cut into words of ASCII letters and digits and all
characters beyond ASCII.  One Aho-Corasick automaton finds all phrases in the
words; overlapping places all count, but a notice inside a longer one does not.  Where it finds the words of the identifier tag, the
expression behind them, up to the next tag or the end of the line, is read from the text and a
shunting-yard parser evaluates its longest whole beginning: ``with`` binds a licence to its exception, ``and`` asks for both
sides, ``or`` for one.  Only known identifiers, members of known families and ``LicenseRef-`` names are
licences; a tag without any is no finding.  Broken expressions give their licences as labels and no value.

Null and empty texts have no words, no labels and score 0.  The score is the chance that at least
one finding is a licence, from a fixed strength for each kind of finding.  A text takes time in proportion to its
length; an empty table gives an empty result; columns besides id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, pieces, query, table

#: Phrases whose places are counted, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further phrases, with their labels.
NOTICES = {
    "lesser general public license": "lgpl", "affero general public license": "agpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc", "creative commons": "cc", "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0", "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved", "permission is hereby granted free of charge": "mit",
}
TAG = "spdx license identifier"
#: Families of identifiers, with labels and whether anyone may use the text freely.
FAMILIES = {
    "mit": ("mit", True), "apache": ("apache", True), "bsd": ("bsd", True), "isc": ("isc", True), "unlicense": ("public-domain", True),
    "cc0": ("cc0", True), "cc-by-nc-sa": ("cc-by-nc-sa", False), "cc-by-nc-nd": ("cc-by-nc-nd", False), "cc-by-nc": ("cc-by-nc", False),
    "cc-by-nd": ("cc-by-nd", False), "cc-by-sa": ("cc-by-sa", True), "cc-by": ("cc-by", True),
    "gpl": ("gpl", False), "lgpl": ("lgpl", False), "agpl": ("agpl", False), "mpl": ("mpl", True), "epl": ("epl", True),
}
# Further identifiers of the public licence list, in lower case; each is its own label.
IDENTIFIERS = frozenset("""
0bsd afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 aladdin amdplpa aml antlr-pd apl-1.0 app-s2p apsl-1.0 apsl-1.1 apsl-1.2 apsl-2.0
artistic-1.0 artistic-1.0-perl artistic-2.0 beerware bittorrent-1.0 blessing blueoak-1.0.0 bsl-1.0 bzip2-1.0.6 cal-1.0 caldera
cddl-1.0 cddl-1.1 cdla-permissive-1.0 cdla-permissive-2.0 cdla-sharing-1.0 cecill-1.0 cecill-2.0 cecill-2.1 cecill-b cecill-c
clartistic cnri-python cpal-1.0 cpl-1.0 cpol-1.02 curl doc ecl-1.0 ecl-2.0 efl-1.0 efl-2.0 elastic-2.0 entessa eudatagrid
eupl-1.0 eupl-1.1 eupl-1.2 fair ftl gfdl-1.1 gfdl-1.2 gfdl-1.3 hpnd icu ijg imagemagick intel ipa ipl-1.0 jasper-2.0 json
latex2e libpng libpng-2.0 libtiff lpl-1.0 lpl-1.02 lppl-1.0 lppl-1.1 lppl-1.2 lppl-1.3a lppl-1.3c miros mitnfa motosoto
ms-pl ms-rl mulanpsl-1.0 mulanpsl-2.0 multics naumen ncsa netcdf ngpl nokia nosl npl-1.0 npl-1.1 ntp oclc-2.0 odbl-1.0
odc-by-1.0 ofl-1.0 ofl-1.1 ogl-uk-3.0 oldap-2.8 openssl osl-1.0 osl-2.0 osl-2.1 osl-3.0 pddl-1.0 php-3.0 php-3.01 postgresql
psf-2.0 python-2.0 qpl-1.0 rpl-1.1 rpl-1.5 rpsl-1.0 rscpl ruby sgi-b-2.0 simpl-2.0 sissl sleepycat spencer-94 spl-1.0
sspl-1.0 sugarcrm-1.1.3 tcl ucl-1.0 unicode-3.0 unicode-dfs-2016 upl-1.0 vim vsl-1.0 w3c watcom-1.0 wtfpl x11 xfree86-1.1
xnet zend-2.0 zlib zlib-acknowledgement zpl-1.1 zpl-2.0 zpl-2.1
""".split())
OWN_NAMES = "licenseref-"
STRENGTH = {"base": 0.9, "notice": 0.7, "tag": 0.99}

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
_BEHIND_TAG = re.compile(r"[^a-z0-9(\n]*")
_TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}


_MEMBER = re.compile("(" + "|".join(sorted(map(re.escape, FAMILIES), key=len, reverse=True)) + r")(?![a-z])(?!v(?!\d))|(" + "|".join(
    sorted(map(re.escape, FAMILIES), key=len, reverse=True)) + r")(?=v\d)")


def family(identifier: str) -> tuple[str, bool | None] | None:
    """Label of a licence identifier and whether it is permissive (None: unknown); None for a word that is no licence."""
    member = _MEMBER.match(identifier)
    if member:
        return FAMILIES[member.group(1) or member.group(2)]
    name = identifier.rstrip("+.")
    return (name, None) if name in IDENTIFIERS or name.startswith(OWN_NAMES) else None


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting yard: the longest beginning that is a whole expression in postfix order, or None if there is none."""
    out: list[str] = []
    stack: list[str] = []
    depth = 0  # open brackets
    operand = False  # whether the last thing read was a complete operand
    whole: tuple[int, list[str]] | None = None  # length of ``out`` and operators left (three at most) where it was last complete
    for t in tokens:
        if t == "(":
            if operand:
                break
            stack.append(t)
            depth += 1
        elif t == ")":
            if not operand or not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif t in _BINDS:
            if not operand:
                break
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = False
        else:
            if operand:
                break
            out.append(t)
            operand = True
        if operand and not depth:
            whole = len(out), stack[::-1]
    return None if whole is None else out[: whole[0]] + whole[1]


def _either(a: bool | None, b: bool | None) -> bool | None:
    return True if a or b else None if a is None or b is None else False


def _both(a: bool | None, b: bool | None) -> bool | None:
    return False if a is False or b is False else None if a is None or b is None else True


def evaluate(expression: str) -> tuple[set[str], bool | None]:
    """Labels of an expression (lower case), and whether it lets anyone use the text freely."""
    tokens = _TOKEN.findall(expression)
    postfix = to_postfix(tokens)  # prose may follow on the line
    if postfix is None:
        return {found[0] for t in tokens if t not in _BINDS and t not in "()" and (found := family(t))}, None
    stack: list[tuple[set[str], bool | None]] = []
    for t in postfix:
        if t not in _BINDS:
            found = family(t)
            stack.append(({found[0]}, found[1]) if found else (set(), None))
            continue
        (right, right_free), (left, left_free) = stack.pop(), stack.pop()
        if t == "with":  # the exception adds leave, it is no licence of its own
            stack.append((left, left_free))
            continue
        small, large = sorted((left, right), key=len)
        large |= small
        stack.append((large, (_either if t == "or" else _both)(left_free, right_free)))
    return stack[0]


@dataclass
class Found:
    n_words: int = 0
    n_base: int = 0
    first_word: int | None = None
    last_word: int | None = None
    base_labels: set[str] = field(default_factory=set)
    labels: set[str] = field(default_factory=set)
    expressions: list[str] = field(default_factory=list)
    permissive: bool | None = None
    score: float = 0.0


class Scanner:
    """Finds licences in UTF-8 texts."""

    def __init__(self, base: dict[str, str] | None = None, notices: dict[str, str] | None = None):
        self.find = ahocorasick.Automaton()
        for kind, phrases in (("notice", NOTICES if notices is None else notices), ("base", BASE if base is None else base), ("tag", {TAG: ""})):
            for phrase, label in phrases.items():
                self.find.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
        self.find.make_automaton()

    def scan(self, text: bytes) -> Found:
        split = text.translate(_TO_WORDS).split(b" ")
        inside = b" ".join([w for w in split if w]).decode()
        words = f" {inside} "
        out = Found(n_words=words.count(" ") - 1 if inside else 0)
        low = high = None
        kinds, tags, notices = set(), [], []
        for end, (kind, label, size) in self.find.iter(words):
            at = end - size + 1
            if kind == "base":
                kinds.add((kind, label))
                out.n_base += 1
                out.base_labels.add(label)
                low, high = at if low is None else min(low, at), at if high is None else max(high, at)
            elif kind == "notice":
                notices.append((at, -end, label))
            else:
                tags.append(at)
        covered = -1
        for at, end, label in sorted(notices):  # a notice inside a longer one says nothing of its own
            if -end > covered:
                kinds.add(("notice", label))
                out.labels.add(label)
                covered = -end
        if low is not None:
            out.first_word, out.last_word = words.count(" ", 0, low), words.count(" ", 0, high)
        out.labels |= out.base_labels
        if tags:
            lower = _lower(text)
            values = []
            spans = self._tag_spans(words, sorted(tags), lower)
            for (_, begin), (stop, _) in zip(spans, [*spans[1:], (len(lower), None)]):
                begin = _BEHIND_TAG.match(lower, begin, stop).end()
                line_end = lower.find("\n", begin, stop)
                expression = lower[begin : stop if line_end < 0 else line_end]
                labels, free = evaluate(expression)
                if labels:
                    kinds.add(("tag", ""))
                    out.labels |= labels
                    out.expressions.append(expression.strip())
                    values.append(free)
            for free in values:
                out.permissive = free if out.permissive is None else _both(out.permissive, free)
        miss = 1.0
        for kind, _ in sorted(kinds):
            miss *= 1.0 - STRENGTH[kind]
        out.score = round(1.0 - miss, 9)
        return out


    @staticmethod
    def _tag_spans(words: str, tags: list[int], lower: str) -> list[tuple[int, int]]:
        """Where the tags, given by their places in ``words``, stand in the text."""
        spans, number, at = [], 0, 0
        found = _WORD.finditer(lower)
        seen = -1
        size = TAG.count(" ")
        for tag in tags:
            number, at = number + words.count(" ", at, tag), tag
            while seen < number:
                word, seen = next(found), seen + 1
            begin = word.start()
            last = re.compile(r"(?:[a-z0-9]+[^a-z0-9\x80-\U0010ffff]+){%d}[a-z0-9]+" % size).match(lower, begin)
            spans.append((begin, last.end()))
        return spans


_A_TO_Z = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _lower(text: bytes) -> str:
    return text.translate(_A_TO_Z).decode()


_SCHEMA = ("id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
           "expressions array<string>, permissive boolean")


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for piece in pieces(batches):
        found = [scanner.scan(t) for t in as_bytes(piece.column("text"))]
        joined = lambda labels: ",".join(sorted(labels))
        yield pa.RecordBatch.from_pydict({
            "id": piece.column("id"),
            **{c: pa.array([getattr(f, c) for f in found], pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")},
            "base_labels": pa.array([joined(f.base_labels) for f in found], pa.string()), "labels": pa.array([joined(f.labels) for f in found], pa.string()),
            "score": pa.array([f.score for f in found], pa.float64()), "expressions": pa.array([f.expressions for f in found], pa.list_(pa.string())),
            "permissive": pa.array([f.permissive for f in found], pa.bool_())})


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, permissive of every row."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_scan_batches, _SCHEMA)


@query("op6_license_scan")
def op6_license_scan(spark, sf_dir):
    """Licences of every document."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").withColumn("expressions", F.array_join("expressions", "; "))
