"""URL filter over a sorted digest array.

Rules are (host, path, verdict).  An index file holds the 64-bit xxhash of each
rule's host and path in sorted order, and behind it the rules themselves.  Tasks
map the file into memory; it is made on the driver in the shared folder and holds
the given rules only.  For each url all rules that could fit (the host and its parents, with each
path length that rules have) are hashed and probed by one vectorised binary search a
batch; a hit counts only if the stored rule is equal, so colliding digests do no harm.

The index also holds host labels that are listed, as keys of a kind of their own: urls that fit no rule are
blocked if a label of their host is one of them, else allowed.

A rule fits its host and all subdomains if the url's path starts with the rule's;
the longest rule wins.  Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.  Null urls and urls without
``://`` have an empty host and path, fit no rule and have no label.

Of a host's parents only those with no more labels than the longest rule's host are keys, so a url takes time and
memory in proportion to its length.  Repeated rows are judged each; an empty table gives an empty result; columns
besides id and url are not read.
"""

from __future__ import annotations

import os
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, query, table
from tidemark.session import shared_dir

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Host labels that are blocked where no rule fits; a parameter of ``judge``, which takes any number.
LISTED = ("cheap-pills", "spam-farm")
#: In front of a label's key; no host begins so.
_LABEL = b"?"
MAGIC = b"TMURL001"


def write_index(root: str, entries: list[tuple[str, bytes]]) -> str:
    """Store (value, key) entries sorted by digest under ``root``; return the file's address.

    Layout: magic, number of entries, digests, offsets, then the entries, a value and a key with a tab between.
    """
    rows = sorted((xxhash.xxh64_intdigest(key), value.encode() + b"\t" + key) for value, key in dict((k, (v, k)) for v, k in entries).values())
    ends = np.cumsum([0] + [len(r) for _, r in rows]).astype("<u8")
    fs, path = pafs.FileSystem.from_uri(root if "://" in root else f"file://{os.path.abspath(root)}")
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/index.bin") as out:
        out.write(MAGIC + struct.pack("<Q", len(rows)))
        out.write(np.array([d for d, _ in rows], "<u8").tobytes() + ends.tobytes() + b"".join(r for _, r in rows))
    return f"{root if '://' in root else 'file://' + os.path.abspath(root)}/index.bin"


class Index:
    """An index file mapped into memory."""

    def __init__(self, address: str):
        fs, path = pafs.FileSystem.from_uri(address)
        if not isinstance(fs, pafs.LocalFileSystem):  # map a copy that goes with the process
            with fs.open_input_stream(path) as f, tempfile.NamedTemporaryFile(delete=False) as copy:
                copy.write(f.read())
            path = copy.name
        self.data = np.memmap(path, np.uint8, "r")
        if path != pafs.FileSystem.from_uri(address)[1]:
            os.unlink(path)  # the mapping keeps the bytes
        if self.data[:8].tobytes() != MAGIC:
            raise ValueError(f"not an index: {address}")
        n = struct.unpack("<Q", self.data[8:16].tobytes())[0]
        self.digests = self.data[16 : 16 + 8 * n].view("<u8")
        self.ends = self.data[16 + 8 * n : 24 + 16 * n].view("<u8").astype(np.int64) + 24 + 16 * n
        self.n = n

    def entry(self, k: int) -> tuple[str, bytes]:
        value, _, key = self.data[self.ends[k] : self.ends[k + 1]].tobytes().partition(b"\t")
        return value.decode(), key

    def probe(self, keys: list[bytes]) -> dict[int, str]:
        """Place of each key that is in the index, with its value."""
        if not self.n or not keys:
            return {}
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, digests)
        near = np.flatnonzero((at < self.n) & (self.digests[np.minimum(at, self.n - 1)] == digests))
        out: dict[int, str] = {}
        for i in near.tolist():
            k = int(at[i])
            while k < self.n and self.digests[k] == digests[i]:  # entries that share a digest stand together
                value, key = self.entry(k)
                if key == keys[i]:
                    out[i] = value
                    break
                k += 1
        return out


def parts(url: bytes) -> tuple[bytes, bytes]:
    """Host and path of a url."""
    _, found, rest = url.partition(b"://")
    if not found:
        return b"", b""
    end = min((k for k in (rest.find(b"/"), rest.find(b"?"), rest.find(b"#")) if k >= 0), default=len(rest))
    path = rest[end:]
    cut = min((k for k in (path.find(b"?"), path.find(b"#")) if k >= 0), default=len(path))
    return rest[:end].lower(), path[:cut]


def _judge(address: str, lengths: list[int], most_labels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(address)
        for batch in batches:
            split = [parts(u) for u in as_bytes(batch.column("url"))]
            keys, owner = [], []
            for row, (host, path) in enumerate(split):
                labels = host.split(b".") if host else []
                own = [_LABEL + x for x in set(labels)]
                for k in range(1, min(most_labels, len(labels)) + 1):
                    parent = b".".join(labels[-k:])
                    own += [parent + path[:n] for n in lengths if n <= len(path)]
                keys += own
                owner += [row] * len(own)
            best: dict[int, tuple[int, bytes, str]] = {}
            listed = set()
            for i, verdict in index.probe(keys).items():
                if keys[i].startswith(_LABEL):
                    listed.add(owner[i])
                    continue
                mine = (len(keys[i]), keys[i], verdict)
                if owner[i] not in best or mine > best[owner[i]]:
                    best[owner[i]] = mine
            rules = [best[row][1].decode() if row in best else None for row in range(len(split))]
            verdicts = [best[row][2] if row in best else "block" if row in listed else "allow" for row in range(len(split))]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "host": pa.array([h.decode() for h, _ in split], pa.string()),
                "path": pa.array([p.decode() for _, p in split], pa.string()),
                "rule": pa.array(rules, pa.string()), "verdict": pa.array(verdicts, pa.string())})

    return run


def judge(df: DataFrame, rules=RULES, listed: tuple[str, ...] = LISTED, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule and verdict of every row."""
    spark: SparkSession = df.sparkSession
    entries = [(v, h.encode() + p.encode()) for h, p, v in rules] + [("block", _LABEL + x.encode()) for x in listed]
    address = write_index(shared_dir(spark, "url-rules"), entries)
    lengths = sorted({len(p.encode()) for _, p, _ in rules})
    most_labels = max((h.count(".") + 1 for h, _, _ in rules), default=0)
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url")).mapInArrow(
        _judge(address, lengths, most_labels), "id long, host string, path string, rule string, verdict string")


@query("op8_url_filter", r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(h, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT page_id, max_by(h || rp, length(h || rp)) AS rule, max_by(v, length(h || rp)) AS v
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rp) GROUP BY page_id)
SELECT p.page_id, host, path, rule,
       coalesce(v, CASE WHEN list_has_any(string_split(host, '.'), ['cheap-pills', 'spam-farm']) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m USING (page_id)""")
def op8_url_filter(spark, sf_dir):
    """Host, path, rule and verdict of every page."""
    return judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
