"""Run registered queries against DuckDB and report differences."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.queries import ORACLES, QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(repr(_plain(row[i])) for i in order) for row in rows]), sorted(names)


def difference(spark, con, sf_dir: str, name: str) -> tuple[str | None, int]:
    """None if both engines agree on names, types of values and all values."""
    df = QUERIES[name](spark, sf_dir)
    mine, my_names = _rows(df.columns, [tuple(x) for x in df.collect()])
    if name not in ORACLES:
        return None, len(mine)
    rel = con.execute(ORACLES[name])
    theirs, their_names = _rows([c[0] for c in rel.description], rel.fetchall())
    if my_names != their_names:
        return f"columns {my_names} vs {their_names}", len(mine)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}", len(mine)
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ on {my_names}\n   spark {bad[0][0]}\n   duck  {bad[0][1]}", len(mine)
    return None, len(mine)


def main() -> None:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session("8"), connect(sf_dir)
    names = sys.argv[1:] or list(QUERIES)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem, n = difference(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001
            problem, n = "".join(traceback.format_exception_only(e))[:1500], -1
        failed += problem is not None
        tag = "OK  " if problem is None else "FAIL"
        note = "" if name in ORACLES else " (rows only)"
        print(f"{tag} {name:28s} rows={n:<7d} {time.time() - start:6.1f}s{note}{'' if problem is None else chr(10) + '   ' + problem}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
