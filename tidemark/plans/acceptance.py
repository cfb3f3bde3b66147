"""Acceptance of a feature store: null rates, bounds and sanity of its columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import profile
from tidemark.plans import rules


def accept(
    store: DataFrame,
    nulls: Mapping[str, tuple[float, float]] = rules.ACCEPTED_NULLS,
    bounds: Mapping[str, tuple[float, float]] = rules.ACCEPTED_BOUNDS,
    sanity: Mapping[str, tuple[float, float]] = rules.SANITY_BOUNDS,
) -> DataFrame:
    """``(check, column_name, measure, status)``, a row per check and column.

    The measure is the null rate in percent, or the number of values outside
    the bounds.  A column that the store lacks is NOT FOUND; sanity checks pass over it.
    """
    def outside(name: str, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
        return profile.bounds_check(store, limits).select(
            F.lit(name).alias("check"), "column_name", F.col("outside_bounds").cast("double").alias("measure"), "status")

    there = [c for c in nulls if c in store.columns]
    total = F.nullif(F.count("*"), F.lit(0))
    rates = store.agg(*[(F.count_if(F.col(c).isNull()) / total * 100).alias(c) for c in there] or [F.lit(0).alias("none")])
    parts = []
    for c, (accepted, failed) in nulls.items():
        rate = F.col(c) if c in there else F.lit(None).cast("double")
        status = (
            F.when(rate < accepted, "PASS").when(rate >= failed, "FAIL").otherwise("PARTIAL") if c in there else F.lit("NOT FOUND")
        )
        parts.append(rates.select(F.lit("null_rate").alias("check"), F.lit(c).alias("column_name"), rate.alias("measure"), status.alias("status")))
    parts.append(outside("bounds", bounds))
    parts.append(outside("sanity", {c: b for c, b in sanity.items() if c in store.columns}))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
