"""Turning numbers into named bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def band_below(c: Column, cuts: Sequence[tuple[float, object]], default: object) -> Column:
    """First band whose upper cut lies above the value; null takes the default."""
    out = None
    for cut, name in cuts:
        test = c < F.lit(cut)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out.otherwise(F.lit(default))


def band_above(c: Column, cuts: Sequence[tuple[float, object]], default: object) -> Column:
    """First band whose lower cut lies below the value; null takes the default."""
    out = None
    for cut, name in cuts:
        test = c > F.lit(cut)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out.otherwise(F.lit(default))


def band_right_closed(c: Column, edges: Sequence[float], names: Sequence[str]) -> Column:
    """Bands ``(e0, e1], (e1, e2], ...``; outside all of them the result is null."""
    x = c.cast("double")
    out = None
    for low, high, name in zip(edges, edges[1:], names):
        test = (x > F.lit(low)) & (x <= F.lit(high))
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out


def drift_status(psi: Column, moderate: float = 0.1, significant: float = 0.2) -> Column:
    return (
        F.when(psi < moderate, "stable")
        .when(psi < significant, "moderate")
        .when(psi >= significant, "significant")
    )


def comparison_status(current: Column, reference: Column, margin: float = 0.01) -> Column:
    """better / similar / degraded against a reference value."""
    return (
        F.when(current > reference + margin, "better")
        .when(F.abs(current - reference) <= margin, "similar")
        .when(current.isNotNull() & reference.isNotNull(), "degraded")
    )
