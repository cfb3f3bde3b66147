"""Cleaning of dirty text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def strip_token(c: Column, token: str = "_") -> Column:
    """Remove every occurrence of ``token``."""
    return F.replace(c, F.lit(token), F.lit(""))


def null_if_in(c: Column, tokens: Sequence[str]) -> Column:
    """Literal sentinels become null; the tokens are not patterns."""
    return F.when(~c.isin(*tokens), c)


def keep_if_in(c: Column, allowed: Sequence[str]) -> Column:
    """Values outside the allowed list become null."""
    return F.when(c.isin(*allowed), c)


def keep_if_matches(c: Column, pattern: str) -> Column:
    return F.when(c.rlike(pattern), c)


def map_categories(
    c: Column, groups: dict[str, Sequence[str]], null_as: str, default: str
) -> Column:
    """Map each value to the name of the group that lists it."""
    out = F.when(c.isNull(), F.lit(null_as))
    for name, members in groups.items():
        out = out.when(c.isin(*members), F.lit(name))
    return out.otherwise(F.lit(default))


def non_numeric(c: Column) -> Column:
    """True for text that is present but is no number."""
    return c.isNotNull() & c.try_cast("double").isNull()
