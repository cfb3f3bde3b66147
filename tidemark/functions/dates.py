"""Calendar arithmetic on snapshot dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_of(c: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(c.cast("date"), "MM")


def week_of(c: Column) -> Column:
    """Monday of the week as a date."""
    return F.trunc(c.cast("date"), "week")


def month_number(c: Column) -> Column:
    """Months on one continuous count, so differences are calendar months."""
    return F.year(c) * 12 + F.month(c)


def month_gap(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later``, days ignored."""
    return month_number(later) - month_number(earlier)


def span_in_months(c: Column) -> Column:
    """Months in text such as "22 Years and 9 Months".

    Both parts must be present, otherwise the result is null.
    """
    years = F.regexp_extract(c, r"(\d+) Years", 1).try_cast("int")
    months = F.regexp_extract(c, r"(\d+) Months", 1).try_cast("int")
    return years * 12 + months
