"""Guards, ratios and lenient casts for numeric columns."""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, NumericType, StructType

EPSILON = 1e-10


def lenient_int(c: Column) -> Column:
    """Text to int through double, so "2.0" is 2; anything else is null."""
    return c.try_cast("double").try_cast("int")


def within(c: Column, low: float | None, high: float | None) -> Column:
    """Keep values inside the closed range, null the others."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (c >= F.lit(low))
    if high is not None:
        ok = ok & (c <= F.lit(high))
    return F.when(ok, c)


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator)


def percent_change(new: Column, base: Column) -> Column:
    """Relative change in percent; the epsilon keeps a zero base finite."""
    return (new - base) / (F.abs(base) + F.lit(EPSILON)) * F.lit(100.0)


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def is_missing(c: Column, dtype: DataType) -> Column:
    """Null, or NaN for floating columns."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def numeric_columns(schema: StructType, among: Sequence[str] | None = None) -> list[str]:
    """Names of the numeric columns, in the order of ``among`` if given."""
    numeric = [f.name for f in schema.fields if isinstance(f.dataType, NumericType)]
    if among is None:
        return numeric
    return [name for name in among if name in numeric]


def row_sum(cols: Sequence[Column]) -> Column:
    """Sum across a row; null if any part is null."""
    return reduce(lambda a, b: a + b, cols)


def row_nonzero(cols: Sequence[Column]) -> Column:
    """Number of non-zero values in a row; null counts as zero."""
    return row_sum([F.when(c != 0, 1).otherwise(0) for c in cols])
