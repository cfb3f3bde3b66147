"""Equal-width bins with exact floating-point edges, and order-keeping buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def edges(bins: int, low: float = 0.0, high: float = 1.0) -> list[float]:
    """Evenly spaced edges ``low + i * step``; the last one is exactly ``high``."""
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def bin_index(x: Column, bins: int, low: Column | float = 0.0, high: Column | float = 1.0) -> Column:
    """Zero-based bin of ``x``: ``[e_i, e_i+1)``, the last bin closed.

    Outside the range, and for null or NaN, the result is null.  Values are
    compared with the edges as they are in floating point: 0.3 lies below the
    fourth edge, which is 3 * 0.1.
    """
    x = x.cast("double")
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    # A division gives the bin up to one, the two edges next to it decide.
    step = (high - low) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return F.when(i >= bins, high).otherwise(low + i * step)

    guess = F.least(F.floor(F.try_divide(x - low, step)), F.lit(bins - 1))
    index = (
        guess
        - F.when(x < edge(guess), 1).otherwise(0)
        + F.when((x >= edge(guess + 1)) & (guess < bins - 1), 1).otherwise(0)
    )
    return F.when((x >= low) & (x <= high), index).cast("int")


# Coarse buckets per doubling of |x|: 64 between 1 and 2 as between 1e-6 and
# 2e-6, and about 270,000 over all doubles.
BUCKETS_PER_OCTAVE = 64
# Distinct values that a bucket of its own grid holds on average.
VALUES_PER_BUCKET = 256


def coarse_bucket(x: Column) -> Column:
    """A bucket that never decreases as ``x`` grows; its width is relative to ``x``.

    The map is fixed, so it needs no sampling, and a task that is run again
    puts each row into the same bucket.  Null has one below all others.
    """
    x = x.cast("double")
    # Doubles go from 2**-1074 to below 2**1024.
    octave = F.log2(F.abs(x)) + F.lit(1075.0)
    size = F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * F.least(octave, F.lit(2100.0)))
    return F.coalesce(F.floor(size * BUCKETS_PER_OCTAVE).cast("long"), F.lit(-(1 << 40)))


def own_bucket(x: Column, low: Column, high: Column, values: Column) -> Column:
    """A bucket of the even grid from ``low`` to ``high`` that ``values`` distinct values ask for."""
    parts = F.ceil(values / F.lit(VALUES_PER_BUCKET))
    # Halves first: the range of two large doubles may not be a double.
    place = F.try_divide(x / 2 - low / 2, high / 2 - low / 2)
    return F.coalesce(F.least(F.floor(place * parts), parts - 1), F.lit(0)).cast("long")
