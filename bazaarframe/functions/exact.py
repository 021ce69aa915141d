"""Averages, ratios and durations computed on whole numbers.

Decimal division in Spark keeps a limited scale and rounds once more when the result is rounded to
cents, so an average that lies on half a cent can come out one cent off. Here the quotient is formed
by integer division on ``decimal(38,0)``: one rounding, half away from zero, whatever the order in
which partial sums arrive from the executors.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_SCALE = 16  # digits kept of an order's mean review score
MICROS_PER_DAY = 86_400_000_000


def _whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def divide_half_up(numerator: Column, denominator: Column, shift: int = 0) -> Column:
    """``numerator / denominator * 10**shift`` as a whole number, half away from zero.

    Both inputs hold whole numbers; a zero denominator gives NULL.
    """
    n, d = _whole(numerator), _whole(denominator)
    top = F.abs(n) * (10**shift) if shift > 0 else F.abs(n)
    base = F.abs(d) * F.lit(10**-shift).cast("decimal(38,0)") if shift < 0 else F.abs(d)
    quotient = F.call_function("div", top * 2 + base, F.nullif(base * 2, F.lit(0)))
    return F.when((n < 0) != (d < 0), -quotient).otherwise(quotient)


def _scaled(whole: Column, scale: int) -> Column:
    """Read a whole number of 10**-scale units as a decimal."""
    unit = F.lit(Decimal(1).scaleb(-scale))
    return (whole.cast("decimal(19,0)") * unit).cast(f"decimal(21,{scale})")


def unscaled(value: Column, scale: int) -> Column:
    """A decimal of the given scale as a whole number of 10**-scale units."""
    return (value * F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast("decimal(38,0)")


def exact_avg(total: Column, count: Column, total_scale: int = 2, scale: int = 2) -> Column:
    """``total / count`` rounded to ``scale`` digits; NULL for no rows."""
    return _scaled(divide_half_up(unscaled(total, total_scale), count, scale - total_scale), scale)


def exact_pct(part: Column, whole: Column, part_scale: int = 0, scale: int = 2) -> Column:
    """``100 * part / whole`` rounded to ``scale`` digits; NULL for a zero whole.

    ``part_scale`` is the common decimal scale of both inputs (0 for counts, 2 for money).
    """
    return _scaled(divide_half_up(unscaled(part, part_scale), unscaled(whole, part_scale), scale + 2), scale)


def mean_score(score: Column) -> Column:
    """Aggregate: mean of integer scores kept to 16 digits, NULL when there is none.

    A fixed scale makes the later mean of these means independent of summation order.
    """
    total = F.sum(score).cast("decimal(20,0)")
    count = F.nullif(F.count(score).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (total / count).cast(f"decimal(27,{SCORE_SCALE})")


def duration_micros(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end``, both timestamps without zone.

    Built from the interval's parts: ``timestampdiff`` would first move both sides into the session
    zone and lose or gain an hour at daylight-saving changes.
    """
    gap = end - start

    def part(name: str) -> Column:
        return F.extract(F.lit(name), gap)

    seconds = part("DAY").cast("bigint") * 86_400 + part("HOUR") * 3_600 + part("MINUTE") * 60
    return seconds * 1_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def duration_days(start: Column, end: Column) -> Column:
    """Elapsed days as a double, fractions included."""
    return duration_micros(start, end) / F.lit(float(MICROS_PER_DAY))
