"""Number-to-text formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_text(value: Column, digits: int = 2) -> Column:
    """Plain fixed-point text without thousands separators."""
    return F.translate(F.format_number(value.cast("double"), digits), ",", "")


def comma_text(value: Column, digits: int = 0) -> Column:
    """Text with comma thousands separators, as on the console report."""
    return F.format_number(value.cast("double") if digits else value.cast("bigint"), digits)


def int_text(value: Column) -> Column:
    """Whole part with point thousands separators."""
    return F.translate(F.format_number(value.cast("bigint"), 0), ",", ".")


def brl_text(value: Column) -> Column:
    """Brazilian currency text: millions as "mi", thousands as "mil", else two digits."""
    amount = value.cast("double")
    size = F.abs(amount)

    def shortened(divisor: float, digits: int, unit: str) -> Column:
        return F.concat(F.lit("R$ "), F.translate(fixed_text(amount / divisor, digits), ".", ","), F.lit(unit))

    plain = F.concat(F.lit("R$ "), F.translate(F.format_number(amount, 2), ",.", ".,"))
    return (
        F.when(size >= 1_000_000, shortened(1_000_000.0, 2, " mi"))
        .when(size >= 1_000, shortened(1_000.0, 1, " mil"))
        .otherwise(plain)
    )
