"""Aggregate measures shared by batch and streaming plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def flagged(flag: str) -> Column:
    """Rows with the flag set. A NULL flag does not count."""
    return F.count_if(F.col(flag))


def rate(flag: str) -> Column:
    """Share of rows with the flag set, 0 to 1. A NULL flag stays in the denominator."""
    return flagged(flag) / row_count()


def distinct(column: str, exact: bool) -> Column:
    """Distinct non-NULL values; streams can only keep the approximate form."""
    return F.count_distinct(F.col(column)) if exact else F.approx_count_distinct(F.col(column))


def rounded_quotient(numerator: str, denominator: str, factor: int = 1) -> Column:
    """``factor * numerator / denominator`` at two decimals, halves away from zero.

    Both arguments name whole-number columns. Rounding is done on whole numbers,
    so it does not depend on how a double happens to represent the quotient.
    """
    return F.expr(
        f"sign({numerator})"
        f" * ((abs({numerator}) * {200 * factor}L + {denominator}) div nullif(2L * {denominator}, 0L))"
        " / 100"
    )


def percentage(part: str, whole: str) -> Column:
    return rounded_quotient(part, whole, factor=100)
