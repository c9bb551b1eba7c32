"""Arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repotide.fixed import DIVISIBLE, DIVISOR, NOT_DIVISIBLE

INTEGER = r"^\s*[+-]?[0-9]+\s*$"


def is_odd(number: Column) -> Column:
    return number % 2 != 0


def divisible_label(number: Column, divisor: int = DIVISOR) -> Column:
    return F.when(number % divisor == 0, DIVISIBLE).otherwise(NOT_DIVISIBLE)


def ratio_or_zero(total: Column, count: Column) -> Column:
    """Quotient as a double, zero where the divisor is zero."""
    return F.coalesce(F.try_divide(total.cast("double"), count), F.lit(0.0))


def text_to_integer(text: Column) -> Column:
    """A whole number, blanks around it allowed, or null where the text is not one.

    The pattern goes first because a cast that fails raises and catches an exception per row,
    which costs far more than the match.
    """
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))
