"""Repeatable picks from short lists: a digest read as mixed-radix digits.

A value is a pure function of its seed text, so task retries, other partition
counts and other engines all draw the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 15  # hex digits per number: 60 bits fit a bigint


def digest_number(digest: Column, index: int = 0) -> Column:
    """The ``index``-th 60-bit number inside a hex digest."""
    return F.conv(F.substring(digest, 1 + index * DIGITS, DIGITS), 16, 10).cast("bigint")


def whole_div(number: Column, divisor: int) -> Column:
    return F.call_function("div", number, F.lit(divisor))


def digit_picks(number: Column, sizes: Sequence[int]) -> list[Column]:
    """One pick in ``0..size-1`` per size, each from its own digit of ``number``."""
    picks, used = [], 1
    for size in sizes:
        picks.append(whole_div(number, used) % size)
        used *= size
    return picks


def choose(items: Sequence[str], pick: Column) -> Column:
    return F.element_at(F.array(*[F.lit(item) for item in items]), (pick + 1).cast("int"))
