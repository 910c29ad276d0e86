"""No-data rules. NaN never enters the engine: no data is NULL, and each rule says what NULL does."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(x: Column, no_data: float | None = None, floor: float = -1e30) -> Column:
    """NULL for NaN, infinities, values of ``floor`` or less, and the declared no-data value."""
    bad = F.isnan(x) | (x <= floor) | (x == float("inf"))
    return F.when(~(bad if no_data is None else bad | (x == no_data)), x)


def or_zero(condition: Column, x: Column) -> Column:
    """``x`` where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, x).otherwise(F.lit(0.0))


def positive_part(x: Column) -> Column:
    """max(x, 0); unknown stays unknown."""
    return F.when(x > 0, x).when(x.isNotNull(), F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def look_up(code: Column, values: Mapping[int, float | int], default: float | int | None = 0) -> Column:
    """The value of a small non-negative integer code; ``default`` for unknown and unlisted codes.

    One indexing of a literal array: the code appears once in the plan, however it is computed. The array is one text for
    the parser, as a call for each of its entries takes the driver seconds.
    """
    suffix = "D" if any(isinstance(v, float) for v in values.values()) else ""
    entries = (values.get(i) for i in range(max(values) + 1))
    table = F.expr("array(" + ", ".join("NULL" if v is None else f"{v!r}{suffix}" for v in entries) + ")")
    found = F.get(table, code)
    return found if default is None else F.coalesce(found, F.lit(default))


def in_ranges(code: Column, ranges: list[tuple[int, int, int]], default: int = 0) -> Column:
    """Class of a code by inclusive ranges; ``default`` for unknown and unlisted codes."""
    return look_up(code, {i: value for first, last, value in ranges for i in range(first, last + 1)}, default)
