"""Column expressions. All native, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def hex_to_int32(text: Column) -> Column:
    """32-bit hex text to a signed int; null for null, empty or malformed text."""
    unsigned = F.conv(text, 16, 10).cast("bigint")
    signed = F.shiftright(F.shiftleft(unsigned, 32), 32)  # carries bit 31 into the sign
    return F.when(text.rlike("^[0-9a-fA-F]{1,8}$"), signed).cast("int")


def to_int32(value: Column) -> Column:
    """Cast to int, null when the value does not fit or does not parse."""
    return value.try_cast("int")


def fill_missing(value: Column, constant=0) -> Column:
    return F.coalesce(value, F.lit(constant))


def clip(value: Column, low=None, high=None) -> Column:
    """Bound a column; null stays null."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def normalize(value: Column, mean: float | None, std: float | None) -> Column:
    """Centre on `mean` and scale by `std`; only centre when there is no spread."""
    centred = value.cast("double") - F.lit(float(mean or 0.0))
    return centred / F.lit(float(std)) if std else centred


def missing_flag(value: Column) -> Column:
    return value.isNull().cast("int")


def bucketize(value: Column, edges: Sequence[float]) -> Column:
    """Number of sorted edges at or below the value: 0 .. len(edges); null stays null."""
    passed = [F.when(value >= F.lit(e), 1).otherwise(0) for e in sorted(edges)]
    return F.when(value.isNotNull(), reduce(lambda a, b: a + b, passed, F.lit(0)))


def date_parts(moment: Column, prefix: str) -> list[Column]:
    """Day of week (Sunday = 1), month and day of month."""
    return [
        F.dayofweek(moment).alias(f"{prefix}_dayofweek"),
        F.month(moment).alias(f"{prefix}_month"),
        F.dayofmonth(moment).alias(f"{prefix}_dayofmonth"),
    ]


def cross(columns: Sequence[Column], separator: str = "_") -> Column:
    """One text value out of several; null when any part is null."""
    present = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.when(present, F.concat_ws(separator, *[c.cast("string") for c in columns]))


def log1p(value: Column) -> Column:
    return F.log1p(value)


def one_hot(value: Column, categories: Sequence, prefix: str) -> list[Column]:
    """One 0/1 column per category; null and unknown values give all zeros."""
    return [
        F.when(value == F.lit(k), 1).otherwise(0).alias(f"{prefix}_{k}") for k in categories
    ]


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))
