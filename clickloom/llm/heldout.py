"""The rows that no model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def held_out(key: str) -> Column:
    """crc32 of the key as text, modulo 4, is 2. A null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
