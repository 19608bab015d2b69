"""Words, lines and hashes of whole texts, as column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLANKS = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lower_ascii(text: Column) -> Column:
    """Only A-Z change; `lower` would follow the locale's rules for other letters."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, blanks: str = BLANKS) -> Column:
    """What stands between blanks; a null text has no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), blanks), lambda w: w != "")


def tail(array: Column, skip: int) -> Column:
    """The array without its first `skip` elements."""
    return F.slice(array, F.lit(skip + 1), F.greatest(F.size(array) - skip, F.lit(0)))


def head(array: Column, skip: int) -> Column:
    """The array without its last `skip` elements."""
    return F.slice(array, F.lit(1), F.greatest(F.size(array) - skip, F.lit(0)))


def adjacent(array: Column, step: int) -> Column:
    """One 64-bit hash for each pair of elements `step` apart, in order.

    `array` should be a column of its own: it is read twice.
    """
    return F.zip_with(head(array, step), tail(array, step), lambda a, b: F.xxhash64(a, b))


def once(value: Column) -> Column:
    """The same value, which the optimizer neither copies into filters nor computes again.

    A condition on a column is otherwise moved below the projection that makes it, and with it
    everything the column is computed from, once for each time it is named there.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def with_shingles(df: DataFrame, words_column: str, n: int, name: str) -> DataFrame:
    """Add the distinct n-word shingles of a word array as 64-bit hashes.

    Fewer than n words, but at least one, make one shingle of the whole sequence; no words
    make an empty set. Hashes of n words come from hashes of fewer, so that each step reads
    two neighbours only.
    """
    steps, width = [], 1
    while width * 2 <= n:
        steps.append(width)
        width *= 2
    if n - width:
        steps.append(n - width)  # the last two runs may overlap, which fixes all n words too
    out = df.withColumn(name, F.transform(words_column, lambda w: F.xxhash64(w)))
    for step in steps:
        out = out.withColumn(name, adjacent(F.col(name), step))
    whole = F.array(F.xxhash64(F.lit("whole"), F.concat_ws(" ", words_column)))
    size = F.size(words_column)
    found = F.when(size >= n, F.array_distinct(name)).when(size > 0, whole)
    return out.withColumn(name, once(found.otherwise(F.array().cast("array<bigint>"))))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that arrays of a worker stay small whatever the texts' lengths are together."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
