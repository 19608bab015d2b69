"""Ordered work without a single-task sort.

A running total over one large group would put the whole group into one task. Here the
rows are cut into contiguous slices by a range partitioning over unique keys, each slice
is summed on its own, and the slice totals (one row per slice and group) give every slice
its starting point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.storage import materialize

SLICE = "_slice"


def ordered_slices(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Add `_slice`: every row of slice i sorts before every row of slice i + 1.

    The sorted columns must identify a row, so that no slice can be larger than its share.
    The result is written out: slice numbers have to be the same each time they are read.
    """
    return materialize(
        df.repartitionByRange(*order).withColumn(SLICE, F.spark_partition_id()), label
    )


def running_total(
    df: DataFrame, group: str, order: list[Column], amount: Column, name: str, label: str
) -> DataFrame:
    """Sum of `amount` over all earlier rows of the group, the row itself not included."""
    earlier = (Window.unboundedPreceding, -1)
    sliced = ordered_slices(df, [F.col(group).asc(), *order], label)
    starts = (
        sliced.groupBy(group, SLICE)
        .agg(F.sum(amount).alias("_total"))
        .select(
            group,
            SLICE,
            F.coalesce(
                F.sum("_total").over(Window.partitionBy(group).orderBy(SLICE).rowsBetween(*earlier)),
                F.lit(0),
            ).alias("_start"),
        )
    )
    inside = F.coalesce(
        F.sum(amount).over(
            Window.partitionBy(group, SLICE).orderBy(*order).rowsBetween(*earlier)
        ),
        F.lit(0),
    )
    return (
        sliced.withColumn("_inside", inside)
        .join(F.broadcast(starts), [group, SLICE])  # at most slices + groups rows
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop(SLICE, "_start", "_inside")
    )


def first_rows(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The `rows` rows with the smallest unique keys, for limits too large for one task.

    Only the key column is sorted, slice by slice, to find the last key wanted; the frame
    itself is filtered by that key, and the filter reaches the Parquet scan.
    """
    if rows <= 0:
        return df.limit(0)
    sliced = ordered_slices(df.select(key), [F.col(key).asc()], "first-rows")
    sizes = sliced.groupBy(SLICE).count().orderBy(SLICE).collect()  # one row per slice
    before = 0
    for size in sizes:
        if before + size["count"] >= rows:
            inside = Window.partitionBy(SLICE).orderBy(key)
            nth = (
                sliced.where(F.col(SLICE) == size[SLICE])
                .withColumn("_nth", F.row_number().over(inside))
                .where(F.col("_nth") == rows - before)
                .first()
            )
            return df.where(F.col(key) <= F.lit(nth[key]))
        before += size["count"]
    return df
