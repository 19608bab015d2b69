"""Statistics of continuous columns: moments in one pass, exact quantiles without a hot task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.ordering import running_total


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(col, mean, std)` with the sample standard deviation, in one aggregate of one row."""
    stats = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
    )
    return stats.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("col"),
                        F.col(f"{c}_mean").cast("double").alias("mean"),
                        F.col(f"{c}_std").cast("double").alias("std"),
                    )
                    for c in columns
                ]
            )
        )
    )


def moments_by_position(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(col, pos, mean, std)` of array columns, position by position from 0; null elements do not count.

    Vectors are taken apart inside the task and added up there, so what is shuffled is one row
    per task and position.
    """
    parts = None
    for c in columns:
        each = df.select(F.lit(c).alias("col"), F.posexplode(c).alias("pos", "v"))
        each = each.groupBy("col", "pos").agg(
            F.avg(F.col("v").cast("double")).alias("mean"), F.stddev_samp(F.col("v").cast("double")).alias("std")
        )
        parts = each if parts is None else parts.unionByName(each)
    return parts


def quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """`(col, share, value)`: exact quantiles, linearly interpolated.

    Equal values are counted before anything is ordered, so a value that fills a third of
    the rows is one row here; the ordered part runs in slices over distinct values.
    """
    counts = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], columns, "col", "value")
        .where(F.col("value").isNotNull())
        .groupBy("col", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = running_total(
        counts, "col", [F.col("value").asc()], F.col("n"), "before", "quantiles"
    )
    totals = placed.groupBy("col").agg(F.sum("n").alias("total"))
    last = F.col("before") + F.col("n") - 1
    at = {i: F.lit(float(s)) * (F.col("total") - 1) for i, s in enumerate(shares)}
    picked = (
        placed.join(F.broadcast(totals), "col")  # one row per column name
        .groupBy("col")
        .agg(
            *[F.min(F.when(last >= F.floor(p), F.col("value"))).alias(f"lo{i}") for i, p in at.items()],
            *[F.min(F.when(last >= F.ceil(p), F.col("value"))).alias(f"hi{i}") for i, p in at.items()],
            F.max("total").alias("total"),
        )
    )
    rows = [
        F.struct(
            F.lit(float(s)).alias("share"),
            (
                F.col(f"lo{i}")
                + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (at[i] - F.floor(at[i]))
            ).alias("value"),
        )
        for i, s in enumerate(shares)
    ]
    return picked.select("col", F.inline(F.array(*rows)))
