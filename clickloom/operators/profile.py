"""Looking at a split: counts, label shares, summary statistics and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.moments import quantiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def row_counts(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n"))


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def label_percent(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of each label value; the total is a scalar subquery over the label counts."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").cast("double")).scalar()
    return counts.select(label, F.round(F.col("n") / total * 100, 2).alias("percentage"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: n, mean, std, min, max and exact quartiles of the non-null values."""
    pieces = {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.avg(c).cast("double"),
        "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    flat = df.agg(*[make(c).alias(f"{c}__{p}") for c in columns for p, make in pieces.items()])
    stats = flat.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("col"),
                        *[F.col(f"{c}__{p}").alias(p) for p in pieces],
                    )
                    for c in columns
                ]
            )
        )
    )
    quarter = quantiles(df, columns, list(QUARTILES.values()))
    wide = quarter.groupBy("col").agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(q) for q, s in QUARTILES.items()]
    )
    return stats.join(F.broadcast(wide), "col", "left")  # one row per column name


def preview(df: DataFrame, *order: str, rows: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(rows)


def preview_transposed(df: DataFrame, order: str, columns: list[str], rows: int = 5) -> DataFrame:
    """One row per column, one text field `row_0`.. per previewed record."""
    head = preview(df, order, rows=rows).select(
        order, *[F.col(c).cast("string").alias(c) for c in columns]
    )
    # At most `rows` records are collected into the list.
    gathered = head.agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), *columns))).alias("r")
    )
    return gathered.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("col"),
                        *[F.get(F.col("r"), F.lit(i))[c].alias(f"row_{i}") for i in range(rows)],
                    )
                    for c in columns
                ]
            )
        )
    )
