"""Connected components by alternating large-star and small-star steps.

Each step replaces edges by edges to the smallest neighbour; neighbourhoods are reduced to
that smallest one before the shuffle and joined back, never gathered, so a node with very many
neighbours is a skewed join key and no more. Steps are written to the shared folder: lineage
stays short and a lost executor costs tasks of one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.storage import materialize


def _smallest(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    linked = both.join(_smallest(both), "u").where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("a"), F.least("m", "u").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    linked = down.join(_smallest(down), "u")
    out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
        linked.select(F.col("u").alias("a"), F.col("m").alias("b"))
    )
    return out.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node, label` of every node with an edge in `a, b`; the label is the smallest node reachable."""
    now = materialize(edges.where("a != b").select("a", "b").distinct(), "edges")
    state = None
    while True:
        now = materialize(_small_star(_large_star(now)), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state = mark
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label")).distinct()
