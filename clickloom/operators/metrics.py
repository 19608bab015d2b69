"""Evaluation metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from clickloom.operators.ordering import SLICE, ordered_slices


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve, ties counting one half; one row `(auc, n_pos, n_neg)`.

    Rows whose label is not 0 or 1, or whose score is null or not a number, do not count.
    """
    one = auc_by(df.withColumn("_all", F.lit(0)), ["_all"], score, label).drop("_all")
    return one.agg(  # a row without any record to rank, too
        F.max("auc").alias("auc"), F.coalesce(F.max("n_pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.max("n_neg"), F.lit(0)).alias("n_neg")
    )


def auc_by(df: DataFrame, groups: Sequence[str], score: str, label: str) -> DataFrame:
    """`groups, auc, n_pos, n_neg`: the AUC of each group of rows with one to rank, all in one pass.

    Rows are first counted per group and distinct score, so equal scores cost one row. These are cut
    into slices by (group, score), whatever the groups' sizes. A slice's part of a group is reduced
    to three sums, and only those are put in order. A null group is a group.
    """
    known = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isin(0, 1))
    counts = known.groupBy(*groups, F.col(score).alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_p"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_n"),
    )
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(SLICE, *groups).orderBy("_s").rowsBetween(*earlier)
    below = F.coalesce(F.sum("_n").over(inside), F.lit(0)).cast("double")
    parts = (
        ordered_slices(counts, [*[F.col(g).asc() for g in groups], F.col("_s").asc()], "auc")
        .withColumn("_below", below)
        .groupBy(SLICE, *groups)
        .agg(
            F.sum(F.col("_p").cast("double") * (F.col("_below") + F.col("_n") / 2.0)).alias("_won"),
            F.sum("_p").alias("_p"),
            F.sum("_n").alias("_n"),
        )
    )
    # At most one row per slice and group from here on.
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*groups).orderBy(SLICE).rowsBetween(*earlier)), F.lit(0))
    total = parts.withColumn("_before", before).groupBy(*groups).agg(
        F.sum(F.col("_won") + F.col("_p").cast("double") * F.col("_before").cast("double")).alias("_won"),
        F.sum("_p").alias("n_pos"),
        F.sum("_n").alias("n_neg"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return total.select(*groups, F.try_divide(F.col("_won"), pairs).alias("auc"), "n_pos", "n_neg")


def log_loss(df: DataFrame, logit: str, label: str) -> DataFrame:
    """Mean binary cross-entropy of a logit, in the form that cannot overflow."""
    z, y = F.col(logit).cast("double"), F.col(label).cast("double")
    return df.agg(
        F.avg(F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - z * y).alias("log_loss")
    )
