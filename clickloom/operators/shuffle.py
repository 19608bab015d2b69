"""Row order and file placement. The bag of rows is the same under every mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MODES = (None, "PER_PARTITION", "PER_WORKER", "FULL")


def _draw(seed: int, key: str | None) -> Column:
    """A per-row number: a seeded hash of the key, which a repeated task draws again alike."""
    return F.xxhash64(F.lit(seed), F.col(key)) if key else F.rand(seed)


def shuffle_rows(
    df: DataFrame,
    mode: str | None,
    seed: int = 0,
    files: int | None = None,
    workers: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """Place and order rows; with `files` the result has that many partitions.

    FULL sends each row to a random partition. PER_WORKER gives each of
    `workers` its share after the work upstream is done, which keeps all its tasks. PER_PARTITION only reorders within partitions.
    """
    if mode not in MODES:
        raise ValueError(f"unknown shuffle mode: {mode!r}")
    if mode is None:
        return place(df, files, key)
    if mode == "FULL":
        target = [F.pmod(_draw(seed, key), F.lit(2**31 - 1))] if key else []
        moved = df.repartition(files, *target) if files else (
            df.repartition(*target) if target else df.repartition(F.rand(seed + 2))
        )
        return moved.sortWithinPartitions(_draw(seed + 1, key))
    if mode == "PER_WORKER":
        return _per_worker(df, workers or files, seed, key)
    return place(df, files, key).sortWithinPartitions(_draw(seed, key))


def _per_worker(df: DataFrame, workers: int | None, seed: int, key: str | None) -> DataFrame:
    """Rows are ordered in parts of the session's partition size, then each worker gets its rows of every part.

    A worker so reads drawn parts, each in a drawn order, one behind the other; it holds no more than
    it reads at once, however large its share. Parts may follow one another differently in another run.
    """
    draw = _draw(seed, key)
    if workers is None:
        return df.sortWithinPartitions(draw)
    parts = df.hint("rebalance", key) if key else df.hint("rebalance")
    return place(parts.sortWithinPartitions(draw), workers, key)


def place(df: DataFrame, files: int | None, key: str | None = None) -> DataFrame:
    """Spread rows evenly over `files` partitions, by the key when there is one."""
    if files is None:
        return df
    return df.repartition(files, F.col(key)) if key else df.repartition(files)


def assign_batches(df: DataFrame, key: str, batches: int, epoch: int = 0) -> DataFrame:
    """Mini-batch number of each row, drawn anew for every epoch.

    The draw is a hash that other engines have too, so that they can repeat it.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(epoch))))
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.withColumn("batch", F.pmod(drawn, F.lit(batches)).cast("int"))
