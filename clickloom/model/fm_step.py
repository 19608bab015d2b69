"""One gradient step of the factorization machine over a table of looked-up records."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.model import network
from clickloom.operators.embedding import LATENT, VECTOR

_SUMS = ["linear", "own", *[f"s{j}" for j in range(LATENT)]]


def gradient_sums(
    rows: DataFrame, slots: Sequence[str], dense: Sequence[str], weights: Sequence[Sequence[float]], n: int, label: str
) -> DataFrame:
    """`(slot, code, linear, own, s0, ..)`: what the rows pull at each key, added up.

    Each task adds up a batch slot by slot before it sends anything, so a record is never taken
    apart into its features, and no vector leaves the task.
    """
    params = {"latent": np.array([w[:LATENT] for w in weights]).reshape(-1, LATENT), "linear": np.array([w[LATENT] for w in weights])}
    names, counts = list(slots), len(dense)
    laid = rows.select(
        F.col(label).cast("double").alias("label"),
        F.array(*[F.col(c).cast("bigint") for c in names]).alias("codes"),
        F.concat(*[F.col(f"{c}__vec").cast("array<double>") for c in names]).alias("emb"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in dense]).alias("x"),
    )

    def pulled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            emb = network.matrix(batch.column("emb"), len(names) * VECTOR).reshape(-1, len(names), VECTOR)
            x = network.matrix(batch.column("x"), counts)
            logit, (_, summed, _) = network.forward(params, emb, x)
            g = (network.sigmoid(logit) - batch.column("label").to_numpy(zero_copy_only=False)) / n
            codes = np.asarray(batch.column("codes").flatten()).reshape(-1, len(names))
            keys, sums = [], []
            for s in range(len(names)):
                code, where = np.unique(codes[:, s], return_inverse=True)
                add = lambda v, where=where, m=len(code): np.bincount(where, v, minlength=m)
                keys.append(np.stack([np.full(len(code), s), code]))
                sums.append(np.stack([add(g), add(g), *[add(g * summed[:, j]) for j in range(LATENT)]]))
            keys.append(np.stack([len(names) + np.arange(counts), np.zeros(counts, np.int64)]))
            pull = g[:, None] * x
            sums.append(np.concatenate([pull.sum(axis=0)[None], (pull * x).sum(axis=0)[None], summed.T @ pull]))
            slot, code = np.concatenate(keys, axis=1)
            numbers = np.concatenate(sums, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(code), *map(pa.array, numbers)], ["slot", "code", *_SUMS])

    parts = laid.mapInArrow(pulled, f"slot int, code bigint, {', '.join(f'{c} double' for c in _SUMS)}")
    return parts.groupBy("slot", "code").agg(*[F.sum(c).alias(c) for c in _SUMS])


def fm_step(
    rows: DataFrame,
    slots: Sequence[str],
    dense: Sequence[str],
    table: DataFrame,
    weights: Sequence[Sequence[float]],
    n: int,
    lr: float,
    label: str = "label",
) -> DataFrame:
    """`(slot, code, j, value)`: the new weights of every key that the rows touch.

    `rows` are `n` records with label, codes, vectors `<slot>__vec` from `table` (`slot, code, vec`) and
    dense values; `weights` hold a vector per dense column, which takes the slot numbers behind
    `slots` and code 0. A null dense value counts as 0, a key without a vector as zeros. The loss is the
    mean cross-entropy of the records.

    A feature of value x and vector v has the gradient g x (S - x v), where S is the sum of x v
    over the record's features. Per key that is three kinds of sums without v, which is joined to
    them afterwards, once per key.
    """
    spark = rows.sparkSession
    given = [(len(slots) + i, 0, [float(x) for x in w]) for i, w in enumerate(weights)]
    known = table.select(F.col("slot").cast("int"), F.col("code").cast("bigint"), F.col("vec").cast("array<double>"))
    if given:
        known = known.unionByName(spark.createDataFrame(given, "slot int, code bigint, vec array<double>"))
    sums = gradient_sums(rows, slots, dense, weights, n, label).join(known, ["slot", "code"], "left")
    old = F.coalesce("vec", F.array(*[F.lit(0.0)] * VECTOR))
    gradient = [F.col(f"s{j}") - F.col("own") * old[j] for j in range(LATENT)] + [F.col("linear")]
    new = F.array(*[old[j] - lr * gradient[j] for j in range(VECTOR)])
    return sums.select("slot", "code", F.posexplode(new).alias("j", "value"))
