"""Embedding whitening by a covariance over distinct vectors with multiplicities.

Entries become whole numbers, x = floor(64 * entry) + 1000000, so equal vectors can be grouped.
Each distinct vector counts with a fit weight of one, or of its multiplicity. The moments come
from two passes over the distinct vectors: sums, which are exact, then products of centred
vectors, one matrix product a batch. Components are the unit eigenvectors of the covariance,
numbered from 1 by falling eigenvalue. Every distinct vector is whitened once, and the result is
joined back to all rows that have it; a vector of very many rows is a skewed key of that join,
which Spark splits.

Rows without a vector, or with a null or non-finite entry, are left out; null keys and repeated
rows stay. Vectors of another length are a set of their own, with its own fit. Entries beyond
2^38 in size count as that, so that sums stay whole, and a deviation that does not fit a long is null. A component
without variance has `explained` 0 and null `whitened`; `identity_error` is over the others and
null where there are none. Empty vectors have no components, and an empty table gives an empty
result. Only the key and the vector are read. What reaches the driver is a matrix of dimension
by dimension, at most `MOST_DIMENSIONS` squared.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.storage import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
MOST_DIMENSIONS = 8192
REACH = 2.0**44


def whole_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """`id, x, h1, h2` of the rows whose vectors can be used; the hashes stand for x."""
    value = F.col(vector)
    usable = value.isNotNull() & F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    number = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(REACH)), F.lit(-REACH))
    x = F.transform(value, lambda c: F.floor(number(c)) + SHIFT)
    rows = df.where(usable).select(F.col(key).alias("id"), x.alias("x"))
    return rows.select("id", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(vectors: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], kind: str, size: int) -> np.ndarray:
    """The sum over all batches of an array, added up by Spark position by position."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["place", "part"])

    table = vectors.mapInArrow(partial, f"place bigint, part {kind}").groupBy("place").agg(F.sum("part").alias("v")).toArrow()
    out = np.zeros(size, table["v"].to_numpy().dtype)
    out[table["place"].to_numpy()] = table["v"].to_numpy()
    return out


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("weight").to_numpy(zero_copy_only=False)


def moments(vectors: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """n, the sums S of every dimension and the covariance of `x, weight`.

    Vectors are centred by the whole number next to the mean, which is exact, then by the rest.
    """
    sums = _summed(
        vectors, lambda b: np.concatenate([[_weights(b).sum()], (_matrix(b, d) * _weights(b)[:, None]).sum(axis=0)]), "bigint", d + 1
    )
    n, total = int(sums[0]), sums[1:]
    near = np.array([round(int(s) / n) for s in total], np.int64)
    rest = np.array([(int(s) - int(c) * n) / n for s, c in zip(total, near, strict=True)])

    def products(batch: pa.RecordBatch) -> np.ndarray:
        centred = (_matrix(batch, d) - near).astype(np.float64) - rest
        return ((centred * _weights(batch)[:, None]).T @ centred).reshape(-1)

    return n, total, _summed(vectors, products, "double", d * d).reshape(d, d) / n


def components_of(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and their unit eigenvectors as columns; rounding errors count as 0."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    noise = max(float(values[0]), 0.0) * len(values) * np.finfo(np.float64).eps * 16 if len(values) else 0.0
    return np.where(values > noise, values, 0.0), vectors


def whitened_vectors(vectors: DataFrame, n: int, total: np.ndarray, values: np.ndarray, axes: np.ndarray) -> DataFrame:
    """`h1, h2, weight, deviation, w` of every distinct vector."""
    d = len(total)
    near = np.array([round(int(s) / n) for s in total], np.int64)
    rest = np.array([(int(s) - int(c) * n) / n for s, c in zip(total, near, strict=True)])
    scale = np.divide(1.0, np.sqrt(values), out=np.full(len(values), np.nan), where=values > 0)
    reach = math.isqrt(2**63 // max(d, 1)) - 1

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, d)
            off = x - near  # n * x - S = n * off - (S - n * near)
            over = np.array([int(s) - int(c) * n for s, c in zip(total, near, strict=True)], object)
            safe = np.abs(off).max(initial=0, axis=1) < (reach - n) // n
            gap = np.where(safe[:, None], off, 0) * n - over.astype(np.int64)
            deviation = pa.array((gap * gap).sum(axis=1), mask=~safe)
            w = ((off.astype(np.float64) - rest) @ axes) * scale
            ends = np.arange(len(x) + 1, dtype=np.int32) * len(values)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(w.reshape(-1), from_pandas=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("h1"), batch.column("h2"), batch.column("weight"), deviation, listed], ["h1", "h2", "weight", "deviation", "w"]
            )

    return vectors.mapInArrow(whiten, "h1 bigint, h2 bigint, weight bigint, deviation bigint, w array<double>")


def identity_error(white: DataFrame, n: int, used: int) -> float | None:
    """The largest entry of the whitened vectors' covariance minus the identity, centred first."""
    if not used:
        return None

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column("w").flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
        return flat.reshape(batch.num_rows, -1)[:, :used]

    mean = _summed(white, lambda b: (matrix(b) * _weights(b)[:, None]).sum(axis=0), "double", used) / n

    def products(batch: pa.RecordBatch) -> np.ndarray:
        centred = matrix(batch) - mean
        return ((centred * _weights(batch)[:, None]).T @ centred).reshape(-1)

    return float(np.abs(_summed(white, products, "double", used * used).reshape(used, used) / n - np.eye(used)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, by_count: bool = False) -> DataFrame:
    """Per remaining row and component: `key, component, n, deviation, whitened, explained, identity_error`.

    `by_count` weighs a distinct vector by the number of rows that have it, else by one.
    """
    rows = whole_vectors(df, key, vector)
    kind = rows.schema["id"].dataType.simpleString()
    weight = F.count("*") if by_count else F.lit(1).cast("long")
    distinct = rows.groupBy("x").agg(weight.alias("weight"))
    distinct = distinct.select("x", F.size("x").alias("d"), F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"), "weight")
    distinct = materialize(distinct, "white-distinct")
    out = None
    for length in sorted(r["d"] for r in distinct.select("d").where("d > 0").distinct().collect()):
        if length > MOST_DIMENSIONS:
            raise ValueError(f"vectors of more than {MOST_DIMENSIONS} dimensions")
        own = distinct.where(F.col("d") == length)
        n, total, covariance = moments(own, length)
        values, axes = components_of(covariance)
        trace = float(np.trace(covariance))
        values, axes = values[:components], np.ascontiguousarray(axes[:, :components])
        white = materialize(whitened_vectors(own, n, total, values, axes), "white-vectors")
        error = identity_error(white, n, int((values > 0).sum()))
        shares = F.array(*[F.lit(float(e / trace) if trace > 0 else 0.0) for e in values])
        part = white.select(
            "h1", "h2", "deviation", F.lit(n).cast("long").alias("n"), "w", shares.alias("explained"), F.lit(error).cast("double").alias("identity_error")
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        empty = f"{key} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], empty)
    joined = rows.select("id", "h1", "h2").join(out, ["h1", "h2"])
    each = joined.select("id", "n", "deviation", "identity_error", "explained", F.posexplode("w").alias("place", "whitened"))
    return each.select(
        F.col("id").alias(key), (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.col("explained")[F.col("place")].alias("explained"), "identity_error",
    )


def whitening_query(df: DataFrame) -> DataFrame:
    return whiten(df)
