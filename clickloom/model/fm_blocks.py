"""Sparse records packed in blocks, and a factorization machine's gradient sums over them.

A block holds records with equally many entries, entry by entry: the first entries of all of them,
then the second ones. Where such an entry has one index in the whole block (a count), its values make
a row of a dense matrix; the others (a slot's code) are looked up and added up by index. So a pass
over the records is array arithmetic, not a loop over entries, and reads a few bytes per entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from clickloom.storage import scratch_path, small_batches

BLOCK_ROWS = 10_000  # what Arrow hands over at a time
BLOCK = "size int, n int, label binary, fixed binary, dense binary, first binary, codes binary, weights binary"
PART = "part int, sums binary"
PART_VALUES = 1 << 16
BATCH_BLOCKS = 8
# Row groups of a few blocks: the reader holds a row group's blocks at once.
_SMALL_GROUPS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in half the bytes, where none is changed by that."""
    with np.errstate(over="ignore"):
        short = values.astype(np.float32)
    return short if (short == values).all() else values


def _entries(vectors: pa.StructArray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Size, entries per record, and all records' indices and values one after the other."""
    kind, size, at, values = vectors.flatten()
    sparse = kind.to_numpy(zero_copy_only=False) == 0
    lengths = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    x = values.flatten().to_numpy(zero_copy_only=False)
    sizes = np.unique(np.where(sparse, size.fill_null(0).to_numpy(zero_copy_only=False), lengths))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different sizes: {sizes.tolist()}")
    if not np.isfinite(x).all():
        raise ValueError("vectors hold finite numbers")
    index = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    index[np.repeat(sparse, lengths)] = at.flatten().to_numpy(zero_copy_only=False)
    return int(sizes[0]), lengths, index, x


def _block(size: int, label: np.ndarray, at: np.ndarray, x: np.ndarray) -> dict:
    """One block of records whose entries are the columns of `at` and `x`."""
    fixed = (at == at[:, :1]).all(axis=1)
    first = at[~fixed].min(axis=1)
    codes, weights = at[~fixed] - first[:, None], x[~fixed]
    codes = codes.astype(np.min_scalar_type(codes.max(initial=0)))
    return {
        "size": size, "n": len(label), "label": label.astype(np.uint8).tobytes(),
        "fixed": at[fixed, 0].astype(np.int32).tobytes(), "dense": _narrow(x[fixed]).tobytes(),
        "first": first.astype(np.int32).tobytes(), "codes": codes.tobytes(),
        "weights": b"" if (weights == 1).all() else _narrow(weights).tobytes(),
    }


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("size", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("label", "fixed", "dense", "first", "codes", "weights")]])
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK_ROWS):
            labels, vectors = batch.slice(begin, BLOCK_ROWS).columns
            label = labels.to_numpy(zero_copy_only=False)
            if labels.null_count or not np.isin(label, (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            if vectors.null_count:
                raise ValueError("a vector is null")
            size, lengths, index, x = _entries(vectors)
            start = np.cumsum(lengths) - lengths
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                entry = start[own] + np.arange(length)[:, None]
                block = _block(size, label[own], index[entry], x[entry])
                yield pa.RecordBatch.from_pylist([block], schema)


def pack(records: DataFrame, label: Column, features: Column) -> DataFrame:
    """The records as blocks in the shared folder; `features` is an ML vector or its stored form.

    Labels other than 0 and 1, null vectors and numbers that are not finite are refused.
    """
    spark = records.sparkSession
    blocks = records.select(label.cast("double").alias("label"), features.alias("features")).mapInArrow(_pack, BLOCK)
    path = scratch_path(spark, "blocks")
    blocks.write.options(**_SMALL_GROUPS).parquet(path)
    return spark.read.schema(BLOCK).parquet(path)


def _floats(buffer: pa.Buffer, rows: int, n: int) -> np.ndarray:
    kind = np.float32 if len(buffer) == 4 * rows * n else np.float64
    return np.frombuffer(buffer, kind).reshape(rows, n).astype(np.float64)


def add_sums(out: np.ndarray, block: dict, table: np.ndarray, bias: float) -> float:
    """Add a block's sums to `out`; the sum of its errors.

    `table` has a row per place of the vector: its factors, its weight, and the sum of its squared
    factors. With e a record's error, x its value at a place and s its sum of factors times values, a
    column of `out` is that place's sum of e x s, one row per factor, of e x, and of e x x.
    """
    n, k = block["n"].as_py(), table.shape[1] - 2
    buffers = {c: block[c].as_buffer() for c in ("label", "fixed", "dense", "first", "codes", "weights")}
    fixed, first = np.frombuffer(buffers["fixed"], np.int32), np.frombuffer(buffers["first"], np.int32)
    dense = _floats(buffers["dense"], len(fixed), n)
    squared = dense**2
    width = len(buffers["codes"]) // (len(first) * n) if len(first) else 1
    codes = np.frombuffer(buffers["codes"], f"u{width}").reshape(len(first), n).astype(np.intp)
    weights = _floats(buffers["weights"], len(first), n) if len(buffers["weights"]) else [None] * len(first)

    pulled = np.empty((n, k + 2))
    pulled[:, : k + 1] = dense.T @ table[fixed, : k + 1]
    pulled[:, k + 1] = squared.T @ table[fixed, k + 1]
    for low, code, x in zip(first, codes, weights):
        rows = table[low:].take(code, axis=0)
        if x is not None:
            rows[:, : k + 1] *= x[:, None]
            rows[:, k + 1] *= x**2
        pulled += rows
    logit = bias + pulled[:, k] + 0.5 * ((pulled[:, :k] ** 2).sum(axis=1) - pulled[:, k + 1])
    with np.errstate(over="ignore"):
        error = 1 / (1 + np.exp(-logit)) - np.frombuffer(buffers["label"], np.uint8)

    pushed = np.empty((k + 1, n))
    pushed[:k] = pulled[:, :k].T * error
    pushed[k] = error
    out[: k + 1, fixed] += pushed @ dense.T
    out[k + 1, fixed] += squared @ error
    for low, code, x in zip(first, codes, weights):
        own = out[:, low : low + code.max() + 1]
        for row, each in zip(own, pushed):
            by_code = np.bincount(code, each if x is None else each * x)
            row += by_code
        own[k + 1] += by_code if x is None else np.bincount(code, error * x**2)
    return float(error.sum())


def gradient_sums(blocks: DataFrame, table: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """`add_sums` over all blocks: summed inside the tasks, then part by part; one sum reaches the driver."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((table, bias))
    schema = pa.schema([("part", pa.int32()), ("sums", pa.binary())])

    def parts(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for part, values in sums.items():
            yield pa.RecordBatch.from_pylist([{"part": part, "sums": values.tobytes()}], schema)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (table, bias), out, errors = shared.value, None, 0.0
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    out = np.zeros(table.shape[::-1])
                errors += add_sums(out, dict(zip(batch.schema.names, (c[i] for c in batch.columns))), table, bias)
        if out is not None:
            flat = np.append(out.ravel(), errors)
            yield from parts({i: flat[i * PART_VALUES : (i + 1) * PART_VALUES] for i in range(-(-len(flat) // PART_VALUES))})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(values.as_buffer())
                sums[part] = sums[part] + values if part in sums else values.copy()
        yield from parts(sums)

    with small_batches(spark, BATCH_BLOCKS):
        found = blocks.mapInArrow(summed, PART).repartition("part").mapInArrow(merged, PART).toArrow().sort_by("part")
    shared.destroy()
    flat = np.concatenate([np.frombuffer(v.as_buffer()) for v in found["sums"]])
    return flat[:-1].reshape(table.shape[::-1]), float(flat[-1])
