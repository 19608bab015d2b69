"""Exact substring dedup: bytes covered by a long string that starts anywhere else too.

Texts are cut into segments so that equal strings of `LENGTH` bytes meet: a window of that
length is sent where its smallest `GRAM`-byte hash points (leftmost on a tie), so its way
depends on its bytes alone. Neighbouring windows with one such anchor make one segment.

1. An anchor that occurs once cannot belong to a repeated window; its segments are left out.
2. Equal segments of the other anchors are one string with a count, however many copies there are.
   Where all segments of an anchor are equal, as whole copies give, each of its windows stands in
   all of them: they are flagged without a look at the bytes.
3. Anchors of two strings or more are dealt to shards of about `SHARD_BYTES`. Each shard sorts its suffixes by
   Larsson-Sadakane refinement, takes common prefixes by Kasai, and flags windows that share
   `LENGTH` bytes with another, or stand in a string that occurs twice.
4. An anchor with more text than a shard is spread over several. Their windows are merged by
   binary search: each shard sends one fingerprint per distinct window to one of as many ranges as
   their count asks for, where it is searched among those of the other shards.
5. Flags go back to all occurrences of a segment, by row, and the texts are cut.

Null texts are empty; empty and short texts lose nothing. Positions count UTF-8 bytes. Strings
are judged on the input, and never cross documents. Rows of one key and one text are copies of
each other like any other rows. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.suffixes import repeated
from clickloom.llm.text import sliced
from clickloom.storage import materialize, small_batches

LENGTH = 400
GRAM = 100
SHARD_BYTES = 1 << 20
RANGE_PRINTS = 500_000  # fingerprints searched at once, on average
PIECE = 1 << 22  # bytes of one text handled at once
FETCHED = 1 << 20  # bytes of segments sent at once
SEGMENT = "anchor bigint, d1 bigint, d2 bigint, row bigint, row2 int, start bigint, windows int"
_BASES = (np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F | 1))
_draw = np.random.default_rng(20240607)
_BYTE = _draw.integers(1, 2**63, (2, 256), dtype=np.uint64)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of a base and of its inverse; the worker keeps them, a piece's length at most."""
    if which not in _powers or len(_powers[which][0]) < n:
        base, size = int(_BASES[which]), max(n, 1 << 14)
        with np.errstate(over="ignore"):
            _powers[which] = tuple(
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(b))])) for b in (base, pow(base, -1, 1 << 64))
            )
    return _powers[which]


class Hashes:
    """Hashes of any stretch of a byte string in constant time, by running sums modulo 2^64."""

    def __init__(self, text: np.ndarray, which: int):
        power, self.back = _powers_of(which, len(text) + 1)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[which][text] * power[: len(text)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = (self.sums[end] - self.sums[start]) * self.back[start]
            out ^= out >> np.uint64(31)
            out *= np.uint64(0xD6E8FEB86659FD93)
            return out ^ (out >> np.uint64(32))


def sliding_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbours, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).reshape(-1)
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def segments(text: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, two digests, start and number of windows of every segment of a text."""
    parts = []
    for first in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
        piece = text[first : first + PIECE + LENGTH - 1]
        one, two = Hashes(piece, 0), Hashes(piece, 1)
        at = np.arange(len(piece) - GRAM + 1)
        gram = one.of(at, at + GRAM)
        packed = (gram & ~np.uint64(2**24 - 1)) | at.astype(np.uint64)
        where = (sliding_smallest(packed, LENGTH - GRAM + 1) & np.uint64(2**24 - 1)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        ends = np.concatenate([starts[1:], [len(where)]])
        stop = ends + LENGTH - 1
        parts.append((gram[where[starts]], one.of(starts, stop), two.of(starts, stop), starts + first, ends - starts))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _bytes(column: pa.Array, i: int) -> np.ndarray:
    value = column[i].as_buffer()
    return np.zeros(0, np.uint8) if value is None else np.frombuffer(value, np.uint8)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, rows, out, held = batch.column("text"), [], [], 0
        for i in range(batch.num_rows):
            found = segments(_bytes(column, i))
            if len(found[0]):
                rows.append(np.full(len(found[0]), i))
                out.append(found)
                held += len(found[0])
            if out and (held > 200_000 or i == batch.num_rows - 1):
                yield _segment_batch(batch, np.concatenate(rows), [np.concatenate(x) for x in zip(*out, strict=True)])
                rows, out, held = [], [], 0
        if out:
            yield _segment_batch(batch, np.concatenate(rows), [np.concatenate(x) for x in zip(*out, strict=True)])


def _segment_batch(batch: pa.RecordBatch, rows: np.ndarray, found: list[np.ndarray]) -> pa.RecordBatch:
    anchor, d1, d2, start, windows = found
    who = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [*[pa.array(x.astype(np.uint64).view(np.int64)) for x in (anchor, d1, d2)], batch.column("row").take(who),
         batch.column("row2").take(who), pa.array(start.astype(np.int64)), pa.array(windows.astype(np.int32))],
        ["anchor", "d1", "d2", "row", "row2", "start", "windows"],
    )


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text, in batches of about `FETCHED` bytes."""
    names = ["shard", "salt", "anchor", "d1", "d2", "times"]
    for batch in batches:
        lists = batch.column("wanted")
        wanted = lists.flatten()
        row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        start = wanted.field("start").to_numpy(zero_copy_only=False)
        stop = start + wanted.field("windows").to_numpy(zero_copy_only=False) + LENGTH - 1
        part = np.cumsum(stop - start) // FETCHED
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(row)]
        for first, last in zip(edges[:-1], edges[1:], strict=True):
            places = zip(row[first:last].tolist(), start[first:last].tolist(), stop[first:last].tolist(), strict=True)
            data = pa.array([_bytes(batch.column("text"), i)[f:t].tobytes() for i, f, t in places], pa.binary())
            own = wanted.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([*[own.field(c) for c in names], data], [*names, "bytes"])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of the runs of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - 1


def _sort_shard(group: pd.DataFrame) -> pd.DataFrame:
    """One row per segment with a flagged window; those of spread anchors also send fingerprints.

    `low`, `high` are runs of flagged window starts. `w1, w2` are fingerprints of one window per
    class of the shard, `at` its place; windows flagged already are sent too, for others to find.
    """
    sizes = group["bytes"].str.len().to_numpy()
    starts = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(group["bytes"]), np.uint8)
    flags, classes = repeated(text, starts, sizes, group["times"].to_numpy(np.int64), LENGTH)
    spread = bool(group["salt"].iloc[0] >= 0)
    if spread:
        inside = np.flatnonzero(classes >= 0)
        _, one = np.unique(classes[inside], return_index=True)
        sample = inside[one]
        w1 = Hashes(text, 0).of(sample, sample + LENGTH).view(np.int64)
        w2 = Hashes(text, 1).of(sample, sample + LENGTH).view(np.int64)
        owner = np.searchsorted(starts, sample, side="right") - 1
        by_owner = np.argsort(owner, kind="stable")
        edge = np.searchsorted(owner[by_owner], np.arange(len(starts) + 1))
    out = []
    for i, row in enumerate(group.itertuples()):
        own = flags[starts[i] : starts[i] + max(sizes[i] - LENGTH + 1, 0)]
        low, high = _runs(own)
        mine = by_owner[edge[i] : edge[i + 1]] if spread else np.zeros(0, np.int64)
        if len(low) or len(mine):
            at = sample[mine] - starts[i] if spread else mine
            out.append((
                row.anchor, row.d1, row.d2, row.salt, low.tolist(), high.tolist(),
                *([w1[mine].tolist(), w2[mine].tolist(), at.tolist()] if spread else [[], [], []]),
            ))
    return pd.DataFrame(out, columns=["anchor", "d1", "d2", "salt", "low", "high", "w1", "w2", "at"])


def _search(group: pd.DataFrame) -> pd.DataFrame:
    """The windows of one range of fingerprints that two or more shards have, by binary search."""
    low = group["w1"].to_numpy()
    order = np.lexsort((group["w2"].to_numpy(), low))
    both = np.rec.fromarrays([low[order], group["w2"].to_numpy()[order]])
    found = np.searchsorted(both, both, side="right") - np.searchsorted(both, both, side="left") > 1
    return group.iloc[order[found]][["anchor", "d1", "d2", "at"]]


def repeated_spans(df: DataFrame, text: str, rows: DataFrame) -> DataFrame:
    """`row, row2, spans`: for each text the stretches (from, to) that repeated windows cover."""
    with small_batches(df.sparkSession):
        found = materialize(rows.mapInArrow(_cut, SEGMENT), "sub-found")
    same = (F.min("d1") == F.max("d1")) & (F.min("d2") == F.max("d2"))
    often = found.groupBy("anchor").agg(F.count("*").alias("n"), same.alias("alike")).where("n > 1").select("anchor", "alike")
    places = materialize(found.join(materialize(often, "sub-anchors"), "anchor"), "sub-places")
    alike, mixed = places.where("alike"), places.where("NOT alike")
    kinds = mixed.groupBy("anchor", "d1", "d2").agg(
        F.count("*").alias("times"), F.min(F.struct("row", "row2", "start", "windows")).alias("one")
    )
    kinds = materialize(kinds.select("anchor", "d1", "d2", "times", "one.*"), "sub-kinds")
    size = F.sum(F.col("windows") + LENGTH - 1)
    weights = kinds.groupBy("anchor").agg(size.alias("bytes"))
    hot = materialize(weights.where(F.col("bytes") > SHARD_BYTES), "sub-hot")
    total = kinds.agg(size.alias("b")).first()["b"] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    parts = F.ceil(F.col("bytes") / SHARD_BYTES)
    dealt = kinds.join(hot, "anchor", "left").select(
        F.when(F.col("bytes").isNull(), F.pmod(F.xxhash64("anchor"), F.lit(shards))).otherwise(F.col("anchor")).alias("shard"),
        F.when(F.col("bytes").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("d1"), parts)).cast("int").alias("salt"),
        "anchor", "d1", "d2", "times", "row", "row2", "start", "windows",
    )
    wanted = dealt.groupBy("row", "row2").agg(  # the segments that one text stands for
        F.collect_list(F.struct("shard", "salt", "anchor", "d1", "d2", "times", "start", "windows")).alias("wanted")
    )
    strings = rows.dropDuplicates(["row", "row2"]).join(wanted, ["row", "row2"]).select("text", "wanted").mapInArrow(
        _fetch, "shard bigint, salt int, anchor bigint, d1 bigint, d2 bigint, times bigint, bytes binary"
    )
    with small_batches(df.sparkSession):
        sorted_ = materialize(
            strings.groupBy("shard", "salt").applyInPandas(
                _sort_shard,
                "anchor bigint, d1 bigint, d2 bigint, salt int, low array<bigint>, high array<bigint>, "
                "w1 array<bigint>, w2 array<bigint>, at array<bigint>",
            ),
            "sub-sorted",
        )
    prints = sorted_.where("salt >= 0").select(
        "anchor", "d1", "d2", F.explode(F.arrays_zip("w1", "w2", "at")).alias("w")
    ).select("anchor", "d1", "d2", "w.w1", "w.w2", "w.at")
    ranges = max(1, -(-(sorted_.agg(F.sum(F.size("w1"))).first()[0] or 0) // RANGE_PRINTS))
    crossing = prints.withColumn("range", F.pmod("w1", F.lit(ranges))).groupBy("range").applyInPandas(
        _search, "anchor bigint, d1 bigint, d2 bigint, at bigint"
    )
    within = sorted_.select("anchor", "d1", "d2", F.explode(F.arrays_zip("low", "high")).alias("r")).select(
        "anchor", "d1", "d2", "r.low", "r.high"
    )
    flagged = within.unionByName(crossing.select("anchor", "d1", "d2", F.col("at").alias("low"), F.col("at").alias("high")))
    flagged = materialize(
        flagged.groupBy("anchor", "d1", "d2").agg(F.collect_list(F.struct("low", "high")).alias("runs")), "sub-flagged"
    )  # of one segment
    spans = F.transform("runs", lambda r: F.struct((F.col("start") + r["low"]).alias("f"), (F.col("start") + r["high"] + LENGTH).alias("t")))
    whole = F.array(F.struct(F.col("start").alias("f"), (F.col("start") + F.col("windows") + LENGTH - 1).alias("t")))
    covered = mixed.select("row", "row2", "start", "anchor", "d1", "d2").distinct().join(flagged, ["anchor", "d1", "d2"])
    both = covered.select("row", "row2", spans.alias("spans")).unionByName(alike.select("row", "row2", whole.alias("spans")))
    return both.groupBy("row", "row2").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        text, spans, out = batch.column("text"), batch.column("spans"), []
        for i in range(batch.num_rows):
            data = _bytes(text, i)
            cover = np.zeros(len(data) + 1, np.int32)
            if spans[i].is_valid:
                both = spans[i].values
                np.add.at(cover, both.field(0).to_numpy(), 1)
                np.subtract.at(cover, both.field(1).to_numpy(), 1)
            gone = np.cumsum(cover[:-1]) > 0
            low, high = _runs(gone)
            out.append((len(data), int(gone.sum()), low.tolist(), (high + 1).tolist(), data[~gone].tobytes()))
        size, removed, low, high, rest = zip(*out, strict=True) if out else ([],) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(low, pa.list_(pa.int64())),
             pa.array(high, pa.list_(pa.int64())), pa.array(rest, pa.binary())],
            ["id", "n_bytes", "n_removed", "low", "high", "rest"],
        )


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, `n_bytes, n_removed`, removed stretches `low, high` and the `rest` of the bytes."""
    rows = df.select(
        F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(key, text).alias("row"), F.hash(text, key).alias("row2"),
    )
    spans = materialize(repeated_spans(df, text, rows.select("row", "row2", "text")), "sub-spans")
    kind = df.schema[key].dataType.simpleString()
    return (
        rows.join(spans, ["row", "row2"], "left").select("id", "text", "spans")
        .mapInArrow(_cut_out, f"id {kind}, n_bytes bigint, n_removed bigint, low array<bigint>, high array<bigint>, rest binary")
        .withColumnRenamed("id", key)
    )


def substrings_query(df: DataFrame) -> DataFrame:
    return remove_repeats(df).select(
        "doc_id", "n_bytes", "n_removed", F.size("low").cast("long").alias("n_spans"), F.sha2("rest", 256).alias("kept_sha256")
    )
