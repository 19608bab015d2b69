"""Bloom filter cascades: whether a key is listed, exactly, for every key of a known universe.

Level 0 encodes the listed keys, level 1 the other keys of the universe that level 0 lets
through, level 2 the listed keys that level 1 lets through, and so on, until a level lets
nothing wrong through. A key outside level i is not of the kind that level i encodes, which
settles it; one inside all levels is of the kind of the last one.

Keys are pairs of 64-bit hashes, so two texts are taken for one with probability 2^-128 a pair.
The first level errs at sqrt(1/2) of listed keys to others and the rest at one half, which
leaves about log2(others / listed) + 3 bits for a listed key, whatever the universe's size.
Keys that no row of the corpus can ask for are not encoded at all.

A cascade of more than `PART_BITS` bits is split by key into parts, each below that bound;
tasks hold one part at a time. An empty list, or an empty universe, lists nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.storage import materialize

PART_BITS = 1 << 27  # 16 MB of a part
MOST_LEVELS = 200


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(salt)) * np.uint64(0x9FB21C651E98DF25)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


@dataclass
class Level:
    """One Bloom filter; `salt` tells the levels' hashes apart."""

    salt: int
    hashes: int
    bits: int
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    def places(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The bits of each key, a row of them per hash."""
        with np.errstate(over="ignore"):
            a, b = mixed(k1.view(np.uint64), 2 * self.salt + 1), mixed(k2.view(np.uint64), 2 * self.salt + 2)
            return np.stack([(a + np.uint64(i) * (b | np.uint64(1))) % np.uint64(self.bits) for i in range(self.hashes)])

    def has(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        at = self.places(k1, k2)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def holds(levels: list[Level], k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Which keys of the universe are listed."""
    out = np.zeros(len(k1), bool)
    at = np.arange(len(k1))
    for depth, level in enumerate(levels):
        inside = level.has(k1[at], k2[at])
        out[at[~inside]] = depth % 2 == 1
        at = at[inside]
    out[at] = len(levels) % 2 == 1
    return out


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("k1").to_numpy(zero_copy_only=False), batch.column("k2").to_numpy(zero_copy_only=False)


def filled(level: Level, keys: DataFrame) -> Level:
    """The level with the keys in it. Tasks send the words they touch, and those are or-ed in Spark."""

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.unique(level.places(*_numbers(batch)).reshape(-1))
                word, first = np.unique(at >> np.uint64(6), return_index=True)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    table = keys.mapInArrow(touched, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    level.words = np.zeros(-(-level.bits // 64), np.uint64)
    level.words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return level


def let_through(level: Level, keys: DataFrame) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.has(*_numbers(batch))))

    return keys.mapInArrow(passed, keys.schema)


def _levels(listed: DataFrame, others: DataFrame, n_listed: int, n_others: int) -> list[Level]:
    levels: list[Level] = []
    rate = min(0.5, math.sqrt(0.5) * n_listed / max(n_others, 1))
    mine, rest, n_mine = listed, others, n_listed
    while n_mine:
        if len(levels) == MOST_LEVELS:
            raise ValueError("a listed key and another one have the same hashes")
        hashes = max(1, round(-math.log2(rate)))
        levels.append(filled(Level(len(levels), hashes, max(64, math.ceil(n_mine * hashes / math.log(2)))), mine))
        wrong = materialize(let_through(levels[-1], rest), "cascade")
        mine, rest, n_mine, rate = wrong, mine, wrong.count(), 0.5
    return levels


def build(universe: DataFrame, listed: DataFrame) -> list[list[Level]]:
    """The parts of the cascade, by `k1` modulo their number, for the keys `k1, k2` of `universe`.

    One shuffle brings equal keys together, reduced to one row per key and task before it.
    """
    both = universe.select("k1", "k2", F.lit(True).alias("asked"), F.lit(False).alias("listed")).unionByName(
        listed.select("k1", "k2", F.lit(False).alias("asked"), F.lit(True).alias("listed"))
    )
    keys = both.groupBy("k1", "k2").agg(F.max("asked").alias("asked"), F.max("listed").alias("listed"))
    keys = materialize(keys.where("asked").select("k1", "k2", "listed"), "cascade-keys")
    sizes = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    mine, rest = sizes.get(True, 0), sizes.get(False, 0)
    if not mine:
        return [[]]
    bits = mine * (max(0.0, math.log2(max(rest, 1) / mine)) + 4) / math.log(2)
    parts = max(1, math.ceil(bits / PART_BITS))
    out = []
    for part in range(parts):
        own = keys.where(F.pmod("k1", F.lit(parts)) == part) if parts > 1 else keys
        counts = {r["listed"]: r["n"] for r in own.groupBy("listed").agg(F.count("*").alias("n")).collect()} if parts > 1 else sizes
        of = lambda kind: own.where(F.col("listed") == kind).select("k1", "k2")  # noqa: B023, E731
        out.append(_levels(of(True), of(False), counts.get(True, 0), counts.get(False, 0)))
    return out


def member(df: DataFrame, k1: str, k2: str, cascades: dict[str, list[list[Level]]]) -> DataFrame:
    """Add a column per cascade: for each key of the arrays `k1`, `k2` whether it is listed; a null key is not.

    One pass over the rows without a shuffle. Where a cascade has several parts there is one
    pass a part, written between, so that no task holds more than one part of each.
    """
    out = df.withColumns({name: F.transform(k1, lambda _: F.lit(False)) for name in cascades})
    passes = max((len(parts) for parts in cascades.values()), default=0)
    for part in range(passes):
        own = {name: (parts[part], len(parts)) for name, parts in cascades.items() if part < len(parts) and parts[part]}
        if not own:
            continue
        shared = df.sparkSession.sparkContext.broadcast(own)

        def judged(batches: Iterator[pa.RecordBatch], part: int = part, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                one, two = batch.column(k1), batch.column(k2)
                flat = one.flatten()
                asked = np.flatnonzero(flat.is_valid().to_numpy(zero_copy_only=False))
                keys = flat.fill_null(0).to_numpy(zero_copy_only=False)[asked]
                mates = two.flatten().fill_null(0).to_numpy(zero_copy_only=False)[asked]
                starts = np.concatenate([[0], np.cumsum(one.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
                for name, (levels, parts) in shared.value.items():
                    hit = batch.column(name).flatten().to_numpy(zero_copy_only=False).copy()
                    mine = keys % parts == part
                    hit[asked[mine]] |= holds(levels, keys[mine], mates[mine])
                    listed = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(hit))
                    batch = batch.set_column(batch.schema.get_field_index(name), name, listed)
                yield batch

        out = out.mapInArrow(judged, out.schema)
        if passes > 1:
            out = materialize(out, "cascade-part")
    return out
