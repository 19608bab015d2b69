"""Left lookups of many columns of a large table in one keyed side table.

The side table holds `(name, value, rank, payload)`: one entry per looked-up column and
value, `rank` ascending from the most frequent value. Columns whose entries fit the
broadcast budget are joined by broadcast, without a shuffle. In the others frequent values are
settled in the same way, and the values left over share one narrow shuffled join. Before that, most
values without any entry are told by a Bloom filter of the entries that are left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.storage import materialize


@dataclass(frozen=True)
class Limits:
    """Sizes that decide between broadcast and shuffle; all of them bytes or rows per job."""

    column_bytes: int = 64 << 20
    total_bytes: int = 512 << 20
    head_entries: int = 20_000
    hot_rows: int = 1_000_000
    filter_bits: int = 1 << 28  # 32 MB; more entries than that can tell apart let more values through


@dataclass(frozen=True)
class SideTable:
    """A side table with its measured entry count and bytes per column name."""

    entries: DataFrame
    sizes: dict[str, tuple[int, int]]

    @staticmethod
    def measure(entries: DataFrame, payload_bytes: int) -> "SideTable":
        """One row per column name reaches the driver, never an entry."""
        text = dict(entries.dtypes)["value"] == "string"
        value_bytes = F.sum(F.octet_length("value")) if text else F.lit(0)
        rows = (
            entries.groupBy("name")
            .agg(F.count("*").alias("n"), value_bytes.alias("b"), F.max("rank").alias("top"))
            .collect()
        )
        return SideTable(
            entries,
            {r["name"]: (r["n"], (r["b"] or 0) + r["n"] * (64 + payload_bytes)) for r in rows},
        )

    def broadcastable(self, names: list[str], limits: Limits) -> list[str]:
        """Smallest columns first, as long as each and their sum stay within the limits."""
        chosen, total = [], 0
        for name in sorted(names, key=lambda n: (self.sizes.get(n, (0, 0))[1], n)):
            size = self.sizes.get(name, (0, 0))[1]
            if size > limits.column_bytes or total + size > limits.total_bytes:
                break
            chosen.append(name)
            total += size
        return chosen


def lookup(
    df: DataFrame,
    side: SideTable,
    columns: dict[str, str | int],
    found: str = "{}_found",
    key: str | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Add for each column its payload, null where the value is null or has no entry.

    `columns` maps a column of `df` to the name of its entries. Where a column is too large
    to broadcast, the frame is written out once with a key of its own, so that the result is
    the same on either way, whatever `key` the caller has.
    """
    small_names = set(side.broadcastable(sorted(set(columns.values())), limits))
    small = {c: n for c, n in columns.items() if n in small_names}
    large = {c: n for c, n in columns.items() if n not in small_names}
    out = _large_lookup(df, side.entries, large, found, limits) if large else df
    return _broadcast_join(out, side.entries, small, {c: found.format(c) for c in small}) if small else out


_JOINS_AT_ONCE = 5


def _broadcast_join(
    df: DataFrame, entries: DataFrame, columns: dict[str, str], added: dict[str, str]
) -> DataFrame:
    """One left join per column against its own entries; `added` names the new columns.

    Several in one statement: dozens of joins are then analysed a few times, not once per join. All joins of
    a statement become one generated method, and the JVM only compiles methods of up to 8000 bytes, so it ends
    behind `_JOINS_AT_ONCE` of them: at a coalesce that leaves the parts as they are.
    """
    names = list(columns)
    for first in range(0, len(names), _JOINS_AT_ONCE):
        df = _joined(df, entries, {c: columns[c] for c in names[first : first + _JOINS_AT_ONCE]}, added)
        if len(names) > _JOINS_AT_ONCE:
            df = df.coalesce(_MORE_PARTS_THAN_ANY)
    return df


_MORE_PARTS_THAN_ANY = 1 << 30


def _joined(df: DataFrame, entries: DataFrame, columns: dict[str, str], added: dict[str, str]) -> DataFrame:
    kind = entries.schema["value"].dataType.simpleString()
    joins, new = [], []
    for i, (column, name) in enumerate(columns.items()):
        joins.append(
            f"LEFT JOIN (SELECT value, payload FROM {{entries}} WHERE name = {_literal(name)}) v{i} "
            f"ON CAST(r.{_quoted(column)} AS {kind}) = v{i}.value"
        )
        new.append(f"v{i}.payload AS {_quoted(added[column])}")
    hints = ", ".join(f"v{i}" for i in range(len(columns)))
    return df.sparkSession.sql(
        f"SELECT /*+ BROADCAST({hints}) */ r.*, {', '.join(new)} FROM {{rows}} r {' '.join(joins)}",
        rows=df,
        entries=entries,
    )


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``").replace("{", "{{").replace("}", "}}") + "`"


def _literal(value: str | int) -> str:
    return str(value) if isinstance(value, int) else _text(value)


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + escaped.replace("{", "{{").replace("}", "}}") + "'"


def _pairs(df: DataFrame, key: str, columns: dict[str, str], values: list[Column]) -> DataFrame:
    """`(key, column, name, value)` of the values that are not null."""
    names = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])
    return (
        df.select(key, *values)
        .unpivot([key], list(columns), "column", "value")
        .where(F.col("value").isNotNull())
        .withColumn("name", names[F.col("column")])
    )


def _front(keyed: DataFrame, key: str, entries: DataFrame, columns: dict[str, str], limits: Limits) -> DataFrame:
    """Entries of the values worth a broadcast; unseen ones have an empty payload.

    They are the head of the side table, at most `head_entries` per column, and the values that
    are frequent in this input. Those have more than one in `head_entries` of the rows, so there
    cannot be more than that per column, and no other value is a large share of the rows.
    """
    kind = entries.schema["value"].dataType
    head = entries.where(F.col("rank") <= limits.head_entries).select("name", "value", "payload")
    pairs = _pairs(keyed, key, columns, [F.col(c).cast(kind).alias(c) for c in columns])
    share = keyed.count() // limits.head_entries + 1
    hot = materialize(
        pairs.join(F.broadcast(head.select("name", "value")), ["name", "value"], "left_anti")
        .groupBy("name", "value")
        .count()
        .where(F.col("count") >= max(limits.hot_rows, share))
        .select("name", "value"),
        "hot",
    )
    known = entries.join(F.broadcast(hot), ["name", "value"]).select("name", "value", "payload")
    both = head.unionByName(hot.join(known, ["name", "value"], "left"))
    return both.select("name", "value", F.struct("payload").alias("payload"))


_BITS_PER_ENTRY, _HASHES = 10, 4


def _bit(i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(i), F.col("name"), F.col("value")), F.lit(bits))


def tail_filter(tail: DataFrame, limits: Limits) -> tuple[DataFrame, int]:
    """A Bloom filter of `(name, value)` as one row with an array of 64-bit words, and its bits.

    Sized by the measured number of entries, ten bits each, up to `filter_bits`.
    """
    bits = max(64, min(limits.filter_bits, _BITS_PER_ENTRY * tail.count()))
    words = -(-bits // 64)
    places = tail.select(F.explode(F.array(*[_bit(i, bits) for i in range(_HASHES)])).alias("_at"))
    word = F.shiftright("_at", 6).alias("word")
    filled = places.select(word, F.expr("shiftleft(1L, CAST(_at & 63 AS INT))").alias("bit")).groupBy("word")
    table = filled.agg(F.bit_or("bit").alias("bit")).toArrow()  # at most filter_bits / 64 rows
    array = np.zeros(words, np.int64)
    array[table["word"].to_numpy()] = table["bit"].to_numpy()
    row = pa.table({"_words": pa.ListArray.from_arrays(pa.array([0, words], pa.int32()), pa.array(array))})
    return tail.sparkSession.createDataFrame(row), bits


def maybe_in_tail(pairs: DataFrame, tail: DataFrame, limits: Limits) -> DataFrame:
    """The `(name, value)` pairs that may have an entry: all that have one, one in eighty of the others."""
    row, bits = tail_filter(tail, limits)
    hit = F.lit(True)
    for i in range(_HASHES):
        word = F.get("_words", F.shiftright(_bit(i, bits), 6).cast("int"))
        shift = (_bit(i, bits) % 64).cast("int")
        hit = hit & (F.call_function("shiftrightunsigned", word, shift) % 2 != 0)
    return pairs.join(F.broadcast(row), hit).drop("_words")  # one row, so no pair is repeated


def _large_lookup(
    df: DataFrame, entries: DataFrame, columns: dict[str, str], found: str, limits: Limits
) -> DataFrame:
    """Frequent values are settled in place by broadcast; only the others are shuffled.

    The frame is written once, with a key of its own, because a join back needs one row each.
    A value without an entry needs no row of the shuffled join, and few get one.
    """
    key, kind = "_lookup_key", entries.schema["value"].dataType
    keyed = materialize(df.withColumn(key, F.monotonically_increasing_id()), "keyed")
    entries = entries.where(F.col("name").isin(sorted(set(columns.values()))))
    front = materialize(_front(keyed, key, entries, columns, limits), "front")
    settled_as = {c: f"_front_{i}" for i, c in enumerate(columns)}
    late_as = {c: f"_late_{i}" for i, c in enumerate(columns)}
    settled = _broadcast_join(keyed, front, columns, settled_as)
    open_ = [F.when(F.col(settled_as[c]).isNull(), F.col(c).cast(kind)).alias(c) for c in columns]
    tail = entries.where(F.col("rank") > limits.head_entries).select("name", "value", "payload")
    late = (
        maybe_in_tail(_pairs(settled, key, columns, open_), tail, limits)
        .join(tail, ["name", "value"])
        .groupBy(key)
        .agg(*[_only(c).alias(late_as[c]) for c in columns])
    )
    payloads = [
        F.coalesce(F.col(settled_as[c])["payload"], F.col(late_as[c])).alias(found.format(c)) for c in columns
    ]
    return settled.join(late, key, "left").select(*df.columns, *payloads)


def _only(column: str) -> Column:
    return F.first(F.when(F.col("column") == column, F.col("payload")), ignorenulls=True)
