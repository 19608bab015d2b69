"""Line dedup: a deletion-neighbourhood join over the lines of all documents.

A line counts without the blanks around it; lines of blanks only are left alone. Of equal
lines, however short, the earliest stays, and of lines of at least `near_least` characters
(20) within `edits` edits (one; a character inserted, deleted or replaced each) of each other the
earliest stays too: a line goes when any earlier line equals it or is that near, whether that one
stays or not. Earlier means by document key (null last), then the text's hash, then line number.

Neighbours share a variant. Align two lines within the bound: what they have in common is left of
each when at most `edits` characters are deleted, and what was deleted stood in at most `edits` gaps.
So every line emits, for each of its variants, a hash of the variant with each set of `edits` gaps
that holds its own. Lines with one such hash differ in these gaps only: all of them are within the
bound of each other, so it is enough to compare the earliest with the rest, by edit distance.
Hot groups are reduced before the shuffle, and no group is expanded into pairs.

Emitting variants for all lines would multiply the text, so a gate that loses nothing comes
first. Cut into one part more than there may be edits, a line has a part that its neighbour has too,
at the same place but for the edits before it. Parts that two different lines have go into a filter
of bits, which each task holds against its own lines; lines without such a part have no
neighbour. Hashes of variants that two lines have are found, and told from the others, in the same
way, so lines and variants are shuffled as pairs of numbers, and only once each.

A variant for every place makes about two hashes a character for one edit, and as many as the square
of that for two, which is the most allowed. Null and empty texts have no lines. Rows of one key and
one text are one document and share its fate. An empty table gives an empty result; only needed
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.cascade import Level, filled, mixed
from clickloom.llm.text import once
from clickloom.storage import materialize

LEAST = 20  # characters of a line that is compared by edits
EDITS, MOST_EDITS = 1, 2
FILTER_BITS = 1 << 30  # at most; with more keys than that can tell apart, more lines pass
FETCH_ROWS = 1_000_000  # lines whose places are broadcast to the texts; more are joined by a shuffle
BASE = 0x9E3779B97F4A7C15 | 1
TRIM = " \t\r\x0b\x0c"


def row_key(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


def lines_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """`doc, line` and the order, class hashes and text of every line that is not blank."""
    line = F.btrim("line", F.lit(TRIM))
    out = df.select(F.col(key).alias("id"), row_key(key, text).alias("doc"), once(F.split(text, "\n")).alias("_lines"))
    return (
        out.select("id", "doc", F.posexplode("_lines").alias("n", "line"))
        .select("id", "doc", "n", line.alias("line"))
        .where(F.length("line") > 0)
        .select(
            F.struct(F.col("id").isNull().alias("last"), "id", "doc", "n").alias("at"),
            F.struct(F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b")).alias("cls"),
            "line",
        )
    )


def part_places(edits: int) -> list[tuple[int, int, int]]:
    """Which parts to emit: (characters more than the shorter line, number of the part, its shift).

    Of the parts that an alignment leaves untouched, the first will do. Each part before it has an
    edit, and shifts it by at most one; the edits behind it must make up the rest of the difference.
    """
    out = []
    for longer in range(edits + 1):
        for part in range(edits + 1):
            for shift in range(-edits, edits + 1) if part else (0,):
                if (max(part, abs(shift)) if part else 0) + abs(longer - shift) <= edits:
                    out.append((longer, part, shift))
    return out


def part_keys(line: Column, edits: int) -> Column:
    """A hash per place of `part_places`, null where the line is too short for it."""
    keys = []
    for longer, part, shift in part_places(edits):
        base = F.length(line) - longer
        cut = [F.floor(base * j / (edits + 1)).cast("int") for j in (part, part + 1)]
        fits = (base >= 0) & (cut[0] + shift >= 0) & (cut[1] + shift <= F.length(line))
        text = line.substr(cut[0] + shift + 1, cut[1] - cut[0])
        keys.append(F.when(fits, F.xxhash64(base, F.lit(part), text)))
    return F.array(*keys)


def _key(variant: np.ndarray | np.uint64, *gaps: np.ndarray) -> np.ndarray:
    out = variant
    for i, gap in enumerate(gaps):
        out = mixed(np.asarray(out, np.uint64) ^ (np.asarray(gap).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), i + 1)
    return out.view(np.int64)


def variant_keys(line: str, edits: int, ranges: list[tuple[int, int]]) -> Iterator[np.ndarray]:
    """Hashes of the variants of a line with sets of `edits` gaps, in pieces.

    A variant's own hash is a polynomial over its code points, so that each follows from one running
    sum. `ranges` says from which gap to which the edits can stand, and counts for one edit.
    """
    with np.errstate(over="ignore"):
        code = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = len(code)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(BASE))]))
        before = np.concatenate([[np.uint64(0)], np.cumsum(mixed(code, 9) * powers[:n])])
        back = np.uint64(pow(BASE, -1, 1 << 64))
        without = before[:-1] + (before[-1] - before[1:]) * back
        if edits == 1:
            wanted = np.zeros(n + 1, bool)
            for low, high in ranges:
                wanted[low : high + 1] = True
            gap = np.flatnonzero(wanted)
            yield _key(before[-1], gap)
            yield _key(without[gap[gap < n]], gap[gap < n])
            return
        gaps = np.arange(n + 1)
        for p in range(n + 1):
            yield _key(before[-1], np.full(n + 1 - p, p), gaps[p:])
            if p < n:
                other = gaps[:n]
                yield _key(without[p], np.minimum(p, other), np.maximum(p, other))
                later = gaps[p + 1 : n]
                both = before[p] + (before[later] - before[p + 1]) * back + (before[-1] - before[later + 1]) * back * back
                yield _key(both, np.full(len(later), p), later - 1)


def _ranges(size: int, which: list[int], edits: int) -> list[tuple[int, int]]:
    """The gaps outside the part that a line shares, for each of its shared parts."""
    out = []
    for longer, part, _ in (part_places(edits)[i] for i in which):
        cut = (size - longer) // 2
        out.append((0, cut + longer) if part else (cut, size))
    return out


def filter_of(keys: DataFrame) -> Level:
    """A filter of bits with the numbers in `k1`; one in a million others passes it too.

    All lines are held against it, and few have what it holds: with an error of one in a hundred
    most of those that pass would have no neighbour.
    """
    keys = keys.withColumn("k2", F.col("k1"))
    return filled(Level(0, 20, max(64, min(FILTER_BITS, 30 * keys.count()))), keys)


def _inside(level: Level, values: np.ndarray) -> np.ndarray:
    return level.has(values, values)


def with_known_parts(lines: DataFrame, known: Level) -> DataFrame:
    """`at, cls, which`: the lines that have a part in the filter, and which of their parts."""
    shared = lines.sparkSession.sparkContext.broadcast(known)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            flat = parts.flatten()
            asked = np.flatnonzero(flat.is_valid().to_numpy(zero_copy_only=False))
            hit = np.zeros(len(flat), bool)
            hit[asked] = _inside(shared.value, flat.fill_null(0).to_numpy(zero_copy_only=False)[asked])
            size = parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            rows = np.flatnonzero(np.bincount(row[hit], minlength=len(size)))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[hit], minlength=len(size))[rows])]).astype(np.int32)
            which = pa.ListArray.from_arrays(pa.array(ends), pa.array(place[hit].astype(np.int32)))
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column("at").take(at), batch.column("cls").take(at), which], ["at", "cls", "which"])

    at, cls = lines.select("at").schema["at"].dataType.simpleString(), lines.schema["cls"].dataType.simpleString()
    return lines.select("at", "cls", "parts").mapInArrow(kept, f"at {at}, cls {cls}, which array<int>")


def emitted(suspects: DataFrame, edits: int, known: Level | None = None) -> DataFrame:
    """`k1, c`: the variants' hashes of each line (`c, line, which`), or those of them in a filter."""
    shared = suspects.sparkSession.sparkContext.broadcast(known) if known else None

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, size = [], [], 0
        for batch in batches:
            for c, line, which in zip(*(batch.column(x).to_pylist() for x in ("c", "line", "which")), strict=True):
                for piece in variant_keys(line, edits, _ranges(len(line), which, edits) if edits == 1 else []):
                    if shared:
                        piece = piece[_inside(shared.value, piece)]
                    held.append(piece)
                    names.append(np.full(len(piece), c, np.int64))
                    size += len(piece)
                    if size > 100_000:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held)), pa.array(np.concatenate(names))], ["k1", "c"])
                        held, names, size = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held)), pa.array(np.concatenate(names))], ["k1", "c"])

    return suspects.select("c", "line", "which").mapInArrow(keys, "k1 bigint, c bigint")


def shared_keys(keyed: DataFrame) -> DataFrame:
    """The numbers `k1` that stand with two different classes `c`."""
    return keyed.groupBy("k1").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low != high").select("k1")


def texts_of(df: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """`wanted` (`at` and more) with the `line` that stands there."""
    places = wanted.withColumn("doc", F.col("at.doc"))
    rows = df.select(row_key(key, text).alias("doc"), F.col(text).alias("_t"))
    joined = rows.join(F.broadcast(places) if places.count() <= FETCH_ROWS else places, "doc")
    line = F.btrim(F.element_at(F.split("_t", "\n"), F.col("at.n") + 1), F.lit(TRIM))
    return joined.select(*wanted.columns, line.alias("line")).dropDuplicates(["cls"])


def near_lines(df: DataFrame, lines: DataFrame, key: str, text: str, edits: int) -> DataFrame:
    """`cls, near`: the classes with an earlier neighbour, and where the earliest one stands.

    `lines` are `at, cls, parts` of the lines of `df`; lines without parts are not compared.
    """
    parts = lines.select(F.explode("parts").alias("k1"), F.col("cls.a").alias("c")).where("k1 IS NOT NULL")
    known = filter_of(materialize(shared_keys(parts), "line-parts"))
    firsts = with_known_parts(lines.where("parts IS NOT NULL"), known).groupBy("cls").agg(
        F.min("at").alias("at"), F.first("which").alias("which")
    )
    firsts = materialize(firsts.withColumn("c", F.col("cls.a")), "line-suspects")
    suspects = materialize(texts_of(df, firsts, key, text), "line-texts")
    common = filter_of(materialize(shared_keys(emitted(suspects, edits)), "line-variants"))
    met = materialize(emitted(suspects, edits, common).distinct(), "line-met")
    named = suspects.select("c", "cls", "at")
    members = met.join(named, "c")
    first = members.groupBy("k1").agg(F.min("at").alias("other"), F.max("at").alias("top")).where("other != top").drop("top")
    pairs = members.join(first, "k1").where(F.col("other") < F.col("at")).select("cls", "other").distinct()
    partner = suspects.select(F.col("at").alias("other"), F.col("line").alias("other_line"))
    return (
        pairs.join(suspects.select("cls", "line"), "cls")
        .join(partner, "other")
        .where(F.levenshtein("line", "other_line", edits) >= 0)
        .groupBy("cls").agg(F.min("other").alias("near"))
    )


def duplicate_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", near_least: int = LEAST, edits: int = EDITS
) -> DataFrame:
    """`doc, key, line, reason, first_key, first_line`: every line that goes, by document row.

    Line numbers count from 0. `reason` is `near` where an earlier neighbour was found before
    any equal line, else `exact`. Only classes that repeat or have a neighbour are joined back
    to the lines, by class: a frequent line is a skewed key of that join, which Spark splits.
    """
    if not 1 <= edits <= MOST_EDITS:
        raise ValueError(f"1 to {MOST_EDITS} edits")
    parts = once(F.when(F.length("line") >= near_least, part_keys(F.col("line"), edits))).alias("parts")
    lines = materialize(lines_of(df, key, text).select("at", "cls", parts), "lines")
    near = materialize(near_lines(df, lines, key, text, edits), "line-near")
    lines = lines.select("at", "cls")
    verdicts = (
        lines.groupBy("cls").agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .join(near, "cls", "left")
        .where(F.col("near").isNotNull() | (F.col("first") != F.col("last")))
        .drop("last")
    )
    gone = (F.col("at") != F.col("first")) | F.col("near").isNotNull()
    where = F.coalesce("near", "first")
    return (
        lines.join(materialize(verdicts, "line-verdicts"), "cls").where(gone)
        .select(
            F.col("at.doc").alias("doc"), F.col("at.id").alias(key), F.col("at.n").alias("line"),
            F.when(F.col("near").isNotNull(), "near").otherwise("exact").alias("reason"),
            where["id"].alias(f"first_{key}"), where["n"].alias("first_line"),
        )
        .distinct()  # rows of one key and one text are one document
    )


def drop_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = None, near_least: int = LEAST, edits: int = EDITS
) -> DataFrame:
    """The rows of `df`, all columns, without their duplicate lines.

    A row of whose words nothing is left goes too. Rows that lose no line stay as they are; in
    the others a column named by `length` gets the new number of characters.
    """
    gone = duplicate_lines(df, key, text, near_least, edits).groupBy("doc").agg(F.collect_list("line").alias("gone"))  # of one text
    rows = df.select(F.struct("*").alias("all"), row_key(key, text).alias("_doc"), F.split(text, "\n").alias("lines"))
    rows = rows.join(gone, F.col("_doc") == F.col("doc"), "left")
    rest = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    lines, kept = F.col("lines"), F.col("gone").isNull()
    rows = rows.withColumn("short", F.when(~kept, F.array_join(F.transform(rest, lambda i: lines[i]), "\n")))
    cut = F.col("all").withField(text, F.col("short"))
    if length:
        cut = cut.withField(length, F.length("short").cast(df.schema[length].dataType))
    rows = rows.where(kept | F.col("short").rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(F.when(kept, F.col("all")).otherwise(cut).alias("all")).select("all.*")


def lines_query(df: DataFrame, near_least: int = LEAST, edits: int = EDITS) -> DataFrame:
    """Per document: lines that are not blank, lines gone for either reason, their numbers."""
    gone = duplicate_lines(df, near_least=near_least, edits=edits).groupBy("doc").agg(
        F.sum((F.col("reason") == "exact").cast("long")).alias("n_exact"),
        F.sum((F.col("reason") == "near").cast("long")).alias("n_near"),
        F.array_join(F.array_sort(F.collect_list("line")), ",").alias("dropped"),
    )
    trimmed = F.transform(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")))
    filled = F.size(F.filter(trimmed, lambda x: F.length(x) > 0)).cast("long")
    return (
        df.select("doc_id", row_key("doc_id", "text").alias("doc"), F.coalesce(filled, F.lit(0)).alias("n_lines"))
        .join(gone, "doc", "left")
        .select(
            "doc_id", "n_lines", F.coalesce("n_exact", F.lit(0)).alias("n_exact"),
            F.coalesce("n_near", F.lit(0)).alias("n_near"), F.coalesce("dropped", F.lit("")).alias("dropped"),
        )
    )
