"""Near duplicates by MinHash: one permutation, optimal densification, bands, stars.

A document's set holds its distinct word shingles. Documents are linked when 100 times the
intersection is at least 80 times the union; components of links are groups.

* Equal sets are one class from the start, so thousands of copies cost one signature.
* One hash of each shingle picks its bin and its value; the smallest value of a bin is the
  signature there. An empty bin borrows from the first filled bin of its own random sequence,
  the same for all documents, which keeps bins independent for short texts too.
* `ROWS` bins make a band, equal bands a bucket. At a similarity of 0.8 a pair shares none of
  the 42 bands with probability (1 - 0.8^6)^42 = 3e-6.
* In each bucket the member with the most company over all its buckets is the centre of a star;
  only centre and member are compared, on their full sets. A hot bucket costs one pair a member.
* Stars leave out pairs whose ends both differ from the centre. A bucket is settled when its
  members are of one component. The members of all other buckets are joined once more by their
  rarest shingles (prefix filter), which loses no link between them, whatever the bucket.

Null and empty texts have no shingles: they are linked with nothing and are groups of their
own. Fewer words than a shingle make one shingle of the whole sequence. Rows of one key and
one text are copies of each other. Null keys take part, and the smallest key of a group is the
smallest that is not null. An empty table gives an empty result; only needed columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.components import components
from clickloom.llm.text import BLANKS, lower_ascii, with_shingles, words
from clickloom.storage import materialize

BINS = 256
ROWS = 6
BANDS = BINS // ROWS
SLOTS = 1 << 20
SALTS = 16  # parts of a group when its component is joined back
EMPTY = np.uint64(2**64 - 1)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(salt)) * np.uint64(0x9FB21C651E98DF25)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def signatures(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Densified one-permutation signatures, a row of `BINS` per set; no set may be empty."""
    n = len(offsets) - 1
    hashed = _mix(flat.view(np.uint64), 0x1B873593)
    row = np.repeat(np.arange(n), np.diff(offsets))
    out = np.full(n * BINS, EMPTY)
    np.minimum.at(out, row * BINS + (hashed >> np.uint64(56)).astype(np.int64), hashed)
    out = out.reshape(n, BINS)
    empty = out == EMPTY
    rows, bins = np.nonzero(empty)
    attempt = 0
    while len(rows):
        attempt += 1
        donor = (_mix(bins.astype(np.uint64) + np.uint64(attempt << 8), 0x7F4A7C15) >> np.uint64(40)).astype(np.int64) % BINS
        found = ~empty[rows, donor]
        # The borrowed value is told apart from the donor's own place by the bin it now stands in.
        out[rows[found], bins[found]] = out[rows[found], donor[found]]
        rows, bins = rows[~found], bins[~found]
    return out


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One hash per band, told apart by the band's number."""
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), 1))
    for i in range(ROWS):
        out = _mix(out ^ signature[:, i : BANDS * ROWS : ROWS], 0xC2B2AE35 + i)
    return out


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, class and bands of every set. The class is a sum and an exclusive or of mixed hashes."""
    for batch in batches:
        for first in range(0, batch.num_rows, 2000):
            part = batch.slice(first, 2000)
            lists = part.column("_set")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            full = sizes > 0
            digest = np.zeros((len(sizes), 2), np.uint64)
            bands = np.zeros((len(sizes), BANDS), np.uint64)
            if full.any():
                at = starts[:-1][full]
                with np.errstate(over="ignore"):
                    digest[full, 0] = np.add.reduceat(_mix(flat.view(np.uint64), 3), at)
                digest[full, 1] = np.bitwise_xor.reduceat(_mix(flat.view(np.uint64), 5), at)
                bands[full] = band_hashes(signatures(flat, np.append(at, len(flat))))
            cls = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(sizes), [None, pa.py_buffer(digest.tobytes())])
            ends = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[full].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("id"), pa.array(sizes), cls.cast(pa.binary()), listed],
                ["row", "id", "n", "cls", "bands"],
            )


def shingled(df: DataFrame, text: str, shingle: int) -> DataFrame:
    """Add `_set`, the distinct shingles."""
    out = df.withColumn("_words", words(lower_ascii(F.col(text)), BLANKS))
    return with_shingles(out, "_words", shingle, "_set").drop("_words")


def described(rows: DataFrame, shingle: int) -> DataFrame:
    """`row, id, n, cls, bands` of every row of `row, id, text`."""
    sets = shingled(rows, "text", shingle).select("row", "id", "_set")
    kind = rows.schema["id"].dataType.simpleString()
    return sets.mapInArrow(_described, f"row bigint, id {kind}, n bigint, cls binary, bands array<bigint>")


def stars(buckets: DataFrame) -> DataFrame:
    """The star of each bucket as pairs `a < b`, each pair once."""
    sized = buckets.groupBy("bucket").agg(F.count("*").alias("size"))
    company = buckets.join(sized, "bucket").groupBy("cls").agg(F.sum("size").alias("company"))
    centre = buckets.join(company, "cls").groupBy("bucket").agg(F.max(F.struct("company", "cls")).alias("c"))
    pairs = buckets.join(centre.select("bucket", F.col("c.cls").alias("centre")), "bucket").where("cls != centre")
    return pairs.select(F.least("cls", "centre").alias("a"), F.greatest("cls", "centre").alias("b")).distinct()


def similar(size_a: str, size_b: str, shared: Column, per_cent: int) -> Column:
    """100 * shared >= per_cent * union, for a number of shared shingles or a bound on it."""
    union = F.col(size_a) + F.col(size_b) - shared
    return 100 * shared >= per_cent * union


def confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs that are links, by their full sets. Sizes alone drop the hopeless ones first."""
    sizes = sets.select("cls", F.size("_set").alias("n"))
    sized = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    near = sized.where(similar("na", "nb", F.least("na", "nb"), per_cent))
    both = near.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return both.where(similar("na", "nb", F.size(F.array_intersect("sa", "sb")), per_cent)).select("a", "b")


def _slot(shingle: np.ndarray) -> np.ndarray:
    return (_mix(shingle.view(np.uint64), 11) >> np.uint64(44)).astype(np.int64)


def shingle_frequencies(sets: DataFrame) -> np.ndarray:
    """About how many sets have a shingle, by slot: a table of fixed size, so it can go anywhere."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            total += np.bincount(_slot(batch.column("_set").flatten().to_numpy(zero_copy_only=False)), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])

    table = sets.select("_set").mapInArrow(counted, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, np.int64)
    out[table["slot"].to_numpy()] = table["n"].to_numpy()
    return np.minimum(out, 2**31 - 1).astype(np.int32)


def prefixes(sets: DataFrame, frequencies: np.ndarray, per_cent: int) -> DataFrame:
    """`t, place, probe, cls, label, n`: the rarest shingles of each set, in one order for all sets.

    Of two sets that are links, the smaller shares one of its first n - ceil(2 s / (1 + s) n) + 1
    shingles with the first n - ceil(s n) + 1 of the larger, in whatever order. With the rarest
    first, these are seldom the shingles that all members of a large group have.
    """
    shared = sets.sparkSession.sparkContext.broadcast(frequencies)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("_set").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch.column("_set").flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((flat, shared.value[_slot(flat)], doc))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            n = sizes[doc]
            long = n - -(-per_cent * n // 100) + 1
            short = n - -(-2 * per_cent * n // (100 + per_cent)) + 1
            for probe, length in ((True, long), (False, short)):
                at = np.flatnonzero(place < length)
                who = pa.array(doc[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat[order[at]]), pa.array(place[at]), pa.array(np.full(len(at), probe)),
                     batch.column("cls").take(who), batch.column("label").take(who), pa.array(n[at])],
                    ["t", "place", "probe", "cls", "label", "n"],
                )

    return sets.select("cls", "label", "_set").mapInArrow(
        rarest, "t bigint, place bigint, probe boolean, cls binary, label binary, n bigint"
    )


def remainder(buckets: DataFrame, labels: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs `a < b` across components that could be links, among members of unsettled buckets.

    Of the classes with a shingle in their prefix, only those outside its most frequent component
    are held against the others, so the members of a large group never meet each other.
    """
    labelled = buckets.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "cls"))
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("m")).where("l != m")
    unsettled = labelled.join(mixed.select("bucket"), "bucket").select("cls", "label").distinct()
    members = materialize(sets.join(unsettled, "cls"), "near-unsettled")
    rows = materialize(prefixes(members, shingle_frequencies(members), per_cent), "near-prefixes")
    main = (
        rows.groupBy("t", "label").agg(F.count("*").alias("size"))
        .groupBy("t").agg(F.max(F.struct("size", "label"))["label"].alias("main"), F.count("*").alias("_labels"))
        .where("_labels > 1").select("t", "main")
    )
    rows = rows.join(main, "t").withColumn("rim", F.col("label") != F.col("main")).drop("main")
    long = rows.where("probe").select("t", *[F.col(c).alias(f"{c}_b") for c in ("place", "cls", "label", "n", "rim")])
    short = rows.where("not probe").select("t", *[F.col(c).alias(f"{c}_a") for c in ("place", "cls", "label", "n", "rim")])
    shared = 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) - 1
    could = (F.col("label_a") != F.col("label_b")) & (F.col("n_a") <= F.col("n_b")) & similar("n_a", "n_b", shared, per_cent)
    pairs = short.where("rim_a").join(long, "t").where(could).unionByName(
        short.where("not rim_a").join(long.where("rim_b"), "t").where(could)
    )
    return pairs.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct()


def groups(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 2, per_cent: int = 80
) -> DataFrame:
    """One row per input row: `row, key, n_shingles, cls, label, component`.

    `row` hashes key and text, `cls` is the same for equal sets, `label` for all classes of a
    group, and `component` is the group's smallest key. Texts are read twice: for signatures,
    and for the full sets of classes that share a bucket; those are fetched by one row of each.
    """
    rows = df.select(F.xxhash64(key, text).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    all_rows = materialize(described(rows, shingle), "near-rows")
    found = all_rows.where("n > 0").groupBy("cls").agg(
        F.min("row").alias("row"), F.min("id").alias("first"), F.first("bands").alias("bands")
    )
    classes = materialize(found, "near-classes")
    exploded = classes.select("cls", F.explode("bands").alias("bucket"))
    shared = exploded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    buckets = materialize(exploded.join(shared, "bucket"), "near-buckets")
    wanted = classes.select("cls", "row").join(buckets.select("cls").distinct(), "cls", "left_semi")
    texts = rows.join(wanted, "row").dropDuplicates(["cls"])
    sets = materialize(shingled(texts, "text", shingle).select("cls", "_set"), "near-sets")
    links = materialize(confirmed(stars(buckets), sets, per_cent), "near-links")
    labels = components(links)
    more = materialize(confirmed(remainder(buckets, labels, sets, per_cent), sets, per_cent), "near-links")
    if not more.isEmpty():
        labels = components(labels.toDF("a", "b").unionByName(more))
    named = classes.select("cls", "first").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    named = materialize(named, "near-labels")
    alone = named.where("label IS NULL").select("cls", F.col("cls").alias("label"), F.col("first").alias("component"))
    # A large group is one label: its smallest key is found with partial minima, and given back in salted parts.
    linked = named.where("label IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int"))
    smallest = linked.groupBy("label").agg(F.min("first").alias("component"))
    spread = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = alone.unionByName(linked.join(spread, ["label", "salt"]).select("cls", "label", "component"))
    return all_rows.drop("bands").join(known, "cls", "left").select(
        "row", F.col("id").alias(key), F.col("n").alias("n_shingles"), "cls", "label",
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"),
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of `df`, all columns: of each group the one with the smallest key.

    Where that key is null or stands on several rows, the smallest text hash decides, and of
    rows of one key and one text one stays. Rows without shingles all stay.
    """
    grouped = groups(df, key, text, shingle, per_cent).where("n_shingles > 0")
    best = F.min(F.struct(F.col(key).isNull(), F.col(key), F.col("row")))["row"]
    kept = materialize(grouped.groupBy("label").agg(best.alias("_row")).select("_row"), "near-kept")
    rows = df.select(F.struct("*").alias("all"), F.xxhash64(key, text).alias("_id"), F.size(words(F.col(text))).alias("_words"))
    some = rows.where("_words > 0").join(kept, F.col("_id") == F.col("_row"), "left_semi").dropDuplicates(["_id"])
    return some.select("all").unionByName(rows.where("_words = 0").select("all")).select("all.*")


def near_query(df: DataFrame) -> DataFrame:
    out = groups(df)
    return out.select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"),
    )


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) > 1 THEN w[i] || ' ' || w[i + 1] ELSE w[1] END AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS set FROM s GROUP BY doc_id
), c AS (
  SELECT set, min(doc_id) AS rep, any_value(n) AS n FROM n GROUP BY set
), cs AS (
  SELECT rep, n, sh, row_number() OVER (PARTITION BY rep ORDER BY df, sh) AS place FROM (
    SELECT rep, c.n, sh, count(*) OVER (PARTITION BY sh) AS df FROM c JOIN s ON s.doc_id = c.rep)
), p AS (
  SELECT rep, n, sh FROM cs WHERE place <= n - ceil(0.8 * n) + 1
), cand AS (
  SELECT DISTINCT a.rep AS a, b.rep AS b FROM p a JOIN p b USING (sh)
  WHERE a.rep < b.rep AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), e AS (
  SELECT a, b FROM cand JOIN cs x ON x.rep = a JOIN cs y ON y.rep = b AND y.sh = x.sh
  GROUP BY a, b, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), ends AS (SELECT a, b FROM e UNION SELECT b, a FROM e
), reach AS (
  SELECT rep AS a, rep AS b FROM c UNION SELECT reach.a, ends.b FROM reach JOIN ends ON ends.a = reach.b
), comp AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component, w.doc_id) AS component_id,
       coalesce(component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (set) LEFT JOIN comp USING (rep)
"""
