"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document when the document holds at least `threshold` of the item's
distinct five-word shingles. Words are runs of letters and digits, A-Z lower-cased. An item of
fewer words has one shingle, all its words; documents are held against it by shingles of that
width, so a short item is found wherever its words stand one after the other.

Search: items are partitioned by the size of their shingle set, in powers of two, and each
keeps as sketch its smallest hashes, as many as its partition needs: a document with at
least `threshold` of q shingles misses at most (1 - threshold) q of them, so of a sketch of
k > (1 - threshold) q it holds at least k - floor((1 - threshold) q). A document with fewer hits
cannot contain the item; the others are verified on the full shingle sets.

Empty and null texts have no shingles: such items match nothing and such documents are never
matched. Repeated rows give repeated results, an empty table gives an empty one, and only the
needed columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.text import NOT_WORD, adjacent, lower_ascii, once, words
from clickloom.storage import materialize

WORDS = 5
THRESHOLD = 0.8
#: A run of so many words is fixed by two runs of fewer, so many words apart.
_MADE_OF = {2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1)}


def _shingled(df: DataFrame, text: str, widths: list[int]) -> DataFrame:
    """Add `_n_words` and `_sets`: for each width the distinct shingles of that many words, as hashes."""
    needed = {1, *widths}
    while extra := {_MADE_OF[w][0] for w in needed if w in _MADE_OF} - needed:
        needed |= extra
    out = df.withColumn("_words", once(words(lower_ascii(F.col(text)), NOT_WORD)))
    out = out.withColumn("_w1", F.transform("_words", lambda w: F.xxhash64(w)))
    for width in sorted(needed - {1}):
        half, step = _MADE_OF[width]
        out = out.withColumn(f"_w{width}", adjacent(F.col(f"_w{half}"), step))
    sets = [_of_width(w) for w in widths]
    out = out.withColumn("_n_words", F.size("_words"))
    out = out.withColumn("_sets", once(F.array(*sets)) if sets else F.array(F.array().cast("array<bigint>")))
    return out.drop("_words", *[f"_w{w}" for w in needed])


def _of_width(width: int) -> Column:
    return F.array_distinct(F.transform(f"_w{width}", lambda h: F.xxhash64(F.lit(width), h)))


def _missing(q: Column, threshold: float) -> Column:
    """The most of q shingles that a document may lack."""
    return F.floor(F.lit(round(1 - threshold, 9)) * q + 1e-9)


def item_sketches(items: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """`item, n_item, _set, size_class, sketch, least` for every item with a word.

    `least` is the number of hits in the sketch that a document needs. Items of one key are one item
    per row; equal rows are told apart by their number only in the result, where they give equal rows.
    """
    q = F.size("_set")
    largest = F.pow(F.lit(2.0), F.col("size_class") + 1) - 1  # set size in this partition
    enough = (_missing(largest, threshold) + 1).cast("int")
    every = _shingled(items.select(F.col(key).alias("item"), F.col(text).alias("_t")), "_t", list(range(1, WORDS + 1)))
    return (
        every.drop("_t")
        .where("_n_words > 0")
        .withColumn("_set", F.element_at("_sets", F.least(F.lit(WORDS), F.col("_n_words"))))
        .withColumn("n_item", q.cast("long"))
        .withColumn("size_class", F.floor(F.log2(q)).cast("int"))
        .withColumn("sketch", F.slice(F.array_sort("_set"), F.lit(1), F.least(enough, q)))
        .withColumn("least", F.size("sketch") - _missing(q, threshold))
        .withColumn("width", F.least(F.lit(WORDS), F.col("_n_words")))
        .drop("_sets", "_n_words")
    )


def contained_items(
    df: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document row and item contained in it: key, item key, sizes, containment.

    Sketches and candidates are written, so Spark knows their size before it decides to
    broadcast them. The first pass over the texts joins hashes with sketch values; partial
    counts keep a document's repeated hits out of the shuffle. The second pass joins texts
    with candidate documents only, by document, so a frequent passage is no hot key.
    """
    sketches = materialize(
        item_sketches(items, item_key, item_text, threshold)
        .withColumn("item_row", F.xxhash64("item", "_set")),
        "item-sketches",
    )
    probes = materialize(
        sketches.select(F.explode("sketch").alias("value"), "item_row", "size_class", "n_item", "least").distinct(), "item-probes"
    )
    widths = sorted(r["width"] for r in sketches.select("width").distinct().collect())  # five at most
    rows = df.select(
        F.col(key).alias("_id"), F.col(text).alias("_t"), F.xxhash64(F.col(key), F.col(text)).alias("_row")
    )
    shingled = _shingled(rows, "_t", widths).select("_row", F.flatten("_sets").alias("_set"))
    candidates = materialize(
        shingled.select("_row", F.size("_set").alias("_n"), F.explode("_set").alias("value"))
        .join(probes, "value")
        .where(F.col("_n") >= F.lit(threshold) * F.col("n_item"))  # too small to hold enough
        .groupBy("_row", "item_row", "least")
        .agg(F.count("*").alias("sketch_hits"))
        .where("sketch_hits >= least"),
        "leak-candidates",
    )
    suspects = candidates.select("_row").distinct()
    checked = (
        _shingled(rows.join(suspects, "_row", "left_semi"), "_t", widths)
        .withColumn("_doc_set", F.flatten("_sets"))
        .join(candidates, "_row")
        .join(sketches.select("item_row", "item", "n_item", "_set"), "item_row")
    )
    shared = F.size(F.array_intersect("_doc_set", "_set")).cast("long")
    return (
        checked.select(F.col("_id").alias(key), F.col("item").alias(item_key), "n_item", shared.alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
        .where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item") - 1e-9)
    )


def clean_documents(df: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The rows of `df`, all columns, that contain no item."""
    key, text = names.get("key", "doc_id"), names.get("text", "text")
    keyed = df.select(F.col(key), F.col(text)).withColumn("_row", F.xxhash64(key, text))
    bad = contained_items(
        keyed.select(F.col("_row").alias("_id2"), F.col(text).alias("_t2")), items, "_id2", "_t2",
        **{k: v for k, v in names.items() if k not in ("key", "text")},
    ).select("_id2").distinct()
    bad = materialize(bad, "leaks")
    return df.join(bad, F.xxhash64(df[key], df[text]) == bad["_id2"], "left_anti")


def leaks_query(df: DataFrame, items: DataFrame) -> DataFrame:
    return contained_items(df, items)


_WORDS_SQL = r"""list_filter(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


def _sets_sql(table: str, key: str, widths: str) -> str:
    """The shingles of each row, of the widths that the SQL names (`width`), which may look at `n`."""
    return f"""
  SELECT DISTINCT r, {key}, width, array_to_string(w[i:i + width - 1], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, n - width + 2)) AS i FROM (SELECT *, {widths} FROM (
    SELECT *, len(w) AS n FROM (SELECT row_number() OVER () AS r, {key}, {_WORDS_SQL} AS w FROM {table}))) WHERE n >= width AND n > 0)"""


LEAKS_SQL = f"""
WITH i AS MATERIALIZED ({_sets_sql('benchmark', 'item_id', f'least(n, {WORDS}) AS width')}),
b AS (SELECT *, count(*) OVER (PARTITION BY r) AS n_item FROM i),
d AS ({_sets_sql('documents', 'doc_id', 'unnest((SELECT list(DISTINCT width) FROM i)) AS width')})
SELECT doc_id, item_id, n_item::BIGINT AS n_item, count(*)::BIGINT AS n_shared, count(*) / n_item AS containment
FROM d JOIN b USING (width, shingle) GROUP BY d.r, b.r, doc_id, item_id, n_item
HAVING count(*) >= {THRESHOLD} * n_item - 1e-9
"""
