"""Mix sources to target weights: Sainte-Laguë seats for equal-token blocks.

The words wanted in all are cut into blocks of `block_words`. Sources get whole blocks by
highest quotients of their targets; each source's blocks go on to its shards by highest
quotients of their sizes. Inside a shard the documents lie end to end in a seeded order,
and its first blocks are taken, going round a second time where the quota exceeds the shard.

A null text has size 0, a null source is a source of its own that comes last, repeated rows
lie side by side and take their places in any order, and an empty table gives an empty
result. Only the needed columns are read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.llm.text import words
from clickloom.storage import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MOST = 2  # times a source, or a document
BLOCK_WORDS = 64
SHARD_WORDS = 100_000  # of a shard at least; in large sources shards grow with the root of the source's size
SHARD_ROOTS = 20


def apportion(units: DataFrame, group: str, unit: str, votes: str, seats: str) -> DataFrame:
    """Add `quota`: the seats of each group dealt to its units by highest quotients.

    A unit's quotients are votes / (2 j + 1) for its seat j = 0, 1, ...; of all of a group's
    quotients the `seats` highest win, on a tie that of the smaller unit (a number).

    With V votes and N seats, rounding N v / V settles all but a few seats: with U units, no
    unit ends more than N v / V * U / (2 N) + 1 seats away from that. So only about 2.5 U
    quotients are ranked, whatever N is.
    """
    g = Window.partitionBy(group)
    exact = F.coalesce(F.col(seats) * F.col(votes) / F.nullif(F.sum(votes).over(g), F.lit(0)), F.lit(0.0))
    table = (
        units.withColumn("_exact", exact)
        .withColumn("_round", F.floor(F.col("_exact") + 0.5))
        .withColumn("_missing", F.col(seats) - F.sum("_round").over(g))
        .withColumn("_units", F.count("*").over(g))
    )
    far = F.ceil(F.col("_exact") * F.col("_units") / (2 * F.greatest(F.col(seats), F.lit(1)))) + 1
    up = F.col("_missing") > 0
    seat = F.when(up, F.col("_round") + F.col("_j")).otherwise(F.col("_round") - 1 - F.col("_j"))
    quotient = F.col(votes) / (2 * F.col("_seat") + 1)
    order = Window.partitionBy(group).orderBy(
        F.when(up, -quotient).otherwise(quotient), F.when(up, F.col(unit)).otherwise(-F.col(unit))
    )
    moved = (
        table.where(F.col("_missing") != 0)
        .withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), far - 1)))
        .withColumn("_seat", seat)
        .where(F.col("_seat") >= 0)
        .withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") <= F.abs("_missing"))
        .groupBy(group, unit)
        .agg(F.sum(F.signum("_missing")).cast("long").alias("_moved"))
    )
    return (
        table.join(moved, [group, unit], "left")
        .withColumn("quota", (F.col("_round") + F.coalesce("_moved", F.lit(0))).cast("long"))
        .drop("_exact", "_round", "_missing", "_units", "_moved")
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """One row per source: its place by code point (null last), size and target in words.

    Raising a common level, each source gets level * weight until it meets its cap. With the
    sources in the order of cap / weight, the level that spends the share is the largest of
    (share - caps so far) / (weight left), so one pass over the sources finds it. That pass
    and the ranks see one row per source, never a document.
    """
    one = Window.partitionBy("_all")
    per = (
        sizes.groupBy("_key", "source").agg(F.sum("size").alias("source_size"))
        .withColumn("_all", F.lit(0))
        .withColumn("_rank", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1)
    )
    place = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("_rank") % len(weights) + 1)
    per = per.withColumn("_weight", place).withColumn("_cap", MOST * F.col("source_size"))
    so_far = one.orderBy(F.col("_cap") / F.col("_weight"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    spent = lambda c: F.coalesce(F.sum(c).over(so_far), F.lit(0))
    left = F.lit(share) * F.sum("source_size").over(one) - spent("_cap")
    level = left / (F.sum("_weight").over(one) - spent("_weight"))
    return (
        per.withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(one))
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight")))
        .select("_all", "_key", "_rank", "source_size", "target")
    )


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    block_words: int = BLOCK_WORDS,
    seed: int = 0,
) -> DataFrame:
    """Words taken of every row: `key, size, source_size, target, shard, taken`.

    The text is read once, for its size and its place in the seeded order; everything after
    works on a narrow written table. A source is spread over shards, more of them and larger ones the
    larger it is (both grow with the root of its size beyond 25 million words), so neither a shard nor
    the list of a source's shards becomes a large group. The tables of sources
    and shards are written too, so that Spark broadcasts them only by their measured size.
    """
    said = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col(text))
    sizes = materialize(
        df.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("_key"),
            F.size(words(F.col(text))).cast("long").alias("size"),
            F.md5(said).alias("_order"),
        ),
        "mix-sizes",
    )
    block = F.lit(block_words)
    sources = source_targets(sizes, weights, share)
    sources = sources.withColumn("_seats", F.round(F.sum("target").over(Window.partitionBy("_all")) / block).cast("long"))
    shards = F.ceil(F.col("source_size") / F.greatest(F.lit(SHARD_WORDS), F.floor(SHARD_ROOTS * F.sqrt("source_size"))))
    sources = materialize(
        apportion(sources, "_all", "_rank", "target", "_seats")
        .withColumn("_shards", F.greatest(F.lit(1), shards))
        .select("_key", "_rank", "source_size", "target", "_shards", F.col("quota").alias("_blocks")),
        "mix-sources",
    )
    number = F.conv(F.substring("_order", 1, 8), 16, 10).cast("long")
    placed = sizes.join(sources, "_key").withColumn("shard", (number % F.col("_shards")).cast("int"))
    quotas = apportion(
        placed.groupBy("_rank", "shard", "_blocks").agg(F.sum("size").alias("_shard_size")),
        "_rank", "shard", "_shard_size", "_blocks",
    )
    quotas = materialize(
        quotas.select(
            "_rank", "shard", "_shard_size",
            F.least(F.col("quota") * block, MOST * F.col("_shard_size")).alias("_take"),
        ),
        "mix-quotas",
    )
    before = (
        Window.partitionBy("_rank", "shard").orderBy("_order", F.col("doc_id").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("_start")

    def lap(upto: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), upto - start))

    return (
        placed.withColumn("_start", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .join(quotas, ["_rank", "shard"])
        .select(
            F.col("doc_id").alias(key), "size", "source_size", "target", "shard",
            (lap(F.col("_take")) + lap(F.col("_take") - F.col("_shard_size"))).cast("long").alias("taken"),
        )
    )


def mix_query(df: DataFrame) -> DataFrame:
    return mix(df)


MIX_SQL = rf"""
WITH s AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size,
         md5(concat_ws(':', '0', doc_id::VARCHAR, text)) AS ord FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s GROUP BY source
), capped AS (
  SELECT *, {MOST} * source_size AS cap, [5, 2, 1][rank % 3 + 1] AS weight FROM per
), level AS (
  SELECT max(({SHARE} * total - caps) / (weights - used)) AS level FROM (
    SELECT sum(source_size) OVER ()::DOUBLE AS total, sum(weight) OVER ()::DOUBLE AS weights,
           coalesce(sum(cap) OVER o, 0)::DOUBLE AS caps, coalesce(sum(weight) OVER o, 0)::DOUBLE AS used
    FROM capped WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
), t AS (
  SELECT *, least(cap::DOUBLE, level * weight) AS target FROM capped, level
), won AS (
  SELECT rank, count(*) AS blocks FROM (
    SELECT rank, target / (2 * j + 1) AS quotient FROM t, unnest(range(floor(target / {BLOCK_WORDS})::BIGINT + 20)) u(j)
    ORDER BY quotient DESC, rank LIMIT (SELECT round(sum(target) / {BLOCK_WORDS})::BIGINT FROM t)) GROUP BY rank
), placed AS (
  SELECT s.*, t.rank, source_size, target, coalesce(blocks, 0) AS blocks,
         ('0x' || substr(ord, 1, 8))::BIGINT
           % greatest(1, ceil(source_size / greatest({SHARD_WORDS}, floor({SHARD_ROOTS} * sqrt(source_size)))))::BIGINT AS shard
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN won ON t.rank = won.rank
), shards AS (
  SELECT rank, shard, max(blocks) AS blocks, sum(size)::BIGINT AS shard_size FROM placed GROUP BY ALL
), quotas AS (
  SELECT rank, shard, count(*) AS quota FROM (
    SELECT rank, shard, blocks, row_number() OVER (PARTITION BY rank ORDER BY shard_size / (2 * j + 1) DESC, shard) AS n
    FROM shards, unnest(range({MOST} * shard_size // {BLOCK_WORDS} + 20)) u(j)) WHERE n <= blocks GROUP BY ALL
), taking AS (
  SELECT shards.*, least(coalesce(quota, 0) * {BLOCK_WORDS}, {MOST} * shard_size) AS take
  FROM shards LEFT JOIN quotas USING (rank, shard)
), laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY rank, shard ORDER BY ord, doc_id NULLS FIRST, size, r
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM placed
)
SELECT doc_id, size::BIGINT AS size, source_size, target, shard::INTEGER AS shard,
       (greatest(0, least(size, take - start)) + greatest(0, least(size, take - shard_size - start)))::BIGINT AS taken
FROM laid JOIN taking USING (rank, shard)
"""
