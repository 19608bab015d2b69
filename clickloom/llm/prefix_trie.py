"""Conversation prefix trie: every distinct beginning of the rebuilt conversations, with its counts.

Turns are ordered by turn number (null first; equal numbers by role, then text); a null role or
text is empty. A conversation c is rebuilt from the first h turns of conversation c - c % `every`,
where h is crc32 of c's digits modulo `deepest` + 1, and its own turns after its first h.

1. Turns are range-partitioned by conversation and turn, so a conversation of very many turns is
   cut into pieces. Each task numbers its turns and keeps running sums of their digests, each
   times a power of a base modulo 2^64 (two of them, 128 bits); at most one conversation a
   boundary is carried on. Such a sum can be moved to another place by one factor, so rebuilding
   a conversation needs no second run over it, and it is a digest of every prefix.
2. Prefixes are counted by digest, with partial counts before the shuffle.
3. Nodes with the same smallest member and the same number of members follow each other without
   a branch. They are one run; what differs inside it follows from running sums of bytes. So only
   runs go on, at most two per distinct conversation, however long it is.
4. Runs are dealt to shards by the prefix at which their subtree first has `BRANCH` members or
   fewer; there is no other edge between shards. In a shard the runs' digests get slots of a
   minimal perfect hash table (verified at each lookup), counts are scattered into flat arrays and
   go up through the parents' slots, deepest first. Runs with more members are at most `TOP`,
   since members summed over runs are at most the turns: they form the last shard, which gets
   one sum per parent from the others.
5. A node's ends are listed in blocks by a range partitioning over node and conversation, so that
   the digest of the list is taken block by block, without the list.

Rows of a null conversation belong to none and are left out. Repeated rows are turns of their own.
A table without conversations gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.slots import settle
from clickloom.storage import materialize

EVERY, DEEPEST = 5, 8
BRANCH = 50_000
TOP = 200_000
SHARD_RUNS = 20_000
BLOCK_IDS = 400
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
WRAP = 1 << 64
TURN = "part int, conv bigint, k bigint, r1 bigint, r2 bigint, t1 bigint, t2 bigint, nb bigint, cum bigint"
ROW = "conv bigint, d bigint, d1 bigint, d2 bigint, p1 bigint, p2 bigint, nb bigint, cum bigint, last boolean"
SETTLED = "conv bigint, n bigint, n_children bigint, n_leaves bigint, below bigint, total bigint, parent bigint, q1 bigint, q2 bigint"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), np.uint64(base))]))[:n]


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of each conversation within a sorted task, with running digests and bytes."""
    last, number, sums, size = None, 0, [0, 0], 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv, nb = _column(batch, "conv"), _column(batch, "nb")
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        length = np.diff(np.concatenate([starts, [n]]))
        carried = conv[0] == last
        if not carried:
            number, sums, size = 0, [0, 0], 0
        inside = np.arange(n) - np.repeat(starts, length)
        first = np.arange(n) < length[0]
        with np.errstate(over="ignore"):
            run, term = [], []
            for i, base in enumerate(BASES):
                power = _powers(base, int(length.max()))[inside]
                power = np.where(first, power * np.uint64(pow(base, number, WRAP)), power)
                t = _column(batch, f"g{i + 1}").view(np.uint64) * power
                total = np.cumsum(t)
                r = total - np.repeat((total - t)[starts], length) + np.where(first, np.uint64(sums[i]), np.uint64(0))
                run.append(r)
                term.append(t)
        bytes_ = np.cumsum(nb)
        cum = bytes_ - np.repeat((bytes_ - nb)[starts], length) + np.where(first, size, 0)
        k = inside + np.where(first, number, 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("conv"), *[pa.array(x.view(np.int64)) for x in (k, *run, *term)], batch.column("nb"), pa.array(cum)],
            ["part", "conv", "k", "r1", "r2", "t1", "t2", "nb", "cum"],
        )
        last, number, size = conv[-1], int(k[-1]) + 1, int(cum[-1])
        sums = [int(r[-1]) for r in run]


def numbered(turns: DataFrame) -> DataFrame:
    """`conv, k, r1, r2, t1, t2, nb, cum` of every turn of `conv, turn, role, text`.

    `k` counts from 0, `r1, r2` are running sums of `t1, t2`, the digests times powers, and `cum` of
    the texts' bytes `nb`.
    """
    sorted_ = turns.repartitionByRange("conv", F.col("turn").asc_nulls_first()).sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_first(), "role", "text"
    )
    local = sorted_.select(
        F.spark_partition_id().alias("part"), "conv", F.xxhash64("role", "text").alias("g1"),
        F.xxhash64(F.lit(1), "text", "role").alias("g2"), F.octet_length("text").cast("long").alias("nb"),
    )
    pieces = materialize(local.mapInArrow(_running, TURN), "trie-turns")
    ends = pieces.groupBy("conv", "part").agg(F.max("k").alias("k"), *[F.max_by(c, "k").alias(c) for c in ("r1", "r2", "cum")])
    cut = ends.join(ends.groupBy("conv").agg(F.count("*").alias("_pieces")).where("_pieces > 1"), "conv")
    carry: dict[tuple[int, int], tuple] = {}
    conv, now = None, (0, 0, 0, 0)
    for piece in cut.orderBy("conv", "part").collect():  # at most two per task: conversations cut by a boundary
        if piece["conv"] != conv:
            conv, now = piece["conv"], (0, 0, 0, 0)
        carry[piece["part"], conv] = now
        moved = [(s + piece[r] * pow(b, now[0], WRAP)) % WRAP for s, r, b in zip(now[1:3], ("r1", "r2"), BASES, strict=True)]
        now = (now[0] + piece["k"] + 1, *moved, now[3] + piece["cum"])

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = {part for part, _ in carry}
        for batch in batches:
            part, conv = _column(batch, "part"), _column(batch, "conv")
            names = ["k", "r1", "r2", "t1", "t2", "nb", "cum"]
            out = {c: _column(batch, c).copy() for c in names}
            for p in np.unique(part):
                for (_, c), (number, s1, s2, size) in ((x, y) for x, y in carry.items() if x[0] == p) if int(p) in parts else ():
                    at = np.flatnonzero((part == p) & (conv == c))
                    with np.errstate(over="ignore"):
                        for i, s in ((0, s1), (1, s2)):
                            power = np.uint64(pow(BASES[i], number, WRAP))
                            for name, add in ((f"r{i + 1}", np.uint64(s)), (f"t{i + 1}", np.uint64(0))):
                                out[name][at] = (out[name][at].view(np.uint64) * power + add).view(np.int64)
                    out["k"][at] += number
                    out["cum"][at] += size
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *[pa.array(out[c]) for c in names]], ["conv", *names])

    return pieces.mapInArrow(carried, TURN.removeprefix("part int, "))


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns after the first h, moved behind the m turns that come from the base."""
    for batch in batches:
        h, m = _column(batch, "h"), _column(batch, "m")
        digest, before = [], []
        with np.errstate(over="ignore"):
            for i, base in enumerate(BASES):
                back = np.array([pow(base, -j, WRAP) for j in range(DEEPEST_SHIFT + 1)], np.uint64)
                factor = back[h - m]  # m is at most h
                of = lambda name: _column(batch, f"{name}{i + 1}").view(np.uint64)  # noqa: B023, E731
                d = of("base") + (of("r") - of("own")) * factor
                digest.append(d)
                before.append(d - of("t") * factor)
        place = _column(batch, "k") + 1 - h + m
        cum = _column(batch, "base_cum") + _column(batch, "cum") - _column(batch, "own_cum")
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(place), *[pa.array(x.view(np.int64)) for x in (*digest, *before)], batch.column("nb"), pa.array(cum),
             pa.array(_column(batch, "k") + 1 == _column(batch, "length"))],
            ["conv", "d", "d1", "d2", "p1", "p2", "nb", "cum", "last"],
        )


DEEPEST_SHIFT = 64  # the largest `deepest` that a caller may ask for


def rebuilt(turns: DataFrame, every: int, deepest: int) -> DataFrame:
    """`conv, d, d1, d2, p1, p2, nb, cum, last`: every prefix of every rebuilt conversation, d = 0 too.

    `d1, d2` are the prefix's digest, `p1, p2` that of the prefix one turn shorter
    (for d = 0, its own).
    """
    now = numbered(turns)
    first = F.struct("k", "r1", "r2", "t1", "t2", "nb", "cum")
    heads = now.groupBy("conv").agg(
        (F.max("k") + 1).alias("length"),
        F.array_sort(F.collect_list(F.when(F.col("k") < deepest, first))).alias("heads"),  # at most `deepest`
    )
    heads = materialize(heads, "trie-heads")
    h = (F.crc32(F.col("conv").cast("string")) % (deepest + 1)).cast("int")
    bases = heads.select(F.col("conv").alias("base"), F.col("heads").alias("base_heads"))
    convs = heads.select("*", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base")).join(bases, "base", "left")
    convs = convs.withColumn("base_heads", F.coalesce("base_heads", F.slice("heads", 1, 0))).withColumn(
        "m", F.least("h", F.size("base_heads"))
    )
    convs = materialize(convs.withColumn("own", F.least(F.col("h"), F.size("heads"))), "trie-conversations")

    def at(array: str, place: str, field: str) -> Column:
        return F.when(F.col(place) > 0, F.element_at(array, F.col(place))[field]).otherwise(F.lit(0).cast("long"))

    total = F.col("m") + F.greatest(F.col("length") - F.col("h"), F.lit(0))
    empty = F.lit(0).cast("long")
    roots = convs.select(
        "conv", empty.alias("d"), empty.alias("d1"), empty.alias("d2"), empty.alias("p1"), empty.alias("p2"), empty.alias("nb"), empty.alias("cum"), (total == 0).alias("last"),
    )
    given = convs.where("m > 0").select("conv", total.alias("total"), F.explode(F.slice("base_heads", F.lit(1), F.col("m"))).alias("x"), "base_heads")
    shorter = lambda r: F.when(F.col("x.k") == 0, empty).otherwise(F.element_at("base_heads", F.greatest(F.col("x.k"), F.lit(1)).cast("int"))[r])
    given = given.select(
        "conv", (F.col("x.k") + 1).alias("d"), "x.r1", "x.r2", shorter("r1").alias("p1"), shorter("r2").alias("p2"), "x.nb", "x.cum",
        (F.col("x.k") + 1 == F.col("total")).alias("last"),
    ).toDF(*roots.columns)
    marks = convs.where("length > h").select(
        "conv", "h", "m", "length", *[at("heads", "own", f"r{i}").alias(f"own{i}") for i in (1, 2)], at("heads", "own", "cum").alias("own_cum"),
        *[at("base_heads", "m", f"r{i}").alias(f"base{i}") for i in (1, 2)], at("base_heads", "m", "cum").alias("base_cum"),
    )
    own = now.join(marks, "conv").where("k >= h").mapInArrow(_moved, ROW)
    return roots.unionByName(given).unionByName(own)


def _settle(group: pd.DataFrame) -> pd.DataFrame:
    depth = group["top"].to_numpy()
    root = depth == 0
    own = (group["b1"].to_numpy(np.int64), group["b2"].to_numpy(np.int64))
    above = (group["p1"].to_numpy(np.int64), group["p2"].to_numpy(np.int64))
    n = group["n"].to_numpy(np.int64)
    amount = (n - 1) * group["bytes"].to_numpy(np.int64)
    done = settle(
        own, above, depth, group["children"].to_numpy(np.int64), group["leaves"].to_numpy(np.int64),
        amount, group["below"].to_numpy(np.int64),
    )
    conv, parent = group["conv"].to_numpy(np.int64), done["parent"]
    inside = parent >= 0
    outside = lambda x: pd.array(x, "Int64")
    out = pd.DataFrame({
        "conv": conv, "n": n, "n_children": done["children"], "n_leaves": done["leaves"], "below": done["below"],
        "total": done["below"] + amount, "parent": outside(conv[parent]), "q1": outside(above[0]), "q2": outside(above[1]),
    })
    out.loc[~inside, "parent"] = pd.NA
    out.loc[inside | root, ["q1", "q2"]] = pd.NA
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring ends of one node as comma-joined blocks."""
    for batch in batches:
        if not batch.num_rows:
            continue
        d1, d2, d, conv = (_column(batch, c) for c in ("d1", "d2", "d", "conv"))
        new = np.concatenate([[True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]) | (d[1:] != d[:-1])])
        at = np.flatnonzero(new)
        cuts = [np.arange(a, b, BLOCK_IDS) for a, b in zip(at, [*at[1:], len(d)], strict=True)]
        starts = np.concatenate(cuts)
        text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(starts, [*starts[1:], len(d)], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(d1[starts]), pa.array(d2[starts]), pa.array(d[starts]), pa.array(conv[starts]), pa.array(text)], ["d1", "d2", "d", "conv", "ids"]
        )


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's blocks, which follow each other; only a hash state is held."""
    node, state = None, None
    for batch in batches:
        out = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "d", "ids")), strict=True):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if node:
                out.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
        yield _digest_batch(out)
    if node:
        yield _digest_batch([(*node, state.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    d1, d2, d, sha = zip(*rows, strict=True) if rows else ([],) * 4
    arrays = [pa.array(x, pa.int64()) for x in (d1, d2, d)] + [pa.array(sha, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["d1", "d2", "d", "sha"])


def ends_digests(rows: DataFrame) -> DataFrame:
    """`d1, d2, d, sha` of the nodes where conversations end."""
    node = ["d1", "d2", "d"]
    ordered = rows.where("last").select(*node, "conv").repartitionByRange(*node, "conv").sortWithinPartitions(*node, "conv")
    blocks = ordered.mapInArrow(_blocks, "d1 bigint, d2 bigint, d bigint, conv bigint, ids string")
    together = blocks.repartition(*node).sortWithinPartitions(*node, "conv")
    return together.mapInArrow(_list_digests, "d1 bigint, d2 bigint, d bigint, sha string")


def settled_runs(rows: DataFrame, runs: DataFrame, n_rows: int) -> DataFrame:
    """`conv, n, n_children, n_leaves, below, parent` of every run: shards first, then the top."""
    branch = max(BRANCH, -(-n_rows // TOP))
    is_top = (F.col("n") > branch) | (F.col("top") == 0)
    top = materialize(runs.where(is_top), "trie-top")  # at most n_rows / branch + 1 rows
    edge = F.broadcast(top.select(F.col("b1").alias("p1"), F.col("b2").alias("p2")))
    cuts = rows.where("d > 0").join(edge, ["p1", "p2"]).groupBy("conv").agg(F.max_by(F.struct("d1", "d2"), "d").alias("cut"))
    light = runs.where(~is_top)
    shards = max(1, -(-light.count() // SHARD_RUNS))
    zero = F.lit(0).cast("long")
    alone = {"children": zero, "leaves": zero, "below": zero}
    dealt = light.join(cuts, "conv").withColumn("shard", F.pmod(F.xxhash64("cut.d1", "cut.d2"), F.lit(shards))).withColumns(alone)
    done = materialize(dealt.drop("cut").groupBy("shard").applyInPandas(_settle, SETTLED), "trie-shards")
    # What a shard's roots add to their parents: one row per parent and task before the shuffle.
    sums = done.where("q1 IS NOT NULL").groupBy("q1", "q2").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("total").alias("below")
    )
    whole = top.join(sums, (F.col("b1") == F.col("q1")) & (F.col("b2") == F.col("q2")), "left").drop("q1", "q2")
    whole = whole.fillna(0, ["children", "leaves", "below"]).withColumn("shard", zero)
    crown = whole.groupBy("shard").applyInPandas(_settle, SETTLED)  # at most TOP + 1 rows
    names = top.select(F.col("b1").alias("q1"), F.col("b2").alias("q2"), F.col("conv").alias("above"))
    low = done.join(F.broadcast(names), ["q1", "q2"], "left").withColumn("parent", F.coalesce("parent", "above")).drop("above")
    return low.unionByName(crown).drop("q1", "q2", "total")


def trie(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", every: int = EVERY, deepest: int = DEEPEST
) -> DataFrame:
    """One row per node: `key, depth, parent_<key>, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`."""
    if not 0 <= deepest <= DEEPEST_SHIFT:
        raise ValueError(f"at most {DEEPEST_SHIFT} turns can come from another conversation")
    turns = df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = materialize(rebuilt(turns, every, deepest), "trie-rows")
    nodes = rows.groupBy("d", "d1", "d2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n"), *[F.max(c).alias(c) for c in ("p1", "p2", "nb", "cum")]
    )
    nodes = materialize(nodes, "trie-nodes")
    runs = nodes.groupBy("conv", "n").agg(
        F.min("d").alias("top"), F.max("d").alias("bottom"), F.max_by("d1", "d").alias("b1"), F.max_by("d2", "d").alias("b2"),
        F.min_by("p1", "d").alias("p1"), F.min_by("p2", "d").alias("p2"),
        (F.max("cum") - F.min(F.col("cum") - F.col("nb"))).alias("bytes"), F.max("cum").alias("end"),
    )
    runs = materialize(runs, "trie-runs")
    done = settled_runs(rows, runs, rows.count()).join(runs.select("conv", "n", "top", "bottom", "end"), ["conv", "n"])
    each = nodes.join(materialize(done, "trie-settled"), ["conv", "n"]).join(ends_digests(rows), ["d1", "d2", "d"], "left")
    here = F.col("d") == F.col("bottom")
    return each.select(
        F.col("conv").alias(key), F.col("d").alias("depth"),
        F.when(F.col("d") == 0, None).when(F.col("d") == F.col("top"), F.col("parent")).otherwise(F.col("conv")).alias(f"parent_{key}"),
        F.col("n").alias("n_convs"), F.when(here, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("below") + (F.col("n") - 1) * (F.col("end") - F.col("cum") + F.col("nb"))).alias("saved_tokens"),
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )


def trie_query(df: DataFrame) -> DataFrame:
    return trie(df)


TRIE_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), k AS (  -- crc32 bit by bit: -1 stands for a shift
  SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(c::VARCHAR, ''), lambda s: list_concat([ascii(s)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
    lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)
), b AS (
  SELECT k.c, t.p AS p, r, x FROM k JOIN t ON t.c = k.c - k.c % 5 AND t.p <= k.h
  UNION ALL SELECT k.c, t.p + 1000000000, r, x FROM k JOIN t ON t.c = k.c WHERE t.p > k.h
), s AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS d, md5(md5(r) || md5(x)) AS g, strlen(x) AS nb FROM b
), f AS (
  SELECT c, d, md5(string_agg(g, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS node, nb FROM s
  UNION ALL SELECT c, 0, '', 0 FROM k
), g AS (
  SELECT c, d, node, nb, lag(node) OVER (PARTITION BY c ORDER BY d) AS up, lead(node) OVER (PARTITION BY c ORDER BY d) IS NULL AS last FROM f
), n AS (
  SELECT d, node, any_value(up) AS up, min(c) AS c, count(*) AS n, any_value(nb) AS nb,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends FROM g GROUP BY d, node
), q AS (
  SELECT node, n.*, (SELECT count(*) FROM n AS o WHERE o.up = n.node) AS children FROM n
), a AS (
  SELECT g.node, sum((q.n - 1) * q.nb)::BIGINT AS saved, count(*) FILTER (q.children = 0) AS leaves
  FROM q JOIN g ON g.c = q.c AND g.d <= q.d GROUP BY g.node
)
SELECT q.c AS conv_id, q.d AS depth, o.c AS parent_conv_id, q.n AS n_convs, q.children AS n_children, a.leaves AS n_leaves,
       a.saved AS saved_tokens, q.ends AS ends_sha256
FROM q JOIN a ON a.node = q.node LEFT JOIN n AS o ON o.node = q.up
"""
