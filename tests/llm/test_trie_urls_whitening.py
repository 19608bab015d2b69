"""Prefix trie, URL filter and whitening against plain definitions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from clickloom.llm import cascade, prefix_trie, slots, url_filter, whitening
from pyspark.sql import functions as F

TURN = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    whole, nodes = {}, {}
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(whole[c]) + 1):
            nodes.setdefault(whole[c][:d], []).append(c)
    out = []
    for node, members in nodes.items():
        below = [x for x in nodes if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        ends = ",".join(str(c) for c in sorted(members) if whole[c] == node)
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(children),
            sum(not any(y[:-1] == x for y in nodes if y) for x in below),
            sum((len(nodes[x]) - 1) * len(x[-1][1].encode()) for x in below if x), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out)


def talks(seed, convs, depth=9):
    random.seed(seed)
    said = ["a", "bé", "", None, "a longer text"]
    rows = []
    for c in random.sample(range(-20, 3 * convs), convs):
        start = random.choice([["a", "a"], ["a", "bé"], []])
        for i, text in enumerate(start + random.choices(said, k=random.randrange(depth))):
            rows.append((c, i if random.random() < 0.95 else None, random.choice(["user", "user", None]), text))
    return rows


@pytest.mark.parametrize("branch", [3, 50_000])
def test_trie(spark, monkeypatch, branch):
    monkeypatch.setattr(prefix_trie, "BRANCH", branch)
    monkeypatch.setattr(prefix_trie, "TOP", 1_000_000)
    monkeypatch.setattr(prefix_trie, "SHARD_RUNS", 7 if branch == 3 else 20_000)
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 3)
    rows = talks(1, 60) + talks(2, 40)[:50] + [(None, 1, "user", "lost"), (500, None, None, None), (500, None, None, None)]
    rows += [(c, i, "user", f"same {i}") for c in range(600, 680) for i in range(12)]  # copies
    got = prefix_trie.trie_query(spark.createDataFrame(rows, TURN).repartition(5)).collect()
    assert sorted(map(tuple, got), key=lambda x: x[:2]) == plain_trie(rows)


def test_trie_of_one_conversation_over_many_tasks(spark):
    rows = [(10, i, "user", f"t{i}") for i in range(3000)] + [(11, i, "user", f"t{i}") for i in range(20)] + [(12, 0, "user", "x")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that small data are cut
    try:
        pieces = prefix_trie.numbered(spark.createDataFrame(rows, TURN).withColumnRenamed("conv_id", "conv").repartition(4))
        assert [r.k for r in pieces.where("conv = 10").orderBy("k").collect()] == list(range(3000))
        assert spark.read.parquet(pieces.inputFiles()[0].rsplit("/", 1)[0]).where("conv = 10").select("part").distinct().count() > 2
        got = {(r.conv_id, r.depth): r for r in prefix_trie.trie_query(spark.createDataFrame(rows, TURN)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    h = zlib.crc32(b"11") % 9  # from conversation 10, then its own: the same first 20 turns
    assert got[10, 20].n_convs == 2 and got[10, 21].n_convs == 1 and (11, 20) not in got and 0 <= h <= 8
    assert got[10, 20].n_children == 1 and got[10, 0].n_leaves == len({r.conv_id for r in got.values() if r.n_children == 0})
    assert got[10, 1].saved_tokens >= sum(len(f"t{i}") for i in range(20)) and got[10, 3000].n_children == 0


def test_trie_of_nothing(spark):
    assert prefix_trie.trie_query(spark.createDataFrame([], TURN)).count() == 0
    assert prefix_trie.trie_query(spark.createDataFrame([(None, 1, "a", "b")], TURN)).count() == 0


def test_slots_are_minimal_and_verified():
    draw = np.random.default_rng(3)
    one, two = draw.integers(-(2**62), 2**62, (2, 5000))
    table = slots.SlotTable(one, two)
    assert sorted(table.find(one, two)) == list(range(5000))
    assert (table.find(one, two + 1) == -1).all() and len(slots.SlotTable(one[:0], two[:0]).find(one[:3], two[:3])) == 3
    with pytest.raises(ValueError):
        slots.SlotTable(np.array([1, 1]), np.array([2, 2]))


@pytest.mark.parametrize("part_bits", [1 << 27, 4000])
def test_cascade_is_exact_for_its_universe(spark, monkeypatch, part_bits):
    monkeypatch.setattr(cascade, "PART_BITS", part_bits)
    keys = spark.range(20_000).select(F.xxhash64("id").alias("k1"), F.xxhash64(F.lit(1), "id").alias("k2"), "id")
    listed = keys.where("id % 17 = 3").unionByName(spark.range(50_000, 90_000).select(F.xxhash64("id").alias("k1"), F.xxhash64(F.lit(1), "id").alias("k2"), "id"))
    built = cascade.build(keys.unionByName(keys), listed.unionByName(listed))
    assert (len(built) > 1) == (part_bits < 1 << 20)
    bits = sum(level.bits for levels in built for level in levels)
    assert bits < 12 * 20_000 / 17  # nothing is spent on listed keys that nobody asks for
    arrays = keys.select("id", F.array("k1", F.lit(None)).alias("a"), F.array("k2", F.lit(None)).alias("b"))
    found = cascade.member(arrays, "a", "b", {"hit": built}).collect()
    assert all(r.hit == [r.id % 17 == 3, False] for r in found) and len(found) == 20_000
    assert cascade.build(keys, listed.limit(0)) == [[]]


URLS = [
    "http://a.Example.ORG/es/1?x=/en/1", "http://example.org/en/12#t", "http://example.org/en/2", "http://badexample.org/es/1", "http://x.com/fr/",
    "http://x.com/FR/", "http://com/de/1", "http://www.cheap-pills.net/a", "https://spam-farm.example.org/de/", "http://spam-farm.example.net?q=/", "no host",
    "://", "", None, "http:///org/", "http://org", "http://org?/", "http://é.org/", "http://pills.a.spam.b.dev/x", "x://y://z.com/fr/", "http://spammy.dev/",
]


def plain_verdict(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    bad = any(w in url_filter.BAD_WORDS for label in host.split(".") for w in label.split("-"))
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "block" if bad else "allow"))
    return host, path, rule, verdict


def test_urls(spark):
    rows = [(i % 18, url, "h", "x", "y") for i, url in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, _asked string")
    got = url_filter.urls_query(pages).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted([(r[0], *plain_verdict(r[1])) for r in rows], key=key)
    rules = spark.createDataFrame([("a.b", "", "allow"), ("b", "/xy", "block"), ("a.b", "", "block")], "host string, path string, verdict string")
    hosts = spark.createDataFrame([("q.r",)], "host string")
    said = lambda url: url_filter.judge(spark.createDataFrame([(url,)], "url string"), rules, hosts).first()
    assert (said("h://a.b/xy").rule, said("h://a.b/xy").verdict) == ("b/xy", "block")
    assert (said("h://a.b/x").rule, said("h://a.b/x").verdict) == ("a.b", "block")
    assert (said("h://z.q.r").listed, said("h://z.q.r").verdict, said("h://q").verdict) == ("q.r", "block", "allow")
    assert url_filter.urls_query(pages.limit(0)).count() == 0


def vectors(seed=5, n=300, d=6):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(n, d)) @ draw.normal(size=(d, d))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    return rows + [(i, v) for i, v in rows[:40]] + [(1000 + i, rows[7][1]) for i in range(200)] + [(None, rows[3][1])]


@pytest.mark.parametrize("by_count", [False, True])
def test_whitening(spark, by_count):
    rows = vectors()
    bad = [(1, None), (2, [0.0] * 5 + [None]), (3, [0.0] * 5 + [float("nan")]), (4, [float("inf")] * 6), (5, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("h1", F.lit("y"))
    got = whitening.whiten(df, components=4, by_count=by_count).toPandas()
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    distinct, inverse, counts = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    weights = counts if by_count else np.ones(len(distinct), np.int64)
    n, total = int(weights.sum()), (distinct * weights[:, None]).sum(axis=0)
    centred = distinct - total / n
    values, axes = np.linalg.eigh((centred * weights[:, None]).T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = ((distinct - total / n) @ axes / np.sqrt(values))[:, :4]
    assert len(got) == 4 * len(rows) and set(got.n) == {n} and got.identity_error.max() < 1e-9
    deviation = ((n * distinct - total) ** 2).sum(axis=1)
    assert sorted(got[got.component == 1].deviation) == sorted(deviation[inverse.reshape(-1)])
    for c in range(4):
        own = got[got.component == c + 1]
        assert np.allclose(own.explained, values[c] / values.sum())
        assert np.allclose(np.sort(np.abs(own.whitened)), np.sort(np.abs(white[inverse.reshape(-1), c])), atol=1e-8)


def test_whitening_without_variance_and_of_several_lengths(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0]), (4, [3.0]), (5, [1e30])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got[1, 1].n == 1 and got[1, 1].whitened is None and got[1, 1].explained == 0 and got[2, 2].deviation == 0
    assert got[1, 1].identity_error is None and got[3, 1].n == 3 and got[5, 1].deviation is None and len(got) == 7
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty).count() == 0 and len(whitening.whiten(empty).columns) == 7
