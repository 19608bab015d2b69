import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.operators.lookup import Limits
from clickloom.operators.vocab import (
    Vocabulary,
    cardinality_table,
    encode_lists,
    fit_lists,
    slot_offsets,
    unseen_values,
)

TINY = Limits(column_bytes=100, total_bytes=200, head_entries=2, hot_rows=50)


def brute_codes(values, max_size=None):
    counts = Counter(v for v in values if v is not None)
    ranked = sorted(counts, key=lambda v: (-counts[v], v))
    if max_size:
        ranked = ranked[: max_size - 1]
    return {v: i + 1 for i, v in enumerate(ranked)}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of column a is one value; b has many values, some null."""
    rng = random.Random(5)
    rows = [
        (
            i,
            7 if rng.random() < 0.34 else rng.randrange(40),
            None if rng.random() < 0.1 else rng.randrange(300),
        )
        for i in range(3000)
    ]
    return rows, spark.createDataFrame(rows, "id long, a int, b int")


def test_ties_are_broken_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    got = {r["value"]: r["code"] for r in Vocabulary.fit(df, ["x"]).table.collect()}
    assert got == {"c": 1, "a": 2, "b": 3}


def test_codes_match_brute_force_with_and_without_cut(spark, skewed):
    rows, df = skewed
    for cut in (None, 20):
        vocab = Vocabulary.fit(df, ["a", "b"], cut)
        for i, c in ((1, "a"), (2, "b")):
            want = brute_codes([r[i] for r in rows], cut)
            got = vocab.table.where(F.col("col") == c).collect()
            assert {r["value"]: r["code"] for r in got} == want
            assert vocab.cardinalities()[c] == len(want) + 1


def test_codes_do_not_depend_on_partitioning(spark, skewed):
    _, df = skewed
    first = Vocabulary.fit(df.repartition(1), ["a", "b"]).table
    second = Vocabulary.fit(df.repartition(11), ["a", "b"]).table
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


@pytest.mark.parametrize("limits", [Limits(), TINY])
@pytest.mark.parametrize("key", [None, "id"])
def test_encode_by_broadcast_and_by_shuffle(spark, skewed, limits, key):
    rows, df = skewed
    train = df.where("id < 2000")
    vocab = Vocabulary.fit(train, ["a", "b"])
    # 999 is unseen and fills a third of the rows to be encoded.
    shifted = df.withColumn("a", F.expr("CASE WHEN id % 3 = 0 THEN 999 ELSE a END"))
    codes = {
        i: brute_codes([r[i] for r in rows if r[0] < 2000]) for i in (1, 2)
    }
    got = vocab.encode(shifted, None, key, limits).orderBy("id").collect()
    assert len(got) == len(rows)
    for r, g in zip(rows, got):
        a = 999 if r[0] % 3 == 0 else r[1]
        assert g["a"] == codes[1].get(a, 0) and g["b"] == codes[2].get(r[2], 0)


def test_shuffled_path_is_taken_only_beyond_the_limits(spark, skewed):
    _, df = skewed
    vocab = Vocabulary.fit(df, ["a", "b"])
    assert vocab.side.broadcastable(["a", "b"], Limits()) == ["a", "b"]
    assert vocab.side.broadcastable(["a", "b"], TINY) == []
    plan = vocab.encode(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_mixed_kinds_share_a_vocabulary(spark):
    """They were refused until a value was counted as text and ranked in its column's own order."""
    df = spark.createDataFrame([(10, "a"), (9, "a"), (None, "b")], "x int, y string")
    vocab = Vocabulary.fit(df, ["x", "y"])
    got = {(r["col"], r["value"]): r["code"] for r in vocab.table.collect()}
    assert got == {("x", "9"): 1, ("x", "10"): 2, ("y", "a"): 1, ("y", "b"): 2}
    assert [tuple(r) for r in vocab.encode(df).collect()] == [(2, 1), (1, 1), (0, 2)]
    with pytest.raises(ValueError):
        Vocabulary.fit(df.select(F.array("x").alias("x"), "y"), ["x", "y"])


def test_unseen_values_and_offsets(spark):
    train = spark.createDataFrame([(1, 5), (1, 6), (2, None)], "a int, b int")
    valid = spark.createDataFrame([(3, 5), (3, 9), (None, None)], "a int, b int")
    table = Vocabulary.fit(train, ["a", "b"]).table
    got = {(r["col"], r["value"], r["n"]) for r in unseen_values(valid, table, ["a", "b"]).collect()}
    assert got == {("a", 3, 2), ("b", 9, 1)}
    offsets = slot_offsets(cardinality_table(table), ["a", "b"]).orderBy("slot").collect()
    assert [(r["slot"], r["cardinality"], r["offset"]) for r in offsets] == [(0, 3, 0), (1, 3, 3)]


@pytest.mark.parametrize("limits", [Limits(), TINY])
def test_lists_keep_the_most_frequent_codes(spark, limits):
    rows = [(1, [5, 5, 9, 8]), (2, [9, 5]), (3, []), (4, None), (5, [77, 5])]
    df = spark.createDataFrame(rows, "id long, m array<int>")
    vocab = fit_lists(df.where("id < 5"), "m")  # 5: 3 times, 9: 2 times, 8: once
    got = {r["id"]: r["m"] for r in encode_lists(df, vocab, "m", "id", 2, limits).collect()}
    assert got == {1: [1, 1], 2: [1, 2], 3: [], 4: [], 5: [0, 1]}
