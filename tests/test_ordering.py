import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators.metrics import auc, log_loss
from clickloom.operators.moments import moments, quantiles
from clickloom.operators.ordering import first_rows, running_total
from clickloom.operators.profile import describe, label_percent, preview_transposed
from clickloom.operators.shuffle import assign_batches, shuffle_rows


def test_running_total_per_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), i, rng.randrange(10)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k long, n long").repartition(5)
    out = running_total(df, "g", [F.col("k").asc()], F.col("n"), "before", "t").collect()
    want, sums = {}, {"a": 0, "b": 0}
    for g, k, n in sorted(rows, key=lambda r: r[1]):
        want[k] = sums[g]
        sums[g] += n
    assert {r["k"]: r["before"] for r in out} == want


@pytest.mark.parametrize("limit", [1, 37, 400, 1000])
def test_first_rows(spark, limit):
    df = spark.range(400).withColumn("v", F.rand(3)).repartition(6)
    got = sorted(r["id"] for r in first_rows(df, "id", limit).collect())
    assert got == list(range(min(limit, 400)))


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    values = np.where(rng.random(999) < 0.33, 4.0, np.round(rng.normal(0, 10, 999), 2))
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = {r["share"]: r["value"] for r in quantiles(df, ["x"], [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    for share, value in got.items():
        assert value == pytest.approx(np.quantile(values, share), abs=1e-9)


def test_moments_and_describe(spark):
    df = spark.createDataFrame([(1, None), (2, 4.0), (4, 6.0)], "x int, y double")
    got = {r["col"]: (r["mean"], r["std"]) for r in moments(df, ["x", "y"]).collect()}
    assert got["x"] == pytest.approx((7 / 3, np.std([1, 2, 4], ddof=1)))
    row = {r["col"]: r for r in describe(df, ["x", "y"]).collect()}["y"]
    assert (row["n"], row["min"], row["q50"], row["max"]) == (2, 4.0, 5.0, 6.0)


def brute_auc(scores, labels):
    pairs = [
        1.0 if p > n else 0.5 if p == n else 0.0
        for p, a in zip(scores, labels)
        if a
        for n, b in zip(scores, labels)
        if not b
    ]
    return sum(pairs) / len(pairs)


def test_auc_with_ties_and_reversed(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(12) / 4, int(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, label int").repartition(4)
    got = auc(df, "s", "label").collect()[0]["auc"]
    assert got == pytest.approx(brute_auc(*zip(*rows)), abs=1e-12)
    reverse = auc(df.withColumn("s", -F.col("s")), "s", "label").collect()[0]["auc"]
    assert got + reverse == pytest.approx(1.0)
    one_class = auc(df.where("label = 1"), "s", "label").collect()[0]
    assert one_class["auc"] is None


def test_log_loss_of_extreme_logits(spark):
    df = spark.createDataFrame([(800.0, 1), (-800.0, 0), (0.0, 1)], "z double, label int")
    assert log_loss(df, "z", "label").collect()[0][0] == pytest.approx(np.log(2) / 3)


@pytest.mark.parametrize("mode", [None, "PER_PARTITION", "PER_WORKER", "FULL"])
@pytest.mark.parametrize("key", [None, "id"])
def test_shuffles_keep_the_bag(spark, mode, key):
    df = spark.range(300).withColumn("v", F.col("id") % 7)
    out = shuffle_rows(df, mode, seed=3, files=4, workers=2, key=key)
    assert sorted(r["id"] for r in out.collect()) == list(range(300))


def test_full_shuffle_is_repeatable_and_moves_rows(spark):
    df = spark.range(300)
    first = [r[0] for r in shuffle_rows(df, "FULL", 3, 4, key="id").collect()]
    again = [r[0] for r in shuffle_rows(df.repartition(9), "FULL", 3, 4, key="id").collect()]
    assert first == again and first != sorted(first)
    with pytest.raises(ValueError):
        shuffle_rows(df, "SOME")


def test_batches_cover_all_rows_and_change_with_the_epoch(spark):
    df = spark.range(1000)
    first = assign_batches(df, "id", 8)
    assert first.groupBy("batch").count().count() == 8
    second = assign_batches(df, "id", 8, epoch=1)
    moved = first.join(second.withColumnRenamed("batch", "b2"), "id").where("batch <> b2").count()
    assert moved > 500


def test_label_percent_and_transposed_preview(spark):
    df = spark.createDataFrame([(3, 1, "x"), (1, 0, "y"), (2, 0, None)], "k int, label int, t string")
    assert {r[0]: r[1] for r in label_percent(df).collect()} == {1: 33.33, 0: 66.67}
    got = {r["col"]: r for r in preview_transposed(df, "k", ["label", "t"], 2).collect()}
    assert (got["label"]["row_0"], got["t"]["row_0"], got["t"]["row_1"]) == ("0", "y", None)


def test_auc_leaves_out_what_has_no_label_or_score(spark):
    from clickloom.operators.metrics import auc

    rows = [(0.1, 0), (0.4, 1), (0.3, 0), (0.9, 1), (0.2, None), (None, 1), (float("nan"), 0)]
    got = auc(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    assert (got.auc, got.n_pos, got.n_neg) == (1.0, 2, 2)


def test_workers_are_dealt_ordered_parts_and_sort_nothing_themselves(spark):
    df = spark.range(4000).withColumnRenamed("id", "k")
    moved = shuffle_rows(df, "PER_WORKER", seed=3, workers=2, key="k")
    last = moved._jdf.queryExecution().sparkPlan().toString().splitlines()[0]
    assert last.startswith("Exchange"), last  # the share of a worker is not sorted in its one task
    shares = moved.rdd.glom().map(lambda rows: [r["k"] for r in rows]).collect()
    assert len(shares) == 2 and sorted(sum(shares, [])) == list(range(4000))
    assert all(share != sorted(share) for share in shares)
