import numpy as np
import pytest
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from clickloom.model import fm_blocks
from clickloom.model.fm import score_fm, sparse_features, train_fm

SCHEMA = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("features", VectorUDT())])


def vectors(n):
    """Records of two slots and two counts, and among them empty, short and dense ones."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        a, b, x = int(rng.integers(0, 5)), int(rng.integers(0, 9)), float(rng.normal())
        vector = Vectors.sparse(16, [a, 5 + b, 14, 15], [1.0, 2.0 * x if i % 2 else 1.0, x, x * x])
        if i % 7 < 3:
            dense = Vectors.dense((rng.normal(size=16) * (rng.random(16) < 0.3)).tolist())
            vector = [dense, Vectors.sparse(16, [a, 5 + b], [1.0, 1.0]), Vectors.sparse(16, [], [])][i % 7]
        rows.append((int(rng.random() < 0.2 + 0.3 * (a == 2)), vector))
    return rows


def same_machine(got, train, factors, step_size, max_iter, seed):
    want = FMClassifier(factorSize=factors, fitLinear=True, stepSize=step_size, maxIter=max_iter, seed=seed).fit(train)
    assert np.allclose(got.factors.toArray(), want.factors.toArray(), atol=1e-9)
    assert np.allclose(got.linear.toArray(), want.linear.toArray(), atol=1e-9)
    assert abs(got.intercept - want.intercept) < 1e-9


@pytest.mark.parametrize("max_iter", [1, 25])
def test_learns_the_machine_of_spark(spark, monkeypatch, max_iter):
    monkeypatch.setattr(fm_blocks, "BLOCK_ROWS", 40)
    monkeypatch.setattr(fm_blocks, "PART_VALUES", 13)
    train = spark.createDataFrame(vectors(400), SCHEMA).repartition(3)
    got = train_fm(train, 3, 0.05, max_iter, 7)
    same_machine(got, train, 3, 0.05, max_iter, 7)
    assert got.getFactorSize() == 3 and got.getMaxIter() == max_iter and got.numFeatures == 16


def test_records_in_stored_form_are_packed_without_a_copy_of_their_vectors(spark):
    """The stored form was refused, so that every training record had to be written out as a vector first.

    Spark's machine fails at a stored 0, which is what a null count becomes; there it is left out.
    """
    rows = [(i % 3, i % 5, float(i % 11) if i % 4 else None, int(i % 6 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b long, x double, label int")
    stored = df.select("label", sparse_features(["a", "b"], ["x"], {"a": 3, "b": 5}).alias("features"))
    got = train_fm(stored, 2, 0.1, 10)
    entries = [(r[3], [(r[0], 1.0), (3 + r[1], 1.0), *([(8, r[2])] if r[2] else [])]) for r in rows]
    train = spark.createDataFrame([(label, Vectors.sparse(9, e)) for label, e in entries], SCHEMA)
    same_machine(got, train, 2, 0.1, 10, 0)
    blocks = fm_blocks.pack(stored.coalesce(1), F.col("label"), F.col("features"))
    assert [(r.size, r.n) for r in blocks.collect()] == [(9, 300)]
    assert score_fm(train, got, ["label"]).count() == 300


def test_the_end_when_the_weights_stand_still(spark):
    train = spark.createDataFrame([(0, Vectors.sparse(2, [], [])), (1, Vectors.sparse(2, [], []))], SCHEMA)
    got = train_fm(train, 2, 0.05, 5)  # no gradient: the second step moves nothing
    same_machine(got, train, 2, 0.05, 5, 0)


@pytest.mark.parametrize(
    "rows",
    [
        [(2, Vectors.dense([1.0]))],
        [(None, Vectors.dense([1.0]))],
        [(1, None)],
        [(1, Vectors.dense([float("nan")]))],
        [(1, Vectors.dense([1.0])), (0, Vectors.dense([1.0, 2.0]))],
        [],
    ],
)
def test_refuses_what_it_cannot_learn_from(spark, rows):
    with pytest.raises(Exception, match="ValueError|one size"):
        train_fm(spark.createDataFrame(rows, SCHEMA), 2)
