"""Factorization machine in the form of Spark ML's, for vocabularies that weights on the driver can hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector, SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickloom.model.fm_blocks import gradient_sums, pack
from clickloom.storage import materialize

FEATURES = "features"


def sparse_features(slots: Sequence[str], dense: Sequence[str], sizes: Mapping[str, int]) -> Column:
    """A record as a sparse vector: `(type, size, indices, values)`, the stored form of an ML vector.

    A slot's code stands at the slot's offset plus the code, with the value 1; `sizes` are the slots'
    cardinalities, in whose order the offsets run. The dense columns follow, a null one as 0. The whole
    record is one expression: no encoder per column, and as many numbers as it has features.
    """
    indices, first = [], 0
    for c in slots:
        indices.append((F.col(c) + first).cast("int"))
        first += sizes[c]
    indices += [F.lit(first + i) for i in range(len(dense))]
    values = [F.lit(1.0)] * len(slots) + [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in dense]
    return F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(first + len(dense)).alias("size"),
        F.array(*indices).alias("indices"), F.array(*values).alias("values"),
    )


def with_vectors(df: DataFrame, features: Column, keep: Sequence[str]) -> DataFrame:
    """`keep` and the ML vector `features`: written in its stored form, read back as what it is."""
    path = materialize(df.select(*keep, features.alias(FEATURES)), "vectors")
    schema = T.StructType([*[path.schema[c] for c in keep], T.StructField(FEATURES, VectorUDT())])
    files = path.inputFiles()
    if not files:
        return df.sparkSession.createDataFrame([], schema)
    return df.sparkSession.read.schema(schema).parquet(files[0].rsplit("/", 1)[0])


def train_fm(
    train: DataFrame, factors: int = 10, step_size: float = 0.05, max_iter: int = 20, seed: int = 0, label: str = "label"
) -> FMClassificationModel:
    """An FM with a linear term over `features` of `train`, an ML vector or its stored form.

    The machine that Spark's `FMClassifier` learns: its first weights, the mean log loss of all records
    at every step, AdamW, its end when the weights stand still. The records are packed in blocks once,
    and each step adds up its gradient block by block.

    All weights are on the driver and are sent to the tasks: about 8 bytes times `factors` + 2 for each
    place of the vector. Beyond its memory, `fm_step` keeps them in a table.
    """
    machine = FMClassifier(
        factorSize=factors, fitLinear=True, stepSize=step_size, maxIter=max_iter, seed=seed, featuresCol=FEATURES, labelCol=label
    )
    blocks = pack(train, F.col(label), F.col(FEATURES))
    records = {r["size"]: r["n"] for r in blocks.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # a row per size
    if len(records) != 1:
        raise ValueError(f"training needs vectors of one size, not {sorted(records)}")
    (size, n), = records.items()
    start = _untrained(train, machine, size)
    weights = np.column_stack([start.factors.toArray(), start.linear.toArray()])
    state = np.append(weights.ravel(), start.intercept)
    step = AdamW(machine.getStepSize(), state.size)
    for i in range(machine.getMaxIter()):
        before, (weights, bias) = state, (state[:-1].reshape(size, factors + 1), state[-1])
        vectors = weights[:, :factors]
        sums, errors = gradient_sums(blocks, np.column_stack([weights, (vectors**2).sum(axis=1)]), float(bias))
        pull = sums[: factors + 1].T
        pull[:, :factors] -= vectors * sums[factors + 1][:, None]
        state = step(state, np.append(pull.ravel(), errors) / n)
        if i and np.linalg.norm(before - state) < machine.getTol() * max(np.linalg.norm(state), 1.0):
            break
    return _fitted(train, machine, state[:-1].reshape(size, factors + 1), float(state[-1]))


class AdamW:
    """Steps of Spark ML's `adamW` solver, without its regularization."""

    def __init__(self, rate: float, size: int):
        self.rate, self.mean, self.square, self.done = rate, np.zeros(size), np.zeros(size), 0

    def __call__(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.done += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient**2
        mean, square = self.mean / (1 - 0.9**self.done), self.square / (1 - 0.999**self.done)
        return weights - self.rate * mean / (np.sqrt(square) + 1e-8)


def _untrained(df: DataFrame, machine: FMClassifier, size: int) -> FMClassificationModel:
    """The weights that Spark's machine begins with: what it returns after no step."""
    row = df.sparkSession.createDataFrame(
        [(0.0, SparseVector(size, [], []))],
        T.StructType([T.StructField(machine.getLabelCol(), T.DoubleType()), T.StructField(FEATURES, VectorUDT())]),
    )
    return machine.copy({machine.maxIter: 0}).fit(row)


def _fitted(df: DataFrame, machine: FMClassifier, weights: np.ndarray, bias: float) -> FMClassificationModel:
    """Spark's model with these weights, a row per place: its factors, then its weight."""
    sc, factors = df.sparkSession.sparkContext, machine.getFactorSize()
    linear = DenseVector(weights[:, factors])
    matrix = DenseMatrix(len(weights), factors, weights[:, :factors].ravel(), isTransposed=True)
    made = sc._jvm.org.apache.spark.ml.classification.FMClassificationModel(
        machine.uid, bias, _py2java(sc, linear), _py2java(sc, matrix)
    )
    return machine._copyValues(FMClassificationModel(made))


def score_fm(df: DataFrame, model: FMClassificationModel, keep: Sequence[str]) -> DataFrame:
    scored = model.transform(df)
    return scored.select(
        *keep,
        vector_to_array("rawPrediction")[1].alias("logit"),
        vector_to_array("probability")[1].alias("score"),
    )
