"""The model artefact and scoring of whole tables with it."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from clickloom.model import network
from clickloom.operators.embedding import VECTOR, Embeddings, ValueVectors
from clickloom.operators.lookup import Limits, SideTable, lookup
from clickloom.plans.workflow import FittedWorkflow
from clickloom.storage import materialize, read_text, write_text


@dataclass(frozen=True)
class DeepFM:
    """Embeddings as a table; dense weights (under a million numbers) as arrays."""

    embeddings: Embeddings
    params: dict[str, np.ndarray]
    dense: Sequence[str]

    @property
    def slots(self) -> list[str]:
        return list(self.embeddings.columns)

    def save(self, directory: str) -> None:
        spark = self.embeddings.table.sparkSession
        self.embeddings.table.write.mode("overwrite").partitionBy("slot").parquet(f"{directory}/embeddings")
        weights_table(spark, self.params).coalesce(1).write.mode("overwrite").parquet(
            f"{directory}/dense"
        )
        spec = {"slots": self.slots, "dense": list(self.dense), "order": list(self.params)}
        write_text(spark, f"{directory}/spec.json", json.dumps(spec))

    @staticmethod
    def load(spark: SparkSession, directory: str) -> "DeepFM":
        spec = json.loads(read_text(spark, f"{directory}/spec.json"))
        rows = {r["layer"]: r for r in spark.read.parquet(f"{directory}/dense").collect()}
        params = {
            name: np.array(rows[name]["weights"]).reshape(rows[name]["shape"])
            for name in spec["order"]
        }
        table = spark.read.parquet(f"{directory}/embeddings")
        return DeepFM(Embeddings.of(table, spec["slots"]), params, spec["dense"])


def weights_table(spark: SparkSession, params: dict[str, np.ndarray]) -> DataFrame:
    """`(layer, shape, weights)`, one row per dense parameter."""
    return spark.createDataFrame(
        [(n, list(p.shape), p.ravel().tolist()) for n, p in params.items()],
        "layer string, shape array<int>, weights array<double>",
    )


def model_input(
    df: DataFrame,
    embeddings: Embeddings,
    dense: Sequence[str],
    carry: Sequence[str],
    key: str | None,
    limits: Limits,
) -> DataFrame:
    """Look up all slots and lay each row out as two vectors, `_emb` and `_dense`.

    Scalar slots go through one lookup; an array slot sums the vectors of its keys.
    """
    kinds = df.schema
    lists = [c for c in embeddings.columns if isinstance(kinds[c].dataType, T.ArrayType)]
    scalars = {c: c for c in embeddings.columns if c not in lists}
    out = embeddings.lookup(df, scalars, key, limits) if scalars else df
    for c in lists:
        if key is None:
            raise ValueError("array slots need a row key")
        out = embeddings.lookup_sum(out, c, c, key, limits)
    return _laid_out(out, embeddings.columns, dense, carry)


def _laid_out(df: DataFrame, slots: Sequence[str], dense: Sequence[str], carry: Sequence[str]) -> DataFrame:
    vectors = [F.col(f"{c}__vec") for c in slots]
    return df.select(
        *carry,
        F.concat(*vectors).alias("_emb"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in dense]).alias("_dense"),
    )


def score(
    df: DataFrame,
    model: DeepFM,
    keep: Sequence[str],
    key: str | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """`keep` columns with `logit` and `score` of every row of a transformed frame."""
    return _forward(model_input(df, model.embeddings, model.dense, keep, key, limits), model, keep)


def _forward(rows: DataFrame, model: DeepFM, keep: Sequence[str]) -> DataFrame:
    many = _forward_all(rows, {"": model}, {"": "_emb"}, keep)
    return many.select(*keep, "logit", "score")


def _forward_all(rows: DataFrame, models: dict[str, DeepFM], emb: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per record and model: `keep`, `model`, `logit`, `score`; `emb` names the models' vectors."""
    weights = rows.sparkSession.sparkContext.broadcast({name: model.params for name, model in models.items()})
    shapes = {name: (len(model.slots), len(model.dense)) for name, model in models.items()}
    kept = list(keep)

    def run(batches):
        for batch in batches:
            for name, (slots, dense) in shapes.items():
                vectors = network.matrix(batch.column(emb[name]), slots * VECTOR).reshape(-1, slots, VECTOR)
                logit, _ = network.forward(weights.value[name], vectors, network.matrix(batch.column("_dense"), dense))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in kept]
                    + [pa.array([name] * batch.num_rows, pa.string()), pa.array(logit), pa.array(network.sigmoid(logit))],
                    names=kept + ["model", "logit", "score"],
                )

    schema = T.StructType(
        [rows.schema[c] for c in kept]
        + [T.StructField("model", T.StringType()), T.StructField("logit", T.DoubleType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(run, schema)


def score_models(
    df: DataFrame, models: dict[str, DeepFM], keep: Sequence[str], key: str | None = None, limits: Limits = Limits()
) -> DataFrame:
    """`keep`, `model`, `logit`, `score`: a row per record and model, in one scan of the frame.

    The models are snapshots of one: they have the same slots, scalar, and the same dense columns. Their
    vectors are laid side by side, one entry per key, so that a slot is looked up once for all of them.
    """
    first = next(iter(models.values()))
    if any((m.slots, list(m.dense)) != (first.slots, list(first.dense)) for m in models.values()):
        raise ValueError("models of one scan have the same slots and dense columns")
    table = None
    for i, model in enumerate(models.values()):
        own = model.embeddings.table.select("slot", "code", F.col("vec").cast("array<double>").alias(f"_v{i}"))
        table = own if table is None else table.join(own, ["slot", "code"], "full")
    zero = F.array(*[F.lit(0.0)] * VECTOR)
    wide = table.select("slot", "code", F.concat(*[F.coalesce(f"_v{i}", zero) for i in range(len(models))]).alias("vec"))
    wide = materialize(wide, "snapshots", partition_by="slot")
    entries = wide.select(F.col("slot").alias("name"), F.col("code").alias("value"), F.col("code").alias("rank"), F.col("vec").alias("payload"))
    side = SideTable.measure(entries, 8 * VECTOR * len(models))
    found = lookup(df, side, {c: s for s, c in enumerate(first.slots)}, "{}__all", key, limits)
    none = F.array(*[F.lit(0.0)] * (VECTOR * len(models)))
    vectors = [F.coalesce(f"{c}__all", none) for c in first.slots]
    laid = found.select(
        *keep,
        *[F.concat(*[F.slice(v, VECTOR * i + 1, VECTOR) for v in vectors]).alias(f"_emb{i}") for i in range(len(models))],
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in first.dense]).alias("_dense"),
    )
    return _forward_all(laid, models, {name: f"_emb{i}" for i, name in enumerate(models)}, keep)


def score_raw(
    df: DataFrame, fitted: FittedWorkflow, model: DeepFM, keep: Sequence[str], key: str | None = None
) -> DataFrame:
    """Raw records to scores: the fitted feature workflow, then the model."""
    return RawScorer.of(fitted, model).score(df, keep, key)


@dataclass(frozen=True)
class RawScorer:
    """A workflow and a model made ready for raw records; make it once for many inputs.

    Where the workflow does nothing to the slots but code them, values are looked up straight
    to their vectors. In any other case they are coded first, and codes are looked up.
    """

    fitted: FittedWorkflow
    model: DeepFM
    vectors: ValueVectors | None

    @staticmethod
    def of(fitted: FittedWorkflow, model: DeepFM) -> "RawScorer":
        direct = set(model.slots) <= fitted.only_coded()
        return RawScorer(fitted, model, ValueVectors.of(fitted.vocabulary(), model.embeddings) if direct else None)

    def score(self, df: DataFrame, keep: Sequence[str], key: str | None = None) -> DataFrame:
        fitted, model = self.fitted, self.model
        if self.vectors is None or set(keep) & fitted.only_coded():
            return score(fitted.transform(df, key, keep), model, keep, key, fitted.limits)
        rows = fitted.transform(df, key, keep, coded=False)
        rows = self.vectors.lookup(rows, key, fitted.limits)
        return _forward(_laid_out(rows, model.slots, model.dense, keep), model, keep)
