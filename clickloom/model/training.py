"""Synchronous data-parallel training: one pass of Spark work per mini-batch.

Tasks compute gradients of their share of the batch. Each task adds up its own rows per
key before anything is shuffled, so a key that fills a third of the batch costs one row
per task. Dense weights are averaged on the driver (their number does not depend on the
data); embeddings stay a table and are updated by a join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.model import network
from clickloom.model.deepfm import DeepFM, model_input, score
from clickloom.operators.embedding import VECTOR, Embeddings, random_vectors, slot_keys
from clickloom.operators.lookup import Limits
from clickloom.operators.metrics import auc
from clickloom.operators.ordering import first_rows
from clickloom.operators.shuffle import assign_batches
from clickloom.storage import delete, scratch_path

# Rows of the gradient table that are not embedding keys.
DENSE_SLOT = -1
LOSS_SLOT = -2


@dataclass(frozen=True)
class Settings:
    """Training parameters. With epochs > 0 the iteration limit is ignored."""

    batch_rows: int = 2048
    lr: float = 0.001
    dropout: float = 0.5
    hidden: tuple[int, ...] = (400, 400, 400)
    optimizer: str = "sgd"
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = 1e-7
    epochs: int = 0
    max_iter: int = 0
    eval_interval: int = 0
    eval_batches: int = 0
    snapshot_interval: int = 0
    snapshot_dir: str | None = None
    seed: int = 0
    vector_scale: float = 0.05
    limits: Limits = field(default=Limits())

    def iterations(self, batches: int) -> int:
        return self.epochs * batches if self.epochs > 0 else self.max_iter


@dataclass
class _State:
    """What an optimizer carries from step to step."""

    model: DeepFM
    path: str
    first: np.ndarray
    second: np.ndarray
    step: int = 0


def train_deepfm(
    train: DataFrame,
    vocab: DataFrame,
    slots: Sequence[str],
    dense: Sequence[str],
    key: str,
    settings: Settings,
    valid: DataFrame | None = None,
) -> tuple[DeepFM, list[dict]]:
    """Train on a transformed split; returns the model and one log row per step.

    An empty `hidden` trains the plain factorization machine.
    """
    spark = train.sparkSession
    rows = train.count()
    batches = max(1, math.ceil(rows / settings.batch_rows))
    batched = _write_batches(train, slots, dense, key, batches, settings)
    state = _start(vocab, slots, dense, settings)
    log = []
    iterations = settings.iterations(batches)
    for i in range(iterations):
        part = spark.read.parquet(batched).where(F.col("batch") == i % batches)
        loss = _step(state, part, key, settings)
        entry = {"iter": i + 1, "loss": loss, "auc": None}
        if valid is not None and _due(i + 1, settings.eval_interval):
            entry["auc"] = evaluate(valid, state.model, key, settings)
        if settings.snapshot_dir and _due(i + 1, settings.snapshot_interval):
            state.model.save(f"{settings.snapshot_dir}/snapshots/iter={i + 1}")
        log.append(entry)
    delete(spark, batched)
    return state.model, log


def _due(iteration: int, interval: int) -> bool:
    return interval > 0 and iteration % interval == 0


def evaluate(valid: DataFrame, model: DeepFM, key: str, settings: Settings) -> float | None:
    """AUC over the validation split, or over its first `eval_batches` batches."""
    if settings.eval_batches:
        valid = first_rows(valid, key, settings.eval_batches * settings.batch_rows)
    scored = score(valid, model, [key, "label"], key, settings.limits)
    return auc(scored, "logit", "label").collect()[0]["auc"]


def log_table(spark, log: list[dict]) -> DataFrame:
    """One row per iteration, a number the caller chose."""
    return spark.createDataFrame(log, "iter int, loss double, auc double")


def _write_batches(
    train: DataFrame,
    slots: Sequence[str],
    dense: Sequence[str],
    key: str,
    batches: int,
    settings: Settings,
) -> str:
    """The split by mini-batch, so that a step reads its own files only."""
    path = scratch_path(train.sparkSession, "batches")
    pieces = max(1, settings.batch_rows // 250_000)
    piece = F.pmod(F.xxhash64(F.col(key), F.lit(settings.seed + 1)), F.lit(pieces))
    assign_batches(train.select(key, "label", *slots, *dense), key, batches, settings.seed).repartition(
        F.col("batch"), piece
    ).write.partitionBy("batch").parquet(path)
    return path


def _start(
    vocab: DataFrame, slots: Sequence[str], dense: Sequence[str], settings: Settings
) -> _State:
    spark = vocab.sparkSession
    keys = slot_keys(vocab.where(F.col("col").isin(list(slots))), slots)
    table = random_vectors(keys, settings.seed, settings.vector_scale)
    if settings.optimizer == "adam":
        zero = F.array(*[F.lit(0.0)] * VECTOR)
        table = table.select("*", zero.alias("m"), zero.alias("v"))
    elif settings.optimizer != "sgd":
        raise ValueError(f"unknown optimizer: {settings.optimizer!r}")
    path = scratch_path(spark, "embeddings")
    table.write.parquet(path)
    params = network.start(len(slots), len(dense), settings.hidden, settings.seed)
    zeros = np.zeros(network.flatten(params).size)
    embeddings = Embeddings.of(spark.read.parquet(path), slots)
    return _State(DeepFM(embeddings, params, list(dense)), path, zeros, zeros.copy())


def gradients(
    batch: DataFrame, model: DeepFM, key: str, settings: Settings, step: int
) -> DataFrame:
    """`(slot, code, g)`: summed gradients per embedding key, dense weight chunk and loss."""
    spark = batch.sparkSession
    rows = model_input(
        batch,
        model.embeddings,
        model.dense,
        [key, F.col("label").cast("double").alias("label"), _codes(batch, model.slots)],
        key,
        settings.limits,
    )
    weights = spark.sparkContext.broadcast(model.params)
    slots, dense = len(model.slots), len(model.dense)
    dropout, seed = settings.dropout, settings.seed * 1_000_003 + step

    def run(batches):
        flat = np.zeros(network.flatten(weights.value).size)
        loss, count = 0.0, 0
        for b in batches:
            if not len(b):
                continue
            params = weights.value
            emb = network.matrix(b.column("_emb"), slots * VECTOR).reshape(-1, slots, VECTOR)
            x = network.matrix(b.column("_dense"), dense)
            label = np.asarray(b.column("label"))
            keys = np.asarray(b.column(key))
            logit, kept = network.forward(params, emb, x, dropout, keys, seed)
            grads, d_emb = network.backward(params, emb, x, label, logit, kept)
            flat += network.flatten(grads)
            loss += float(network.loss_of(logit, label).sum())
            count += len(label)
            yield _per_key(b.column("_codes"), d_emb)
        if count:
            padded = np.zeros(math.ceil(flat.size / VECTOR) * VECTOR)
            padded[: flat.size] = flat
            chunks = padded.reshape(-1, VECTOR)
            yield _rows(np.full(len(chunks), DENSE_SLOT), np.arange(len(chunks)), chunks)
            tail = np.zeros((1, VECTOR))
            tail[0, :2] = loss, count
            yield _rows(np.array([LOSS_SLOT]), np.array([0]), tail)

    def _rows(slot, code, values):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(slot, pa.int32()),
                pa.array(code, pa.int64()),
                pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), VECTOR).cast(
                    pa.list_(pa.float64())
                ),
            ],
            names=["slot", "code", "g"],
        )

    def _per_key(codes, d_emb):
        """Add up the rows of one Arrow batch per (slot, code)."""
        lengths = np.asarray(codes.flatten().value_lengths())  # keys per row and slot
        owner = np.repeat(np.arange(lengths.size), lengths)
        flat_codes = np.asarray(codes.flatten().flatten())
        pairs = np.stack([owner % slots, flat_codes])
        unique, position = np.unique(pairs, axis=1, return_inverse=True)
        sums = np.zeros((unique.shape[1], VECTOR))
        np.add.at(sums, position.ravel(), d_emb.reshape(-1, VECTOR)[owner])
        return _rows(unique[0], unique[1], sums)

    partial = rows.mapInArrow(run, "slot int, code bigint, g array<double>")
    return partial.groupBy("slot", "code").agg(
        F.array(*[F.sum(F.col("g")[j]) for j in range(VECTOR)]).alias("g")
    )


def _codes(batch: DataFrame, slots: Sequence[str]) -> Column:
    """All slots as lists of codes; a scalar slot is a list of one."""
    single = dict(batch.dtypes)
    return F.array(
        *[
            F.coalesce(F.col(c), F.array().cast("array<bigint>"))
            if single[c].startswith("array")
            else F.array(F.col(c))
            for c in slots
        ]
    ).alias("_codes")


def _step(state: _State, batch: DataFrame, key: str, settings: Settings) -> float:
    """One update; returns the mean loss of the batch before it."""
    spark = batch.sparkSession
    state.step += 1
    path = scratch_path(spark, "gradients")
    gradients(batch, state.model, key, settings, state.step).write.parquet(path)
    summed = spark.read.parquet(path)

    # Dense weights and loss: as many numbers as the network has, whatever the data.
    small = summed.where(F.col("slot") < 0).orderBy("slot", "code").toArrow()
    loss, count = small.column("g")[0].as_py()[:2]
    flat = network.flatten(state.model.params)
    chunks = small.column("g").slice(1).combine_chunks().flatten()
    grad = np.asarray(chunks)[: flat.size] / count
    params = network.unflatten(_dense_update(state, flat, grad, settings), state.model.params)

    fresh = scratch_path(spark, "embeddings")
    _vector_update(state, summed.where(F.col("slot") >= 0), count, settings).write.parquet(fresh)
    old = state.path
    table = spark.read.parquet(fresh)
    sizes = state.model.embeddings.side.sizes
    embeddings = Embeddings.of(table, state.model.slots, sizes)
    state.model, state.path = replace(state.model, embeddings=embeddings, params=params), fresh
    delete(spark, old)
    delete(spark, path)
    return loss / count


def _dense_update(state: _State, flat, grad, settings: Settings):
    if settings.optimizer == "sgd":
        return flat - settings.lr * grad
    b1, b2 = settings.beta1, settings.beta2
    state.first = b1 * state.first + (1 - b1) * grad
    state.second = b2 * state.second + (1 - b2) * grad**2
    first = state.first / (1 - b1**state.step)
    second = state.second / (1 - b2**state.step)
    return flat - settings.lr * first / (np.sqrt(second) + settings.epsilon)


def _vector_update(state: _State, summed: DataFrame, count: float, settings: Settings) -> DataFrame:
    """New embedding table; a key without a gradient has a zero one."""
    table = state.model.embeddings.table.join(summed, ["slot", "code"], "left")
    g = [F.coalesce(F.col("g")[j], F.lit(0.0)) / F.lit(float(count)) for j in range(VECTOR)]
    vec = [F.col("vec")[j].cast("double") for j in range(VECTOR)]
    if settings.optimizer == "sgd":
        new = [(x - F.lit(settings.lr) * d).cast("float") for x, d in zip(vec, g)]
        return table.select("slot", "code", F.array(*new).alias("vec"))
    b1, b2 = settings.beta1, settings.beta2
    moved = table.select(
        "slot",
        "code",
        "vec",
        F.array(*[F.col("m")[j] * b1 + d * (1 - b1) for j, d in enumerate(g)]).alias("m"),
        F.array(*[F.col("v")[j] * b2 + d * d * (1 - b2) for j, d in enumerate(g)]).alias("v"),
    )
    new = [
        (
            vec[j]
            - F.lit(settings.lr)
            * (F.col("m")[j] / (1 - b1**state.step))
            / (F.sqrt(F.col("v")[j] / (1 - b2**state.step)) + F.lit(settings.epsilon))
        ).cast("float")
        for j in range(VECTOR)
    ]
    return moved.select("slot", "code", F.array(*new).alias("vec"), "m", "v")
