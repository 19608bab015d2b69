"""Toxicity: a factorization machine over hashed terms.

A text's features are its distinct lower-case words and, once more, those that it repeats,
both hashed into `FEATURES` places. The
machine adds a weight per term and the inner product of two vectors per pair of terms, so a
pair can weigh more than its parts: an insult beside a mention of a group.

It is fitted on at most `learn_rows` labelled rows (30,000, taken by a hash of the key). Terms
are chosen in two ways. One: they stand in two rows or more, and their share of toxic texts is not
explained by chance (|z| >= 4). Two, for terms that matter only beside others: they stand in one of
two hundred rows (20 at least), a first machine is fitted with all of them, and without the term
its loss would be larger by one, and by three times what nine of ten such terms are worth. All other
terms weigh nothing, so a rarer word that is harmless alone is not learnt as part of a pair. Rows with crc32(key) mod 4 = 2 and rows
with a null key or label are never learnt from.

Null and empty texts have no terms and get the score of the bias alone; without anything to
learn from, all scores are 0. Repeated rows are scored one by one, repeated labels of a key
are learnt from like rows, an empty table gives an empty result, and only the needed columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.heldout import held_out
from clickloom.llm.text import NOT_WORD, lower_ascii, sliced, words
from clickloom.storage import materialize

FEATURES = 1 << 20
FACTORS = 4
LEARN_ROWS = 30_000
THRESHOLD = 0.3
LEAST_SEEN, LEAST_SHARE, TRIAL_EPOCHS = 20, 0.005, 10


def terms(text: Column) -> Column:
    """The place of every word, in the order of the text."""
    return F.transform(words(lower_ascii(text), NOT_WORD), lambda w: F.pmod(F.xxhash64(w), F.lit(FEATURES)).cast("int"))


def repeated(place: np.ndarray) -> np.ndarray:
    """The place of the feature that says a term stands in a text twice or more."""
    return (place.astype(np.int64) * 2654435761 + 97) % FEATURES


def features(flat: np.ndarray, offsets: np.ndarray, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) pairs, by row, of rows whose terms are `flat[offsets[i]:offsets[i + 1]]`.

    With `place`, only terms that it knows, alone or repeated.
    """
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    flat = flat.astype(np.int64)
    if place is not None:
        known = (place[flat] >= 0) | (place[repeated(flat)] >= 0)
        flat, row = flat[known], row[known]
    pairs, counts = np.unique(row * FEATURES + flat, return_counts=True)
    again = pairs[counts > 1]
    pairs = np.unique(np.concatenate([pairs, again // FEATURES * FEATURES + repeated(again % FEATURES)]))
    return pairs % FEATURES, pairs // FEATURES


@dataclass
class Machine:
    """`place` maps a feature to a row of `weight` and `factor`; -1 is no row."""

    place: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def active(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The known features of the rows, as rows of `weight`, and their row numbers."""
        found, row = features(flat, offsets, self.place)
        at = self.place[found]
        return at[at >= 0], row[at >= 0]

    def margin(self, at: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Log odds per row, and the rows' sums of factors."""
        total = np.stack([np.bincount(row, self.factor[at, k], n) for k in range(FACTORS)], axis=1)
        squares = np.bincount(row, (self.factor**2).sum(axis=1)[at], n)
        return self.bias + np.bincount(row, self.weight[at], n) + 0.5 * ((total**2).sum(axis=1) - squares), total


def logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def telling(seen: np.ndarray, toxic: np.ndarray, base: float, least_z: float = 4.0) -> np.ndarray:
    """Whether features that stand in `seen` rows, `toxic` of them toxic, pass the screen."""
    z = (toxic - base * seen) / np.sqrt(np.maximum(base * (1 - base) * seen, 1e-9))
    return (seen >= 2) & (np.abs(z) >= least_z)


def frequent(seen: np.ndarray, n: int) -> np.ndarray:
    """Whether features stand in enough of `n` rows to be tried beside others."""
    return seen >= max(LEAST_SEEN, LEAST_SHARE * n)


def fit(flat: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> Machine:
    """Fit to rows whose features are `flat[offsets[i]:offsets[i + 1]]`, labelled 0 or 1."""
    seen = np.bincount(flat, minlength=FEATURES).astype(float)
    positive = np.repeat(label > 0, np.diff(offsets))
    alone = telling(seen, np.bincount(flat[positive], minlength=FEATURES), label.mean())
    tried = np.flatnonzero(frequent(seen, len(label)) & ~alone)
    if len(tried):
        both = alone.copy()
        both[tried] = True
        worth = _worth(descend(flat, offsets, label, np.flatnonzero(both), epochs=TRIAL_EPOCHS), flat, offsets, label, tried)
        alone[tried[worth >= max(1.0, 3 * float(np.quantile(worth, 0.9)))]] = True
    return descend(flat, offsets, label, np.flatnonzero(alone))


def _worth(machine: Machine, flat: np.ndarray, offsets: np.ndarray, label: np.ndarray, tried: np.ndarray) -> np.ndarray:
    """How much larger the machine's loss would be without each of the features, all else as it is."""
    n = len(label)
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    known = machine.place[flat] >= 0
    at, row = machine.place[flat[known]], row[known]
    margin, total = machine.margin(at, row, n)
    out = np.zeros(len(machine.weight))
    for first in range(0, len(at), 1 << 16):
        a, r = at[first : first + (1 << 16)], row[first : first + (1 << 16)]
        share = machine.weight[a] + ((total[r] - machine.factor[a]) * machine.factor[a]).sum(axis=1)
        loss = lambda z, r=r: np.logaddexp(0, z) - label[r] * z
        out += np.bincount(a, loss(margin[r] - share) - loss(margin[r]), len(out))
    return out[machine.place[tried]]


def descend(
    flat: np.ndarray, offsets: np.ndarray, label: np.ndarray, used: np.ndarray,
    epochs: int = 40, batch: int = 256, rate: float = 0.3, decay: float = 1e-5, seed: int = 7,
) -> Machine:
    """Logistic loss of the features `used` by Adagrad over shuffled batches, the same for the same rows in the same order."""
    n, base = len(label), label.mean()
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    place = np.full(FEATURES, -1, np.int32)
    place[used] = np.arange(len(used))
    draw = np.random.default_rng(seed)
    odds = float(np.log((base + 1e-6) / (1 - base + 1e-6)))
    machine = Machine(place, odds, np.zeros(len(used)), draw.normal(0, 0.01, (len(used), FACTORS)))
    known = place[flat] >= 0
    at, row = place[flat[known]], row[known]
    bounds = np.searchsorted(row, np.arange(n + 1))
    past = [1e-6, np.full(len(used), 1e-6), np.full((len(used), FACTORS), 1e-6)]
    for _ in range(epochs):
        order = draw.permutation(n)
        for first in range(0, n, batch):
            rows = order[first : first + batch]
            sizes = bounds[rows + 1] - bounds[rows]
            own = np.repeat(np.arange(len(rows)), sizes)
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x = at[np.repeat(bounds[rows], sizes) + inside]
            margin, total = machine.margin(x, own, len(rows))
            slope = (logistic(margin) - label[rows]) / len(rows)
            touched, back = np.unique(x, return_inverse=True)
            pull = slope[own][:, None]
            g_bias = slope.sum()
            g_weight = np.bincount(back, slope[own], len(touched)) + decay * machine.weight[touched]
            g_factor = decay * machine.factor[touched]
            step = pull * (total[own] - machine.factor[x])
            for k in range(FACTORS):
                g_factor[:, k] += np.bincount(back, step[:, k], len(touched))
            past[0] += g_bias**2
            past[1][touched] += g_weight**2
            past[2][touched] += g_factor**2
            machine.bias -= rate * g_bias / np.sqrt(past[0])
            machine.weight[touched] -= rate * g_weight / np.sqrt(past[1][touched])
            machine.factor[touched] -= 0.3 * rate * g_factor / np.sqrt(past[2][touched])
    return machine


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms to features, row by row."""
    for part in sliced(batches):
        lists = part.column("_terms")
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        found, row = features(lists.flatten().to_numpy(zero_copy_only=False), ends)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))]).astype(np.int32)
        made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([part.column("_key"), part.column("_label"), made], ["_key", "_label", "_terms"])


def screen(sample: DataFrame, base: float, n: int) -> DataFrame:
    """The features of `n` rows, `base` of them toxic, that are `telling` or `frequent`, in a column `term`."""
    spread = F.sqrt(F.greatest(base * (1 - base) * F.col("seen"), F.lit(1e-9)))
    z = (F.col("toxic") - base * F.col("seen")) / spread
    alone = (F.col("seen") >= 2) & (F.abs(z) >= 4.0)
    return (
        sample.select("_label", F.explode("_terms").alias("term")).groupBy("term")
        .agg(F.count("*").cast("double").alias("seen"), F.sum("_label").alias("toxic"))
        .where(alone | (F.col("seen") >= max(LEAST_SEEN, LEAST_SHARE * n))).select("term")
    )


def learn(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn_rows: int) -> Machine | None:
    """Fit on a sample of the labelled rows of at most about `learn_rows`, chosen by a hash of the key.

    What comes to the driver are the numbers of the features that pass the screen (at most `FEATURES`), then
    that bounded sample with only those features. The labelled rows are found by a join of keys,
    so unlabelled texts are hashed but never moved.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).select(
        F.col(key).alias("_key"), (F.col(label) > 0).cast("double").alias("_label")
    )
    share = min(1.0, learn_rows / max(1, known.count()))
    known = materialize(known.where(F.pmod(F.xxhash64(F.lit("learn"), "_key"), F.lit(1_000_000)) < round(share * 1e6)), "toxic-labels")
    sample = (
        df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(known, "_key")
        .select("_key", "_label", terms(F.col("_text")).alias("_terms"))
    )
    sample = materialize(sample.mapInArrow(_featured, sample.schema), "toxic-features")
    base = sample.agg(F.avg("_label")).first()[0]
    if base is None:
        return None
    kept = np.zeros(FEATURES, bool)
    kept[screen(sample, base, sample.count()).toArrow()["term"].to_numpy()] = True
    shared = df.sparkSession.sparkContext.broadcast(kept)

    def screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            lists = batch.column("_terms")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            known = shared.value[flat]
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            before = np.concatenate([[0], np.cumsum(known)])
            made = pa.ListArray.from_arrays(pa.array(before[ends].astype(np.int32)), pa.array(flat[known]))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_label"), made], ["_key", "_label", "_terms"])

    table = sample.mapInArrow(screened, sample.schema).toArrow().sort_by([("_key", "ascending"), ("_label", "ascending")])
    lists = table["_terms"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    return fit(flat, offsets, table["_label"].to_numpy())


def score(df: DataFrame, machine: Machine | None, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add `score` to key (and the columns in `keep`). The machine (a few MB) goes out by broadcast."""
    kept = [key] if keep is None else keep
    rows = df.select(*kept, terms(F.coalesce(F.col(text), F.lit(""))).alias("_terms"))
    if machine is None:
        return rows.drop("_terms").withColumn("score", F.lit(0.0))
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            lists = batch.column("_terms")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            at, row = model.active(lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]))
            out = logistic(model.margin(at, row, len(lengths))[0])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(out)], [*kept, "score"])

    schema = rows.drop("_terms").withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(scored, schema)


def drop_toxic(df: DataFrame, machine: Machine | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `df`, all columns, whose score is below the threshold."""
    rows = df.select(F.struct("*").alias("all"), F.col(text).alias("_text"))
    return score(rows, machine, text="_text", keep=["all"]).where(F.col("score") < threshold).select("all.*")


def toxicity_query(df: DataFrame, labels: DataFrame) -> DataFrame:
    machine = learn(df, labels, "doc_id", "text", "toxic", LEARN_ROWS)
    out = score(df, machine)
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
