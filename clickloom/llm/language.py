"""Language identification as a mixture of languages, by expectation-maximisation.

A language is a table of letter-trigram probabilities, counted over all learning texts; the
trigrams of a word include its edges and are hashed into `BUCKETS`, so a table has a fixed
size. A document is a mixture: each word comes from one of its languages. For the sets of the
one, two, three ... most likely languages, up to all learned ones, EM estimates the proportions
(until a step moves none of a text's by more than `TOLERANCE`), and the set with the best penalised likelihood (BIC over the words) is chosen. The search of a
document ends early only where the penalty alone exceeds the best cost so far. The operator
returns the set with its proportions; the query's prediction is the language with the largest
proportion, the score that proportion.

Null texts and texts without a letter have an empty set and give `und` with score 0, as does everything when there
is nothing to learn from. Rows with a null language are not learnt from; those with a null key
are neither learnt from nor held out. Repeated rows are handled one by one, an empty table
gives an empty result, and only the needed columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.heldout import held_out

BUCKETS = 1 << 16
SMOOTHING = 0.5
TOLERANCE = 1e-3
CHUNK = 1 << 19  # letters handled at once

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def pieces(text: str) -> Iterator[str]:
    """A text cut behind about `CHUNK` letters each, between words."""
    first = 0
    while len(text) - first > CHUNK:
        last = first + CHUNK
        while last < len(text) and text[last].isalpha():
            last += 1
        yield text[first:last]
        first = last
    yield text[first:]


def chunks(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Runs of pieces of texts of about `CHUNK` letters: (numbers of the texts, lower-cased pieces)."""
    owner, run, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in pieces(text or ""):
            owner.append(i)
            run.append(piece.lower())
            size += len(piece)
            if size >= CHUNK:
                yield owner, run
                owner, run, size = [], [], 0
    if run:
        yield owner, run


def trigrams(run: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each letter's trigram; offset of each word in it; text number of each word.

    Everything that is not a letter counts as one and the same edge, so a trigram never spans words.
    """
    joined = "\n" + "\n".join(run) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[code]
    code = np.where(letter, code, 0)
    at = np.flatnonzero(letter)
    with np.errstate(over="ignore"):
        mixed = code[at - 1] * np.uint32(2654435761) + code[at] * np.uint32(2246822519) + code[at + 1] * np.uint32(3266489917)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(668265263)
    bucket = mixed >> np.uint32(16)
    first = np.flatnonzero(~letter[at - 1])
    ends = np.cumsum([len(x) + 1 for x in run])
    return bucket, first, np.searchsorted(ends, at[first] - 1, side="right")


def learn(df: DataFrame, key: str, text: str, lang: str) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities (bucket x language).

    Tasks add up their own counts, so the shuffle holds a few thousand rows per task and
    language. What reaches the driver is one row of `BUCKETS` counts per language.
    """

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, part in batch.groupby("lang"):
                own = total.setdefault(name, np.zeros(BUCKETS, np.int64))
                for _, run in chunks(part["text"].tolist()):
                    own += np.bincount(trigrams(run)[0], minlength=BUCKETS)
        for name, own in total.items():
            used = np.flatnonzero(own)
            yield pd.DataFrame({"lang": name, "bucket": used.astype(np.int32), "n": own[used]})

    rows = df.where(
        F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull() & ~held_out(key)
    ).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    table = (
        rows.mapInPandas(counts, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n"))
        .toPandas().sort_values("lang")
    )
    model = np.full((BUCKETS, len(table)), SMOOTHING)
    for j, row in enumerate(table.itertuples()):
        model[np.asarray(row.bucket, np.int64), j] += np.asarray(row.n, np.float64)
    return table["lang"].tolist(), np.log(model / model.sum(axis=0)).astype(np.float32)


def proportions(likely: np.ndarray, first: np.ndarray, chosen: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over the chosen languages of every text: proportions, and log likelihood per text.

    `likely` (word x language) is scaled by each word's best language; words of a text are
    adjacent, from `first` on. A text takes part until its proportions stand still; texts with a single
    chosen language need no step.
    """
    share = chosen / chosen.sum(axis=1, keepdims=True)
    moving = np.flatnonzero(chosen.sum(axis=1) > 1)
    own = likely if len(moving) == len(first) else likely[np.repeat(chosen.sum(axis=1) > 1, words)]
    count = words[moving]
    while len(moving):
        before = share[moving]
        part = own * np.repeat(before, count, axis=0)
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        after = np.add.reduceat(part, np.cumsum(count) - count, axis=0) / count[:, None]
        share[moving] = after
        still = np.abs(after - before).max(axis=1) > TOLERANCE
        if not still.all():
            own = own[np.repeat(still, count)]
            moving, count = moving[still], count[still]
    text_of = np.repeat(np.arange(len(first)), words)
    weight = np.log(np.maximum((likely * share[text_of]).sum(axis=1), 1e-30))
    return share, np.add.reduceat(weight, first)


def word_likelihoods(texts: list[str | None], model: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of whole texts: the text's number of every word, and its log likelihood by language.

    Trigrams are looked up piece by piece, so a long text costs a row per word, not per letter.
    """
    owners, rows, size = [], [], 0
    for owner, run in chunks(texts):
        bucket, first, piece = trigrams(run)
        whole = np.asarray(owner)
        if size >= CHUNK and owners and len(first) and owners[-1][-1] < whole[piece[0]]:
            yield np.concatenate(owners), np.concatenate(rows)
            owners, rows, size = [], [], 0
        if len(first):
            owners.append(whole[piece])
            rows.append(np.add.reduceat(model[bucket], first, axis=0))
            size += len(bucket)
    if owners:
        yield np.concatenate(owners), np.concatenate(rows)


def mixtures(texts: list[str | None], model: np.ndarray) -> np.ndarray:
    """Proportions (text x language) of the best set of each text; a row of zeros is the empty set."""
    out = np.zeros((len(texts), model.shape[1]))
    if not model.shape[1]:
        return out
    for text, log_likely in word_likelihoods(texts, model):
        top = log_likely.max(axis=1, keepdims=True)
        likely = np.exp(np.maximum(log_likely - top, -60)).astype(np.float32)
        numbers, begins, words = np.unique(text, return_index=True, return_counts=True)
        everything = np.ones((len(numbers), model.shape[1]), np.float32)
        share, _ = proportions(likely, begins, everything, words)
        place = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
        least = np.full(len(numbers), np.inf)
        for k in range(1, model.shape[1] + 1):
            # No word is likelier than in its best language, where it counts as 1: no cost is below its penalty.
            left = (k - 1) * np.log(np.maximum(words, 2)) < least - 1e-9
            if not left.all():
                likely = likely[np.repeat(left, words)]
                numbers, words, place, least = numbers[left], words[left], place[left], least[left]
                begins = np.cumsum(words) - words
            if not len(numbers):
                break
            now, fit = proportions(likely, begins, (place < k).astype(np.float32), words)
            cost = -2 * fit + (k - 1) * np.log(np.maximum(words, 2))
            better = cost < least - 1e-9
            least = np.where(better, cost, least)
            out[numbers[better]] = now[better]
    return np.clip(out, 0.0, 1.0)


def predict(df: DataFrame, names: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, held_out, languages` per row: the best set as (lang, proportion), largest first.

    The model (256 KB a language) goes out by broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    labels = np.array(names, dtype=object)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            said, share = [], []
            for own in mixtures(batch["_text"].tolist(), shared.value):
                order = np.argsort(-own, kind="stable")[: np.count_nonzero(own)]
                said.append(labels[order].tolist())
                share.append(own[order])
            yield pd.DataFrame({"_key": batch["_key"], "held_out": batch["_held"], "_said": said, "_share": share})

    kind = df.schema[key].dataType.simpleString()
    pair = F.zip_with("_said", "_share", lambda a, b: F.struct(a.alias("lang"), b.alias("proportion")))
    return (
        df.select(F.col(key).alias("_key"), held_out(key).alias("_held"), F.col(text).alias("_text"))
        .mapInPandas(rows, f"_key {kind}, held_out boolean, _said array<string>, _share array<double>")
        .select(F.col("_key").alias(key), "held_out", pair.alias("languages"))
    )


def language_query(df: DataFrame) -> DataFrame:
    names, model = learn(df, "doc_id", "text", "lang")
    first = F.get("languages", F.lit(0))
    return predict(df, names, model).select(
        "doc_id", "held_out", F.coalesce(first["lang"], F.lit("und")).alias("lang_pred"),
        F.coalesce(first["proportion"], F.lit(0.0)).alias("score"),
    )
