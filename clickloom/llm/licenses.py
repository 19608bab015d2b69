"""License scan: ordered signature rules behind a keyword prefilter.

Texts become lower-case words (A-Z only; letters beyond ASCII belong to words) with one blank
between. One pass of an Aho-Corasick automaton finds the keywords a text holds; only the rules
of those keywords run. Overlapping detections are resolved in the order of priority, then
length: one that lies within an accepted detection is suppressed.

Null and empty texts have no words and no detections. Rows are scanned one by one, so repeated
rows give repeated results and an empty table an empty one; only the needed columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.license_rules import Rule, parse

# Phrases whose every place counts, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
PHRASE_CONFIDENCE = 0.9
SCHEMA = "n_words bigint, places array<struct<label:string,start:bigint>>, detections array<struct<label:string,confidence:double,start:bigint,end:bigint>>"

_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def normalize(text: str | None) -> bytes:
    """Lower-case words with one blank between, as UTF-8."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split())


def phrase_places(words: bytes) -> list[tuple[str, int]]:
    """(label, number of the first word) of every place of a phrase, overlapping ones too."""
    padded, out = b" " + words + b" ", []
    for phrase, label in PHRASES.items():
        needle = b" " + phrase.encode() + b" "
        at, last, number = padded.find(needle), 0, 0
        while at >= 0:
            number += padded.count(b" ", last, at)
            out.append((label, number))
            last, at = at, padded.find(needle, at + 1)
    return out


def word_numbers(words: str, places: set[int]) -> dict[int, int]:
    """The number of the word at each place: the blanks before it, counted in one pass."""
    out, last, number = {}, 0, 0
    for at in sorted(places):
        number += words.count(" ", last, at)
        out[at], last = number, at
    return out


def resolve(detections: list[tuple[int, int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Accept by priority, then length, then table order; drop what an accepted one contains.

    Accepted spans are kept as a list of maximal intervals by start, in which containment is
    one binary search, so a text with very many detections stays fast.
    """
    from bisect import bisect_right

    starts: list[int] = []
    ends: list[int] = []
    out = []
    for start, end, order, rule in sorted(detections, key=lambda d: (-d[3].priority, d[0] - d[1], d[2], d[0])):
        i = bisect_right(starts, start) - 1
        if i >= 0 and ends[i] >= end:
            continue
        out.append((start, end, rule))
        j = i + 1
        if i >= 0 and starts[i] == start:
            j = i  # the new span is longer than the one of the same start
        k = j
        while k < len(starts) and ends[k] <= end:
            k += 1
        starts[j:k], ends[j:k] = [start], [end]
    return out


class Scanner:
    """The compiled rules; one per worker process."""

    def __init__(self, rules: list[Rule]):
        import ahocorasick

        self.rules = rules
        by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            by_keyword.setdefault(rule.keyword, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for keyword, numbers in by_keyword.items():
            self.automaton.add_word(keyword, numbers)
        self.automaton.make_automaton()

    def detections(self, words: str) -> list[tuple[int, int, Rule]]:
        numbers = {i for _, found in self.automaton.iter(words) for i in found}
        hits = [
            (m.start(), m.end(), i, self.rules[i])
            for i in sorted(numbers)
            for m in self.rules[i].pattern.finditer(words)
        ]
        kept = resolve(hits)
        number = word_numbers(words, {at for a, b, _ in kept for at in (a, b)})
        return sorted(
            ((number[a], number[b] + 1, rule) for a, b, rule in kept),
            key=lambda d: (d[0], d[1], d[2].label),
        )


_scanners: dict[int, Scanner] = {}


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, number of words, phrase places, detections (word spans)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = _scanners.setdefault(0, Scanner(parse()))
        for batch in batches:
            counts, places, found = [], [], []
            for t in batch["_text"]:
                words = normalize(t)
                counts.append(words.count(b" ") + 1 if words else 0)
                places.append([{"label": label, "start": at} for label, at in phrase_places(words)])
                found.append([
                    {"label": r.label, "confidence": r.confidence, "start": a, "end": b}
                    for a, b, r in scanner.detections(words.decode("utf-8", "replace"))
                ])
            yield pd.DataFrame({"_key": batch["_key"], "n_words": counts, "places": places, "detections": found})

    kind = df.schema[key].dataType.simpleString()
    return (
        df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .mapInPandas(rows, f"_key {kind}, {SCHEMA}")
        .withColumnRenamed("_key", key)
    )


def licenses_query(df: DataFrame) -> DataFrame:
    out = scan(df)
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.transform("detections", lambda p: p["label"])
    sure = F.transform("detections", lambda p: p["confidence"])
    floor = F.when(F.size("places") > 0, F.lit(PHRASE_CONFIDENCE)).otherwise(F.lit(0.0))
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(floor, F.array_max(sure)).alias("score"),
    )
