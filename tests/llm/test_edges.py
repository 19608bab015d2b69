"""Every operator and stage on odd input: defined results, nothing dropped, no crash."""

import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from clickloom.llm import (
    components, decontaminate, exact_substrings, language, licenses, line_dedup, mixing, near_dedup, quality_rules, secrets, toxicity,
)
from pyspark.sql import functions as F

CLASHING = ["_text", "_key", "_t", "_id", "_row", "_doc", "_words", "_set", "row", "row2", "id", "doc", "n", "cls", "all",
            "gone", "lines", "bucket", "size", "score", "shard", "value", "line", "start", "spans", "held_out", "rest"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, and clashing columns."""
    long = " ".join(f"w{i % 997} word{i % 13}" for i in range(110_000))  # over a megabyte
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs away from here", "en", "a"),
        (1, "the quick brown fox jumps over the lazy dog and runs away from here", "en", "a"),
        (1, "another text of the same id\nwith a second line in it", "en", None),
        (2, None, None, None),
        (None, "a text without an id, and the quick brown fox jumps", "en", "b"),
        (None, None, "en", "b"),
        (3, "", "fr", "a"),
        (4, " \t\n ", "fr", ""),
        (5, "one", "de", "c"),
        (6, "one", "de", "c"),
        (7, "é" * 500, "fr", "c"),
        (8, long, "en", "a"),
        (9, long + " end", "en", "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])


LABELS = "doc_id long, quality int, toxic int, _key string, score double"


def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "x", 0.1), (1, 1, 0, "x", 0.1), (5, 0, 1, None, None), (None, 0, 1, "", 0.0), (6, 1, None, "", 0.0), (8, 1, 0, "", 0.0)], LABELS)


def items(spark):
    return spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog", "x"), (2, None, ""), (3, "", ""), (4, "one", ""), (None, "text of the same id with", "")],
        "item_id long, text string, value string",
    )


PER_ROW = {
    "substrings": lambda s, d: exact_substrings.substrings_query(d),
    "licenses": lambda s, d: licenses.licenses_query(d),
    "near": lambda s, d: near_dedup.near_query(d),
    "lines": lambda s, d: line_dedup.lines_query(d),
    "toxicity": lambda s, d: toxicity.toxicity_query(d, labels(s)),
    "secrets": lambda s, d: secrets.secrets_query(d),
    "quality": lambda s, d: quality_rules.quality_query(d),
    "language": lambda s, d: language.language_query(d),
    "mixing": lambda s, d: mixing.mix_query(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(spark, odd, name):
    ids = lambda rows: sorted(str(r["doc_id"]) for r in rows)
    assert ids(PER_ROW[name](spark, odd).collect()) == ids(odd.collect())


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, odd, name):
    assert PER_ROW[name](spark, odd.limit(0)).count() == 0


def test_leaks(spark, odd):
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks_query(odd, items(spark)).collect()}
    assert found == {(1, 1), (5, 4), (6, 4), (1, None)}
    short = spark.createDataFrame([(1, "lazy dog and"), (2, "dog lazy"), (3, "jumps")], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.n_item) for r in decontaminate.leaks_query(odd, short).collect()}
    assert found == {(1, 1, 1), (1, 3, 1), (None, 3, 1)}
    assert decontaminate.leaks_query(odd.limit(0), items(spark)).count() == 0
    assert decontaminate.leaks_query(odd, items(spark).limit(0)).count() == 0


def test_defined_results(spark, odd):
    near = near_dedup.near_query(odd).collect()
    assert {r.component_id for r in near if r.doc_id in (5, 6)} == {5}
    assert {r.component_id for r in near if r.doc_id in (8, 9)} == {8}
    assert all(r.n_shingles == 0 and r.kept for r in near if r.doc_id in (2, 3, 4))
    said = {r.doc_id: r for r in language.language_query(odd).collect()}
    assert said[2].lang_pred == said[3].lang_pred == "und" and said[3].score == 0
    cut = {r.doc_id: r for r in exact_substrings.substrings_query(odd).collect()}
    assert (cut[7].n_bytes, cut[7].n_removed, cut[7].n_spans) == (1000, 1000, 1)
    assert cut[8].n_bytes == cut[8].n_removed and cut[3].n_bytes == cut[3].n_spans == 0


def test_last_stage(spark, odd, tmp_path):
    name, mix = corpus_pipeline.STAGES[-1]
    out = mix(spark, odd, str(tmp_path)).collect()
    assert name == "mixing" and len(out) == odd.count() and sum(r.taken for r in out) > 0
    assert all(0 <= r.taken <= 2 * r.size for r in out) and mix(spark, odd.limit(0), str(tmp_path)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(150, 149)]
    star = [(7, i) for i in range(1000, 1200)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (3, 2), (2, 3)], "a long, b long")
    got = {r.node: r.label for r in components.components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(1000, 1200)}, 2: 2, 3: 2}
    assert components.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stage_keeps_columns(spark, odd, stage, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage[1](spark, odd, str(tmp_path))
    assert out.columns == odd.columns and 0 < out.count() <= odd.count()
    assert stage[1](spark, odd.limit(0), str(tmp_path)).count() == 0


def test_segments_are_fetched_in_bounded_batches(monkeypatch):
    """Whole texts come by the batch, but their segments go out by `FETCHED` bytes, each as it stands in its text."""
    monkeypatch.setattr(exact_substrings, "FETCHED", 2_000)
    texts = ["ab" * 800, "é" * 700, "xyz" * 500]
    wanted = [[{"shard": s, "salt": -1, "anchor": 7, "d1": i, "d2": s, "times": 2, "start": 50 * s, "windows": 3} for s in range(9)] for i in range(3)]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in wanted[0][0]]))
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(wanted, kind)], ["text", "wanted"])
    out = list(exact_substrings._fetch(iter([batch])))
    assert max(sum(map(len, b.column("bytes").to_pylist())) for b in out) <= 2_500
    got = [r for b in out for r in b.to_pylist()]
    assert [(r["d1"], r["shard"]) for r in got] == [(i, s) for i in range(3) for s in range(9)]
    assert all(r["bytes"] == texts[r["d1"]].encode()[50 * r["shard"] : 50 * r["shard"] + 402] for r in got)


def test_only_features_that_pass_the_screen_reach_the_driver(spark):
    """The same features as by the counts of all of them in numpy."""
    draw = np.random.default_rng(5)
    rows = [(float(i % 7 == 0), [1 + int(i % 7 == 0), 3, int(draw.integers(10, 9_000))]) for i in range(1_500)]
    sample = spark.createDataFrame(rows, "_label double, _terms array<int>")
    got = sorted(r["term"] for r in toxicity.screen(sample, sum(r[0] for r in rows) / len(rows), len(rows)).collect())
    seen, toxic = (np.bincount([t for y, ts in rows for t in ts for _ in range(int(w(y)))], minlength=9_000).astype(float) for w in (lambda y: 1, lambda y: y))
    base = sum(r[0] for r in rows) / len(rows)
    assert got == np.flatnonzero(toxicity.telling(seen, toxic, base) | toxicity.frequent(seen, len(rows))).tolist()
    assert 1 <= len(got) < 200


def test_the_fit_takes_little_memory_per_feature():
    """Under 48 bytes for each feature of the sample, where the trial is judged."""
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.zipf(1.3, 60) % 50_000) for _ in range(24_000)]
    flat, ends = np.concatenate(rows).astype(np.int32), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    label = np.array([float(7 in r[:9] and 11 in r[:12]) for r in rows])
    machine = toxicity.descend(flat, ends, label, np.unique(flat), epochs=0)
    tracemalloc.start()
    toxicity._worth(machine, flat, ends, label, np.unique(flat))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 * len(flat), peak / len(flat)
