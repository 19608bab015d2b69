"""Parts of a job that were once left out."""

import random
from collections import Counter

import numpy as np
from clickloom.llm import language, line_dedup, secrets, toxicity


def test_toxicity_learns_from_the_whole_bound_and_moves_only_screened_terms(spark, monkeypatch):
    rows = spark.range(44_000).selectExpr("id doc_id", "concat('plain', id % 997, ' ', id, if(id % 3 = 0, ' zorg', ' fine')) text")
    labels = spark.range(44_000).selectExpr("id doc_id", "cast(id % 3 = 0 as int) toxic")
    given = []
    monkeypatch.setattr(toxicity, "fit", lambda flat, offsets, label: given.append((flat, offsets, label)))
    toxicity.learn(rows, labels, "doc_id", "text", "toxic", toxicity.LEARN_ROWS)
    flat, offsets, label = given[0]
    assert 29_000 < len(label) < 31_000 and len(offsets) == len(label) + 1
    words = rows.limit(2).select("doc_id", toxicity.terms(rows["text"]).alias("t")).orderBy("doc_id").collect()
    assert set(np.unique(flat)) == {words[0].t[-1], words[1].t[-1]}
    assert (flat[offsets[:-1]] == np.where(label > 0, words[0].t[-1], words[1].t[-1])).all()


def _fitted_scores(docs, label, n):
    """A machine fitted on the first `n` of some lists of places, and the scores of all."""
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in docs])])
    flat = np.concatenate([np.array(x, np.int32) for x in docs])
    found, row = toxicity.features(flat, offsets)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(docs)))])
    machine = toxicity.fit(found[: ends[n]].astype(np.int32), ends[: n + 1], label[:n])
    at, row = machine.active(flat, offsets)
    return toxicity.logistic(machine.margin(at, row, len(docs))[0])


def test_toxicity_finds_pairs_of_harmless_words():
    draw = np.random.default_rng(3)
    docs = [list(draw.choice(np.arange(1, 3001), 30)) for _ in range(20_000)]
    label = (draw.random(20_000) < 0.11).astype(float)
    for i in np.flatnonzero(label):
        docs[i].append(5000)
    clean = np.flatnonzero(label == 0)[:220]
    for k, i in enumerate(clean):  # an insult in 120 texts, a group in 120, both in 20, which are toxic
        docs[i] += [6000] * (k < 120) + [7000] * (k < 20 or k >= 120)
    label[clean[:20]] = 1
    scores = _fitted_scores(docs, label, 20_000)
    assert (scores[clean[:20]] >= 0.3).all() and (scores[clean[20:]] < 0.3).all()


def test_toxicity_learns_exclusive_or():
    draw = np.random.default_rng(5)
    one, two = draw.random((2, 6000)) < 0.5
    docs = [list(draw.choice(np.arange(1, 300), 12)) + [1000] * int(a) + [2000] * int(b) for a, b in zip(one, two, strict=True)]
    label = (one != two).astype(float)
    scores = _fitted_scores(docs, label, 4000)
    assert ((scores >= 0.5) == (label > 0))[4000:].mean() > 0.97


def test_line_dedup_drops_equal_lines_of_every_length(spark):
    rows = [(1, "a\n  short line\n\n-----"), (2, "short line \n\n \nshort lime\na"), (3, "-----\n\nown"), (4, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    dropped = lambda **options: {
        r.doc_id: (r.n_lines, r.n_exact, r.n_near, r.dropped) for r in line_dedup.lines_query(df, **options).collect()
    }
    assert dropped() == {1: (3, 0, 0, ""), 2: (3, 2, 0, "0,4"), 3: (2, 1, 0, "0"), 4: (1, 1, 0, "0")}
    assert dropped(near_least=10)[2] == (3, 2, 1, "0,3,4")
    left = {r.doc_id: r.text for r in line_dedup.drop_lines(df).collect()}
    assert left == {1: rows[0][1], 2: "\n \nshort lime", 3: "\nown"}


def test_secrets_passes_uniform_tokens_of_every_encoding(spark):
    random.seed(8)
    low, up, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    of = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "low": low, "up": up, "b32": low + "234567", "B32": up + "234567",
          "b36": low + digits, "B36": up + digits, "b64": up + low + digits + "+/"}
    rows = [(name, n, "".join(random.choices(x, k=n))) for name, x in of.items() for n in (32, 52, 64, 100, 128) for _ in range(60)]
    tests = secrets.tested(spark.createDataFrame(rows, "encoding string, n int, match string"))
    found = Counter((r.encoding, r.n) for r in tests.select("encoding", "n", "p_random").collect() if r.p_random >= 0.001)
    assert len(found) == 45 and min(found.values()) >= 57, found
    plain = ["thereisnothingeithergoodorbadbutthinkingmakesitso", "itwasthebestoftimesitwastheworstoftimes"]
    wanted = [(i, f"see {token}.") for i, (name, n, token) in enumerate(rows) if n >= 64 and name != "hex"]
    texts = wanted + [(-1 - i, f"see {x}.") for i, x in enumerate(plain * 20)]
    got = {r.doc_id: r.spans for r in secrets.secrets_query(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert sum("random:" in got[i] for i, _ in wanted) >= 0.97 * len(wanted)
    assert not any(got[i] for i in got if i < 0)


def test_language_sets_have_no_bound(spark):
    random.seed(5)
    letters = {f"l{i}": "abcdefghijklmnopqrstuvwx"[4 * i : 4 * i + 4] for i in range(6)}
    words = lambda lang, n: ["".join(random.choices(letters[lang], k=6)) for _ in range(n)]
    learnt = [(100 + i, " ".join(words(f"l{i % 6}", 200)), f"l{i % 6}") for i in range(60)]
    mixed = [(i, " ".join(w for lang in list(letters)[:i] for w in words(lang, 40)), None) for i in range(7)]
    df = spark.createDataFrame(learnt + mixed, "doc_id long, text string, lang string")
    names, model = language.learn(df, "doc_id", "text", "lang")
    sets = {r.doc_id: r.languages for r in language.predict(df, names, model).where("doc_id < 7").collect()}
    for i in range(7):
        assert sorted(x.lang for x in sets[i]) == list(letters)[:i]
        assert all(abs(x.proportion - 1 / i) < 0.02 for x in sets[i])
    score = {r.doc_id: (r.lang_pred, r.score) for r in language.language_query(df).where("doc_id < 7").collect()}
    assert score[0] == ("und", 0.0) and abs(score[6][1] - 1 / 6) < 0.02
