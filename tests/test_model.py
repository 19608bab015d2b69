import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.model import network
from clickloom.model.deepfm import DeepFM, score, score_models
from clickloom.model.fm import score_fm, sparse_features, train_fm, with_vectors
from clickloom.model.fm_step import fm_step
from clickloom.model.search import best_trial, draw_trials
from clickloom.model.training import Settings, evaluate, train_deepfm
from clickloom.operators.embedding import (
    Embeddings,
    fm_order2,
    latent_vectors,
    linear_term,
    random_vectors,
    slot_keys,
)
from clickloom.operators.lookup import Limits
from clickloom.operators.metrics import auc, auc_by
from clickloom.operators.vocab import Vocabulary

SLOTS, DENSE = ["a", "b"], ["x", "y"]


def setup_batch(hidden, n=5, seed=0):
    rng = np.random.default_rng(seed)
    emb, dense = rng.normal(0, 0.3, (n, 3, 11)), rng.normal(0, 1, (n, 2))
    label = (rng.random(n) < 0.5).astype(float)
    params = network.start(3, 2, hidden, 1)
    for name, value in params.items():
        if name[0] == "b":  # off the kink, where a unit whose inputs are all dropped would sit
            value[:] = rng.normal(0, 0.5, value.shape)
    return params, emb, dense, label


def total_loss(params, emb, dense, label, **options):
    return network.loss_of(network.forward(params, emb, dense, **options)[0], label).sum()


@pytest.mark.parametrize("hidden", [(), (4,), (5, 3)])
@pytest.mark.parametrize("dropout", [0.0, 0.4])
def test_gradients_equal_finite_differences(hidden, dropout):
    params, emb, dense, label = setup_batch(hidden)
    options = {"dropout": dropout, "keys": np.arange(5), "seed": 3}
    logit, state = network.forward(params, emb, dense, **options)
    grads, d_emb = network.backward(params, emb, dense, label, logit, state)
    step = 1e-6
    for name, value in params.items():
        for at in list(np.ndindex(value.shape))[:7]:
            kept = value[at]
            value[at] = kept + step
            up = total_loss(params, emb, dense, label, **options)
            value[at] = kept - step
            down = total_loss(params, emb, dense, label, **options)
            value[at] = kept
            assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=1e-5)
    for at in [(0, 0, 0), (4, 2, 9), (2, 1, 10)]:
        kept = emb[at]
        emb[at] = kept + step
        up = total_loss(params, emb, dense, label, **options)
        emb[at] = kept - step
        down = total_loss(params, emb, dense, label, **options)
        emb[at] = kept
        assert d_emb[at] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_second_order_term_is_the_sum_over_pairs():
    params, emb, dense, _ = setup_batch(())
    logit, _ = network.forward(params, emb, dense)
    for row in range(len(dense)):
        vectors = list(emb[row, :, :10]) + [x * w for x, w in zip(dense[row], params["latent"])]
        pairs = sum(float(u @ v) for u, v in itertools.combinations(vectors, 2))
        linear = emb[row, :, 10].sum() + dense[row] @ params["linear"]
        assert logit[row] == pytest.approx(pairs + linear)


def test_dropout_mask_depends_on_key_not_on_place():
    whole = network.keep_mask(np.array([10, 20, 30]), 400, 0.5, 9)
    assert np.array_equal(network.keep_mask(np.array([30]), 400, 0.5, 9)[0], whole[2])
    assert 0.45 < whole.mean() < 0.55


@pytest.fixture(scope="module")
def data(spark):
    """Codes and values in which slot a and value x decide the label."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(1500):
        a = 1 if rng.random() < 0.34 else int(rng.integers(2, 8))
        x, b = float(rng.normal()), int(rng.integers(1, 30))
        rows.append((i, int((x > 0) == (a % 2 == 0)), a, b, x, float(rng.normal())))
    df = spark.createDataFrame(rows, "id long, label int, a long, b long, x double, y double")
    vocab = Vocabulary.fit(df, SLOTS)
    coded = vocab.encode(df).cache()
    return coded.where("id < 1200"), coded.where("id >= 1200"), vocab


def model_of(vocab, hidden):
    table = random_vectors(slot_keys(vocab.table, SLOTS), 3, 0.5)
    return DeepFM(Embeddings.of(table, SLOTS), network.start(2, 2, hidden, 2), DENSE)


@pytest.mark.parametrize(
    "limits", [Limits(), Limits(column_bytes=10, total_bytes=10, head_entries=3, hot_rows=30)]
)
def test_scores_equal_numpy_at_full_width(spark, data, limits):
    _, valid, vocab = data
    model = model_of(vocab, (400, 400, 400))
    vectors = {(r["slot"], r["code"]): r["vec"] for r in model.embeddings.table.collect()}
    rows = valid.collect()
    emb = np.array([[vectors[(0, r["a"])], vectors[(1, r["b"])]] for r in rows])
    dense = np.array([[r["x"], r["y"]] for r in rows])
    want = dict(zip([r["id"] for r in rows], network.forward(model.params, emb, dense)[0]))
    got = {r["id"]: r for r in score(valid, model, ["id"], "id", limits).collect()}
    assert len(got) == len(want)
    for key, logit in want.items():
        assert got[key]["logit"] == pytest.approx(logit, abs=1e-9)
        assert got[key]["score"] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)


def test_unknown_code_has_the_zero_vector(spark, data):
    _, _, vocab = data
    df = spark.createDataFrame([(1, 10**6)], "id long, a long")
    model = model_of(vocab, ())
    assert model.embeddings.lookup(df, {"a": "a"}).collect()[0]["a__vec"] == [0.0] * 11


def test_native_terms_equal_numpy(spark, data):
    _, valid, vocab = data
    model = model_of(vocab, ())
    looked = model.embeddings.lookup(valid)
    vectors = [F.col("a__vec"), F.col("b__vec")]
    dense = F.array(F.col("x"), F.col("y"))
    out = fm_order2(looked, latent_vectors(vectors, dense, model.params["latent"]), "fm")
    native = out.select("id", (F.col("fm") + linear_term(vectors, dense, model.params["linear"])).alias("z"))
    got = {r["id"]: r["z"] for r in native.collect()}
    want = {r["id"]: r["logit"] for r in score(valid, model, ["id"], "id").collect()}
    assert got == pytest.approx(want, abs=1e-6)


def test_list_slots_sum_their_vectors_and_train(spark, data):
    train, _, vocab = data
    lists = train.limit(200).withColumn(
        "a", F.expr("CASE WHEN id % 3 = 0 THEN array(a, 1L) WHEN id % 3 = 1 THEN array(a) END")
    )
    model = model_of(vocab, (4,))
    vectors = {(r["slot"], r["code"]): np.array(r["vec"]) for r in model.embeddings.table.collect()}
    got = {r["id"]: r["logit"] for r in score(lists, model, ["id"], "id").collect()}
    for r in lists.collect()[:20]:
        first = sum((vectors[(0, c)] for c in r["a"] or []), np.zeros(11))
        emb = np.array([[first, vectors[(1, r["b"])]]])
        want = network.forward(model.params, emb, np.array([[r["x"], r["y"]]]))[0][0]
        assert got[r["id"]] == pytest.approx(want, abs=1e-6)
    settings = Settings(batch_rows=500, hidden=(4,), max_iter=2, dropout=0.0, lr=0.1)
    _, log = train_deepfm(lists, vocab.table, SLOTS, DENSE, "id", settings)
    assert log[1]["loss"] < log[0]["loss"]


def test_step_equals_plain_gradient_descent(spark, data):
    """One step over the whole split against numpy, embeddings included."""
    train, _, vocab = data
    settings = Settings(batch_rows=5000, hidden=(4,), max_iter=1, dropout=0.0, lr=0.5, seed=2)
    model, log = train_deepfm(train, vocab.table, SLOTS, DENSE, "id", settings)
    params = network.start(2, 2, (4,), 2)
    start = random_vectors(slot_keys(vocab.table, SLOTS), 2, settings.vector_scale)
    vectors = {(r["slot"], r["code"]): np.array(r["vec"]) for r in start.collect()}
    rows = train.collect()
    emb = np.array([[vectors[(0, r["a"])], vectors[(1, r["b"])]] for r in rows])
    dense = np.array([[r["x"], r["y"]] for r in rows])
    label = np.array([r["label"] for r in rows], dtype=float)
    logit, state = network.forward(params, emb, dense)
    grads, d_emb = network.backward(params, emb, dense, label, logit, state)
    assert log[0]["loss"] == pytest.approx(network.loss_of(logit, label).mean())
    for name, value in params.items():
        want = value - 0.5 * grads[name] / len(rows)
        assert np.allclose(model.params[name], want, atol=1e-9)
    for i, r in enumerate(rows):
        vectors[(0, r["a"])] = vectors[(0, r["a"])] - 0.5 * d_emb[i, 0] / len(rows)
        vectors[(1, r["b"])] = vectors[(1, r["b"])] - 0.5 * d_emb[i, 1] / len(rows)
    for r in model.embeddings.table.collect():
        assert np.allclose(r["vec"], vectors[(r["slot"], r["code"])], atol=1e-6)


def test_training_finds_a_planted_signal_and_repeats(spark, data, tmp_path):
    train, valid, vocab = data
    settings = Settings(
        batch_rows=400,
        hidden=(16,),
        epochs=4,
        max_iter=1,
        lr=0.03,
        dropout=0.1,
        optimizer="adam",
        eval_interval=6,
        eval_batches=1,
        snapshot_interval=5,
        snapshot_dir=str(tmp_path),
        vector_scale=0.2,
    )
    model, log = train_deepfm(train, vocab.table, SLOTS, DENSE, "id", settings, valid)
    assert len(log) == 4 * 3  # epochs win over max_iter
    assert log[-1]["loss"] < log[0]["loss"]
    assert [e["iter"] for e in log if e["auc"] is not None] == [6, 12]
    quality = evaluate(valid, model, "id", settings)
    assert quality > 0.75
    loaded = DeepFM.load(spark, f"{tmp_path}/snapshots/iter=10")
    assert set(loaded.params) == set(model.params)
    short = Settings(batch_rows=600, hidden=(4,), max_iter=2, dropout=0.3, seed=5)
    one, two = (train_deepfm(train, vocab.table, SLOTS, DENSE, "id", short)[0] for _ in range(2))
    assert np.allclose(network.flatten(one.params), network.flatten(two.params), atol=1e-9)


def test_spark_ml_machine(spark, data):
    train, valid, vocab = data
    vector = sparse_features(SLOTS, DENSE, vocab.cardinalities())
    valid = with_vectors(valid, vector, ["id", "label", "a", "b", "x", "y"])
    model = train_fm(with_vectors(train, vector, ["label"]), factors=4, step_size=0.1, max_iter=30)
    scored = score_fm(valid, model, ["id", "label", "features"])
    assert auc(scored, "logit", "label").collect()[0]["auc"] > 0.6
    sizes = vocab.cardinalities()
    linear, factors = model.linear.toArray(), model.factors.toArray()
    assert len(linear) == sum(sizes.values()) + len(DENSE) == len(factors)
    for r in scored.join(valid.select("id", *SLOTS, *DENSE), "id").limit(40).collect():
        x = np.zeros(len(linear))
        x[[r.a, sizes["a"] + r.b]] = 1
        x[-2:] = [r.x, r.y]
        assert np.allclose(r.features.toArray(), x)
        pulled = x @ factors
        second = (pulled**2 - (x**2) @ factors**2).sum() / 2
        assert abs(r.logit - (model.intercept + linear @ x + second)) < 1e-6


def test_gradient_step_equals_numpy(spark, data):
    train, _, vocab = data
    table = random_vectors(slot_keys(vocab.table, SLOTS), 3, 0.5)
    weights = np.random.default_rng(4).normal(0, 0.3, (2, 11))
    rows = Embeddings.of(table, SLOTS).lookup(train.withColumn("y", F.when(F.col("id") % 7 > 0, F.col("y"))))
    got = {(r.slot, r.code, r.j): r.value for r in fm_step(rows, SLOTS, DENSE, table, weights.tolist(), train.count(), 0.7).collect()}
    given = rows.collect()
    emb = np.array([[r["a__vec"], r["b__vec"]] for r in given], float)
    dense = np.array([[r.x, r.y or 0.0] for r in given])
    label = np.array([r.label for r in given], float)
    params = {"latent": weights[:, :10], "linear": weights[:, 10]}
    logit, state = network.forward(params, emb, dense)
    grads, d_emb = network.backward(params, emb, dense, label, logit, state)
    want = {(r.slot, r.code): np.array(r.vec, float) for r in table.collect()}
    touched = set()
    for i, r in enumerate(given):
        for s, code in enumerate((r.a, r.b)):
            want[s, code] = want[s, code] - 0.7 * d_emb[i, s] / len(given)
            touched.add((s, code))
    for i in range(2):
        want[2 + i, 0] = weights[i] - 0.7 * np.append(grads["latent"][i], grads["linear"][i]) / len(given)
        touched.add((2 + i, 0))
    assert {k[:2] for k in got} == touched
    assert all(abs(got[s, code, j] - want[s, code][j]) < 1e-9 for s, code in touched for j in range(11))


def test_models_scored_in_one_scan(spark, data):
    _, valid, vocab = data
    models = {str(i): DeepFM(Embeddings.of(random_vectors(slot_keys(vocab.table, SLOTS), i, 0.5), SLOTS), network.start(2, 2, (5,), i), DENSE) for i in range(3)}
    got = {(r.id, r.model): r.logit for r in score_models(valid, models, ["id"]).collect()}
    assert len(got) == 3 * valid.count()
    for name, model in models.items():
        for r in score(valid, model, ["id"]).collect():
            assert abs(got[r.id, name] - r.logit) < 1e-9
    other = DeepFM(models["0"].embeddings, models["0"].params, DENSE[::-1])
    with pytest.raises(ValueError):
        score_models(valid, {"a": models["0"], "b": other}, ["id"])


def test_auc_of_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(None if g == 3 else g, int(rng.random() < 0.4), float(rng.integers(0, 12))) for g in range(5) for _ in range(60 * (g + 1))]
    rows += [(7, 1, 1.0), (8, None, 1.0), (8, 0, float("nan")), (0, 1, None)]
    got = {r.g: (r.auc, r.n_pos, r.n_neg) for r in auc_by(spark.createDataFrame(rows, "g int, label int, s double"), ["g"], "s", "label").collect()}
    for g in (0, 1, 2, None, 4):
        own = [(y, s) for k, y, s in rows if k == g and y is not None and s is not None]
        won = [(a > b) + (a == b) / 2 for y, a in own if y for z, b in own if not z]
        assert abs(got[g][0] - sum(won) / len(won)) < 1e-9 and got[g][1:] == (sum(y for y, _ in own), sum(1 - y for y, _ in own))
    assert got[7] == (None, 1, 0) and 8 not in got


def test_trials(spark):
    drawn = draw_trials(50, (0.001, 0.01), [0.4, 0.5, 0.6], 1)
    assert all(0.001 <= t["lr"] <= 0.01 for t in drawn)
    assert {t["dropout_rate"] for t in drawn} == {0.4, 0.5, 0.6}
    assert drawn == draw_trials(50, (0.001, 0.01), [0.4, 0.5, 0.6], 1)
    trials = spark.createDataFrame([(2, 0.7), (1, 0.7), (3, 0.6)], "trial_id int, auc double")
    assert best_trial(trials).collect()[0]["trial_id"] == 1
