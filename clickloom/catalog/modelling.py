"""Embedding lookups, factorization-machine terms, metrics, scoring, requests, training."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Window, functions as F

from clickloom.catalog.clicks import TRAIN_DAYS, VALID_DAYS, clicks, clicks_sql
from clickloom.catalog.datasets import prepare_tables
from clickloom.catalog.features import LIST_CTES, TAIL_LIMITS, fitted_workflow, int_clicks, lists
from clickloom.catalog.sqltext import rounded, transformed_ctes, with_clicks
from clickloom.model import network
from clickloom.model.deepfm import DeepFM, score, score_models, score_raw
from clickloom.model.fm import FEATURES, score_fm, sparse_features, train_fm, with_vectors
from clickloom.model.fm_step import fm_step
from clickloom.operators import metrics
from clickloom.operators.embedding import (
    LATENT,
    VECTOR,
    Embeddings,
    fm_order2,
    latent_vectors,
    linear_term,
    slot_keys,
)
from clickloom.operators.lookup import Limits
from clickloom.operators.ordering import first_rows
from clickloom.operators.vocab import encode_lists, fit_lists
from clickloom.plans.jobs import load_package
from clickloom.schema import categorical_columns, continuous_columns
from clickloom.sources.scans import scan_requests
from clickloom.storage import materialize, scratch_path
from clickloom.streaming import requests

CATS, CONTS = categorical_columns(), continuous_columns()

# A fixed model whose every weight has a formula, so that SQL can compute it too.


def fixed_vector(keys):
    elements = [
        F.expr(f"CAST((slot*31 + code*17 + {7 * j}) % 101 - 50 AS DOUBLE)/100")
        for j in range(VECTOR)
    ]
    return keys.select("slot", "code", F.array(*elements).alias("vec"))


def fixed_weight(row: int, column: int) -> float:
    return ((row * 13 + column * 7) % 21 - 10) / 100.0


def fixed_linear(row: int) -> float:
    return ((row * 5) % 11 - 5) / 100.0


def fixed_params(hidden: tuple[int, ...]) -> dict[str, np.ndarray]:
    params = network.start(len(CATS), len(CONTS), hidden, 0)
    for name, value in params.items():
        if value.ndim == 2:
            rows, columns = np.indices(value.shape)
            value[:] = ((rows * 13 + columns * 7) % 21 - 10) / 100.0
        elif name == "linear":
            value[:] = [fixed_linear(i) for i in range(len(value))]
        else:
            value[:] = 0.01 * (np.arange(len(value)) + 1)
    return params


def embeddings_of(fitted) -> Embeddings:
    return Embeddings.of(fixed_vector(slot_keys(fitted.vocabulary(), CATS)), CATS)


def model_of(fitted, hidden) -> DeepFM:
    return DeepFM(embeddings_of(fitted), fixed_params(hidden), CONTS)


def rounded_to(name, digits=4):
    return (F.round(F.col(name), digits) + F.lit(0.0)).alias(name)


def _looked_up(spark, sf):
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    rows = fitted.transform(df, "event_id")
    return embeddings_of(fitted).lookup(rows)


def _vectors():
    return [F.col(f"{c}__vec") for c in CATS]


def _dense():
    return F.array(*[F.col(c).cast("double") for c in CONTS])


def _fm(df):
    weights = [[fixed_weight(i, d) for d in range(LATENT)] for i in range(len(CONTS))]
    return fm_order2(df, latent_vectors(_vectors(), _dense(), weights), "fm")


def _linear():
    return linear_term(_vectors(), _dense(), [fixed_linear(i) for i in range(len(CONTS))])


def fm_order2_query(spark, sf):
    return _fm(_looked_up(spark, sf)).select("event_id", rounded_to("fm"))


def linear_query(spark, sf):
    df = _looked_up(spark, sf).withColumn("linear", _linear())
    return df.select("event_id", rounded_to("linear"))


def _fm_logits(spark, sf):
    """Scores of the model without a tower: second-order term plus linear term."""
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    return score_raw(df, fitted, model_of(fitted, ()), ["event_id", "label"], "event_id")


def fm_logit(spark, sf):
    return _fm_logits(spark, sf).select("event_id", "label", rounded_to("logit"))


def embedding_sum(spark, sf, limits=Limits()):
    df = lists(spark, sf)
    vocab = fit_lists(df.where(TRAIN_DAYS), "M")
    coded = encode_lists(df, vocab, "M", "event_id", limits=limits)
    table = fixed_vector(slot_keys(vocab.table, ["M"]))
    summed = Embeddings.of(table, ["M"]).lookup_sum(coded, "M", "M", "event_id", limits)
    return summed.select(
        "event_id", *[(F.round(F.col("M__vec")[j], 4) + 0.0).alias(f"v{j}") for j in range(VECTOR)]
    )


def log_loss(spark, sf):
    return metrics.log_loss(_fm_logits(spark, sf), "logit", "label").select(rounded_to("log_loss", 6))


def auc(spark, sf):
    """Of a count column, which has many ties."""
    df = clicks(spark, sf).select("label", F.coalesce("I3", F.lit(0)).alias("s"))
    return metrics.auc(df, "s", "label").select(rounded_to("auc", 6), "n_pos", "n_neg")


def auc_model(spark, sf):
    scored = _fm_logits(spark, sf).select("label", F.round("logit", 6).alias("s"))
    return metrics.auc(scored, "s", "label").select(rounded_to("auc", 6), "n_pos", "n_neg")


def eval_capped(spark, sf):
    """AUC over the first 20 batches of 256 records."""
    capped = first_rows(clicks(spark, sf), "event_id", 20 * 256)
    scored = capped.select("label", F.coalesce("I3", F.lit(0)).alias("s"))
    return metrics.auc(scored, "s", "label").select(rounded_to("auc", 6), "n_pos", "n_neg")


def eval_capped_later(spark, sf):
    """The same over all but 37 records, so that the cap lies within the last slice of keys."""
    rows = clicks(spark, sf)
    capped = first_rows(rows, "event_id", rows.count() - 37)
    scored = capped.select("label", F.coalesce("I3", F.lit(0)).alias("s"))
    return metrics.auc(scored, "s", "label").select(rounded_to("auc", 6), "n_pos", "n_neg")


def auc_nulls(spark, sf):
    """Rows without a label or a score do not count."""
    label = F.when(F.col("event_id") % 11 != 0, F.col("label"))
    df = clicks(spark, sf).select(label.alias("label"), F.col("I3").alias("s"))
    return metrics.auc(df, "s", "label").select(rounded_to("auc", 6), "n_pos", "n_neg")


STEP = 0.5


def fm_step_query(spark, sf):
    """New weights after one step over the training split, from the fixed ones."""
    df = int_clicks(spark, sf)
    fitted, train = fitted_workflow(df), df.where(TRAIN_DAYS)
    table = embeddings_of(fitted)
    rows = table.lookup(fitted.transform(train, "event_id"))
    weights = [[*(fixed_weight(i, d) for d in range(LATENT)), fixed_linear(i)] for i in range(len(CONTS))]
    stepped = fm_step(rows, CATS, CONTS, table.table, weights, train.count(), STEP)
    return stepped.select("slot", "code", "j", rounded_to("value", 5))


def best_column(spark, sf):
    """Each count as a score of its own: its AUC, where a null counts as 0."""
    df = clicks(spark, sf)
    out = None
    for c in CONTS:
        one = metrics.auc(df.select("label", F.coalesce(c, F.lit(0)).alias("s")), "s", "label")
        one = one.select(F.lit(c).alias("col"), rounded_to("auc", 6))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("place", F.row_number().over(Window.orderBy(F.desc("auc"), "col")))  # a row per column


def embedding_sum_tail(spark, sf):
    """`embedding_sum` where the vocabulary is too large to broadcast."""
    return embedding_sum(spark, sf, TAIL_LIMITS)


def score_table_tail(spark, sf):
    """`score_table` where the embeddings are too large to broadcast."""
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    rows = fitted.transform(df, "event_id")
    scored = score(rows, model_of(fitted, NARROW), ["event_id"], "event_id", TAIL_LIMITS)
    return scored.select("event_id", rounded_to("logit"), rounded_to("score"))


NARROW = (4, 3)
WIDE = 400


def score_table(spark, sf):
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    rows = fitted.transform(df, "event_id")
    scored = score(rows, model_of(fitted, NARROW), ["event_id"], "event_id")
    return scored.select("event_id", rounded_to("logit"), rounded_to("score"))


def score_raw_records(spark, sf):
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    scored = score_raw(df.drop("label"), fitted, model_of(fitted, NARROW), ["event_id"], "event_id")
    return scored.select("event_id", rounded_to("logit"), rounded_to("score"))


def mlp_forward(spark, sf):
    """The full-width tower."""
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    model = model_of(fitted, (WIDE,) * 3)
    scored = score_raw(df, fitted, model, ["event_id"], "event_id")
    return scored.select("event_id", rounded_to("logit", 3), rounded_to("score"))


def model_reload(spark, sf):
    """Scores of a model written to storage and read back."""
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    path = scratch_path(spark, "model")
    model_of(fitted, NARROW).save(path)
    rows = fitted.transform(df, "event_id")
    scored = score(rows, DeepFM.load(spark, path), ["event_id"], "event_id")
    return scored.select("event_id", rounded_to("logit"), rounded_to("score"))


def request_batch(df):
    """The view as requests of up to eight records."""
    return requests.to_requests(
        df, F.expr("event_id div 8"), "event_id", requests.request_features()
    )


def decode_requests(spark, sf):
    return requests.decode(request_batch(int_clicks(spark, sf)))[0].drop("request")


def rejected_requests(spark, sf):
    """The same requests, in each of which one input is a record short."""
    shortened = request_batch(int_clicks(spark, sf)).withColumn(
        "inputs",
        F.transform(
            "inputs",
            lambda x: F.when(
                x["name"] == "I7",
                x.withField("data", F.slice(x["data"], 1, F.size(x["data"]) - 1)),
            ).otherwise(x),
        ),
    )
    return requests.decode(shortened)[1].select("id", "reason")


# Why the k-th kind of damaged request is rejected, in the order of `damaged`.
REASONS = [
    "no inputs", "malformed input", "duplicate input", "missing feature", "row counts differ",
    "no records", "shape does not match data", "value out of range",
]


def rejected_all_reasons(spark, sf):
    """Eight of nine requests are damaged, each in one of eight ways."""
    kind, inputs = F.col("id").cast("bigint") % (len(REASONS) + 1), F.col("inputs")

    def each(change):
        return F.transform(inputs, lambda x: F.when(x["name"] == "I7", change(x)).otherwise(x))

    damaged = [
        F.slice(inputs, 1, 0),
        each(lambda x: x.withField("data", F.lit(None).cast("array<bigint>"))),
        F.concat(inputs, F.slice(inputs, 1, 1)),
        F.filter(inputs, lambda x: x["name"] != "I7"),
        each(lambda x: x.withField("data", F.slice(x["data"], 2, F.size(x["data"])))),
        F.transform(inputs, lambda x: x.withField("data", F.slice(x["data"], 1, 0))),
        each(lambda x: x.withField("shape", F.array(F.lit(-1), F.lit(1)))),
        each(lambda x: x.withField("data", F.transform(x["data"], lambda v: F.lit(3_000_000_000)))),
    ]
    changed = inputs
    for k, damage in enumerate(damaged):
        changed = F.when(kind == k, damage).otherwise(changed)
    return requests.decode(request_batch(int_clicks(spark, sf)).withColumn("inputs", changed))[1].select("id", "reason")


def _unreadable(spark, df) -> str:
    """Request files in which three of four documents do not parse: cut short, no JSON, of another shape."""
    good = F.to_json(F.struct("id", "inputs"))
    kind = F.col("id").cast("bigint") % 4
    text = (
        F.when(kind == 1, F.concat(F.lit('{"id": "'), "id", F.lit('", "inputs": [')))
        .when(kind == 2, F.concat(F.lit("plain words "), "id"))
        .when(kind == 3, F.concat(F.lit('{"id": "'), "id", F.lit('", "inputs": 5}')))
        .otherwise(good)
    )
    path = scratch_path(spark, "request-files")
    request_batch(df).select(text.alias("value")).write.text(path)
    return path


def rejected_text(spark, sf):
    return requests.decode(scan_requests(spark, _unreadable(spark, int_clicks(spark, sf))))[1].select("reason", "text")


def rejected_text_stream(spark, sf):
    """The same documents read as a stream: the rejects of every micro-batch."""
    df = int_clicks(spark, sf)
    fitted, root = fitted_workflow(df), scratch_path(spark, "stream")
    query = requests.score_stream(
        spark, _unreadable(spark, df), f"{root}/out", f"{root}/state", fitted, model_of(fitted, NARROW)
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out/rejected").select("reason", "text")


def encode_scores(spark, sf):
    rows = requests.decode(request_batch(int_clicks(spark, sf)))[0]
    out = requests.encode(rows.withColumn("s", F.coalesce("I1", F.lit(0))), "s")
    return out.select("id", F.array_join(F.col("OUTPUT0").cast("array<string>"), ",").alias("OUTPUT0"))


def _response_rows(responses):
    return responses.select("id", F.posexplode("OUTPUT0").alias("pos", "score")).select(
        "id", "pos", rounded_to("score")
    )


def score_requests(spark, sf):
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    responses, _ = requests.score_requests(request_batch(df), fitted, model_of(fitted, NARROW))
    return _response_rows(responses)


def score_stream(spark, sf):
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    root = scratch_path(spark, "stream")
    request_batch(df).write.json(f"{root}/in")
    query = requests.score_stream(
        spark, f"{root}/in", f"{root}/out", f"{root}/state", fitted, model_of(fitted, NARROW)
    )
    query.awaitTermination()
    return _response_rows(spark.read.parquet(f"{root}/out/responses").drop("batch"))


def sparse_query(spark, sf):
    """Records as sparse vectors: the size, the places of the slots' codes and of the counts, the values."""
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    rows = fitted.transform(df, "event_id")
    vector = sparse_features(CATS, CONTS, fitted.cardinalities())
    rounded_ = F.transform("v.values", lambda x: (F.round(x, 4) + 0.0).cast("decimal(12,4)").cast("string"))
    return rows.select("event_id", vector.alias("v")).select(
        "event_id", F.col("v.size").alias("size"), F.array_join(F.col("v.indices").cast("array<string>"), ",").alias("indices"),
        F.array_join(rounded_, ",").alias("vals"),
    )


def train_fm_query(spark, sf):
    """Validation scores of a factorization machine over all slots and counts, learned from the log's label."""
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    vector = sparse_features(CATS, CONTS, fitted.cardinalities())
    train, valid = (fitted.transform(df.where(days), "event_id") for days in (TRAIN_DAYS, VALID_DAYS))
    model = train_fm(train.select("label", vector.alias(FEATURES)))
    return score_fm(with_vectors(valid, vector, ["event_id", "label"]), model, ["event_id", "label"])


SNAPSHOTS = {"first": 1.0, "half": 0.5, "double": 2.0}  # every weight of the fixed model times this


def snapshot_auc(spark, sf):
    """Three saved models, read back and scored in one scan; the AUC of each."""
    df = int_clicks(spark, sf)
    fitted, root = fitted_workflow(df), scratch_path(spark, "snapshots")
    plain, models = model_of(fitted, ()), {}
    for name, factor in SNAPSHOTS.items():
        table = plain.embeddings.table.withColumn("vec", F.transform("vec", lambda x: x * F.lit(factor)))  # noqa: B023
        DeepFM(Embeddings.of(table, CATS), {k: v * factor for k, v in plain.params.items()}, CONTS).save(f"{root}/{name}")
        models[name] = DeepFM.load(spark, f"{root}/{name}")
    rows = fitted.transform(df, "event_id")
    scored = score_models(rows, models, ["event_id", "label"], "event_id")
    ranked = metrics.auc_by(scored.withColumn("s", F.round("logit", 6)), ["model"], "s", "label")
    return ranked.select("model", rounded_to("auc", 6), "n_pos", "n_neg")


def auc_by_day(spark, sf):
    """Of a count with many ties, for each day, one of them without a label, and for rows without a day."""
    day = F.when(F.col("day") != 5, F.col("day"))
    label = F.when(F.col("day") != 9, F.col("label"))
    df = clicks(spark, sf).select(day.alias("day"), label.alias("label"), F.col("I3").alias("s"))
    return metrics.auc_by(df, ["day"], "s", "label").select("day", rounded_to("auc", 6), "n_pos", "n_neg")


def _package_scores(spark, sf, raw):
    out = scratch_path(spark, "package")
    prepared = prepare_tables(spark, sf, out)
    model_of(prepared.fitted, NARROW).save(f"{out}/model")
    fitted, model = load_package(spark, out)
    return score_raw(raw, fitted, model, ["event_id"], "event_id")


def package_score(spark, sf):
    """From tables to scores: the table job, a model saved beside its workflow, both read back."""
    scored = _package_scores(spark, sf, clicks(spark, sf).drop("label"))
    return scored.select("event_id", rounded_to("logit"), rounded_to("score"))


def package_evaluate(spark, sf):
    """The same on the days after training, against their labels."""
    valid = clicks(spark, sf).where(VALID_DAYS)
    scored = _package_scores(spark, sf, valid.drop("label")).join(valid.select("event_id", "label"), "event_id")
    return metrics.auc(scored.withColumn("s", F.round("logit", 4)), "s", "label").select(rounded_to("auc", 6), "n_pos", "n_neg")


QUERIES = {
    "embedding_sum": embedding_sum,
    "embedding_sum_tail": embedding_sum_tail,
    "score_table_tail": score_table_tail,
    "eval_capped_later": eval_capped_later,
    "best_column": best_column,
    "fm_order2": fm_order2_query,
    "linear_term": linear_query,
    "fm_logit": fm_logit,
    "log_loss": log_loss,
    "auc": auc,
    "auc_model": auc_model,
    "eval_capped": eval_capped,
    "score_table": score_table,
    "score_raw": score_raw_records,
    "model_reload": model_reload,
    "mlp_forward": mlp_forward,
    "decode_requests": decode_requests,
    "rejected_requests": rejected_requests,
    "encode_scores": encode_scores,
    "score_requests": score_requests,
    "score_stream": score_stream,
    "train_fm": train_fm_query,
    "sparse_features": sparse_query,
    "snapshot_auc": snapshot_auc,
    "auc_by_day": auc_by_day,
    "auc_nulls": auc_nulls,
    "fm_step": fm_step_query,
    "rejected_all_reasons": rejected_all_reasons,
    "rejected_text": rejected_text,
    "rejected_text_stream": rejected_text_stream,
    "package_score": package_score,
    "package_evaluate": package_evaluate,
}


def _weight(row: str, column: str) -> str:
    return f"((({row})*13 + ({column})*7) % 21 - 10)/100.0::DOUBLE"


@cache
def _feature_ctes() -> tuple[str, ...]:
    """`latents` (event, feature, dimension, value) and `fmparts` (event, fm, linear)."""
    keys = ", ".join(f"{{'f': {s}, 'code': {c}}}" for s, c in enumerate(CATS))
    values = ", ".join(f"{{'f': {i}, 'x': CAST({c} AS DOUBLE)}}" for i, c in enumerate(CONTS))
    return (
        *transformed_ctes(),
        f"keyed AS (SELECT event_id, unnest([{keys}]) AS k FROM done)",
        f"valued AS (SELECT event_id, unnest([{values}]) AS k FROM done)",
        "dims AS (SELECT CAST(unnest(range(10)) AS BIGINT) AS d)",
        "latents AS (SELECT event_id, k.f AS f, d, "
        "CAST((k.f*31 + k.code*17 + d*7) % 101 - 50 AS DOUBLE)/100 AS v FROM keyed, dims UNION ALL "
        f"SELECT event_id, 26 + k.f, d, k.x * {_weight('k.f', 'd')} FROM valued, dims)",
        "fm AS (SELECT event_id, 0.5 * sum(s*s - q) AS fm FROM (SELECT event_id, d, sum(v) AS s, "
        "sum(v*v) AS q FROM latents GROUP BY event_id, d) GROUP BY event_id)",
        "linear AS (SELECT event_id, sum(w) AS linear FROM (SELECT event_id, "
        "CAST((k.f*31 + k.code*17 + 70) % 101 - 50 AS DOUBLE)/100 AS w FROM keyed UNION ALL "
        "SELECT event_id, k.x * ((k.f*5) % 11 - 5)/100.0::DOUBLE FROM valued) GROUP BY event_id)",
        "logits AS (SELECT event_id, label, fm + linear AS logit FROM done JOIN fm USING (event_id) "
        "JOIN linear USING (event_id))",
    )


def _tower_ctes() -> tuple[str, ...]:
    """The narrow tower over `latents`, and the full logit."""
    one, two = NARROW
    return (
        *_feature_ctes(),
        f"u1 AS (SELECT CAST(unnest(range({one})) AS BIGINT) AS u)",
        f"u2 AS (SELECT CAST(unnest(range({two})) AS BIGINT) AS u)",
        f"h1 AS (SELECT event_id, u, greatest(sum(v * {_weight('f*10 + d', 'u')}) + 0.01::DOUBLE*(u + 1), 0) "
        "AS h FROM latents, u1 GROUP BY event_id, u)",
        f"h2 AS (SELECT event_id, u2.u, greatest(sum(h * {_weight('h1.u', 'u2.u')}) "
        "+ 0.01::DOUBLE*(u2.u + 1), 0) AS h FROM h1, u2 GROUP BY event_id, u2.u)",
        f"tower AS (SELECT event_id, sum(h * {_weight('u', '0')}) + 0.01::DOUBLE AS deep FROM h2 "
        "GROUP BY event_id)",
        "scores AS (SELECT event_id, label, logit + deep AS logit, "
        "1/(1 + exp(-(logit + deep))) AS score FROM logits JOIN tower USING (event_id))",
    )


def _wide_ctes() -> tuple[str, ...]:
    """The tower of three wide layers over `latents`, and the full logit.

    A weight depends on its column modulo 3 only, because 7 * 3 is 21: three sums per layer
    and record, `p0` to `p2`, give all units but for their biases.
    """
    out = [*_feature_ctes(), f"units AS (SELECT CAST(unnest(range({WIDE})) AS BIGINT) AS u)"]
    source, value, row = "latents", "v", "f*10 + d"
    for layer in (1, 2, 3):
        sums = ", ".join(f"sum({value} * {_weight(row, str(c))}) AS p{c}" for c in range(3))
        out.append(f"p{layer} AS (SELECT event_id, {sums} FROM {source} GROUP BY event_id)")
        out.append(
            f"w{layer} AS (SELECT event_id, u, greatest(CASE u % 3 WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END "
            f"+ 0.01::DOUBLE*(u + 1), 0) AS h FROM p{layer}, units)"
        )
        source, value, row = f"w{layer}", "h", "u"
    out.append(
        f"tower AS (SELECT event_id, sum(h * {_weight('u', '0')}) + 0.01::DOUBLE AS deep FROM w3 GROUP BY event_id)"
    )
    return (*out, "scores AS (SELECT event_id, logit + deep AS logit FROM logits JOIN tower USING (event_id))")


def _step_sql() -> str:
    key = "CAST((slot*31 + code*17 + {} * 7) % 101 - 50 AS DOUBLE)/100"
    old = f"CASE WHEN slot < 26 THEN {key.format('d')} ELSE {_weight('(slot - 26)', 'd')} END"
    old_linear = f"CASE WHEN slot < 26 THEN {key.format('10')} ELSE (((slot - 26)*5) % 11 - 5)/100.0::DOUBLE END"
    return with_clicks(
        f"SELECT CAST(slot AS INTEGER) AS slot, CAST(code AS BIGINT) AS code, CAST(d AS INTEGER) AS j, "
        f"round(w - {STEP}::DOUBLE*(a - w*b), 5) + 0.0 AS value FROM "
        f"(SELECT slot, code, d, {old} AS w, sum(g*x*s) AS a, sum(g*x*x) AS b "
        "FROM pulled JOIN sums USING (event_id) GROUP BY slot, code, d) UNION ALL "
        f"SELECT CAST(slot AS INTEGER), CAST(code AS BIGINT), 10, round({old_linear} - {STEP}::DOUBLE*sum(g*x), 5) + 0.0 "
        "FROM pulled GROUP BY slot, code",
        True,
        *_feature_ctes(),
        "errors AS (SELECT event_id, (1/(1 + exp(-logit)) - logits.label)/(SELECT count(*) FROM train) AS g "
        f"FROM logits JOIN done USING (event_id) WHERE done.{TRAIN_DAYS})",
        "sums AS (SELECT event_id, d, sum(v) AS s FROM latents GROUP BY event_id, d)",
        "pulled AS (SELECT event_id, g, k.f AS slot, k.code AS code, 1.0::DOUBLE AS x FROM keyed JOIN errors USING "
        "(event_id) UNION ALL SELECT event_id, g, 26 + k.f, 0, k.x FROM valued JOIN errors USING (event_id))",
    )


def _auc_sql(source: str, group: str = "") -> str:
    by, part = (f"{group}, ", f"PARTITION BY {group} ") if group else ("", "")
    return (
        f"WITH s AS ({source}), r AS (SELECT {by}label, rank() OVER ({part}ORDER BY s) + (count(*) OVER "
        f"(PARTITION BY {by}s) - 1)/2.0::DOUBLE AS mid FROM s), t AS (SELECT {by}CAST(sum(label) AS DOUBLE) AS p, "
        f"CAST(count(*) - sum(label) AS DOUBLE) AS n, sum(CASE WHEN label = 1 THEN mid END) AS w FROM r{f' GROUP BY {group}' if group else ''}) "
        f"SELECT {by}round((w - p*(p + 1)/2)/(p*n), 6) AS auc, CAST(p AS BIGINT) AS n_pos, "
        "CAST(n AS BIGINT) AS n_neg FROM t"
    )



_SCORES = with_clicks(
    f"SELECT event_id, {rounded('logit')} AS logit, {rounded('score')} AS score FROM scores",
    True,
    *_tower_ctes(),
)
# Tables hold the categoricals as text, whose order breaks ties.
_PACKAGE_SCORES = with_clicks(
    f"SELECT event_id, {rounded('logit')} AS logit, {rounded('score')} AS score FROM scores",
    False,
    *_tower_ctes(),
)
_POSITION = "CAST(row_number() OVER (PARTITION BY event_id // 8 ORDER BY event_id) - 1 AS INTEGER) AS pos"
_RESPONSES = with_clicks(
    f"SELECT CAST(event_id // 8 AS VARCHAR) AS id, {_POSITION}, {rounded('score')} AS score FROM scores",
    True,
    *_tower_ctes(),
)

_BEST = " UNION ALL ".join(
    f"SELECT '{c}' AS col, auc FROM ({_auc_sql(f'SELECT label, coalesce({c}, 0) AS s FROM ({clicks_sql()})')})"
    for c in CONTS
)

_UNREADABLE = (
    "SELECT 'unreadable' AS reason, CASE r % 4 WHEN 1 THEN '{\"id\": \"' || r || '\", \"inputs\": [' WHEN 2 THEN 'plain words ' || r "
    "ELSE '{\"id\": \"' || r || '\", \"inputs\": 5}' END AS text FROM (SELECT DISTINCT event_id // 8 AS r FROM events) WHERE r % 4 <> 0"
)

SQL = {
    "best_column": "SELECT col, auc, CAST(row_number() OVER (ORDER BY auc DESC, col) AS INTEGER) AS place "
    f"FROM ({_BEST})",
    "eval_capped_later": _auc_sql(
        f"SELECT label, coalesce(I3, 0) AS s FROM ({clicks_sql()}) "
        "QUALIFY row_number() OVER (ORDER BY event_id) <= count(*) OVER () - 37"
    ),
    "score_table_tail": _SCORES,
    "package_score": _PACKAGE_SCORES,
    "mlp_forward": with_clicks(
        "SELECT event_id, round(logit, 3) + 0.0 AS logit, "
        f"{rounded('CASE WHEN logit < -700 THEN 0 ELSE 1/(1 + exp(-logit)) END')} AS score FROM scores",
        True,
        *_wide_ctes(),
    ),
    "fm_step": _step_sql(),
    "package_evaluate": _auc_sql(f"SELECT label, logit AS s FROM ({_PACKAGE_SCORES}) JOIN ({clicks_sql()}) USING (event_id) WHERE {VALID_DAYS}"),
    "auc_by_day": _auc_sql(
        f"SELECT CASE WHEN day <> 5 THEN day END AS day, label, I3 AS s FROM ({clicks_sql()}) WHERE I3 IS NOT NULL AND day <> 9", "day"
    ),
    "snapshot_auc": _auc_sql(
        with_clicks(
            "SELECT m.model, label, round(m.f*m.f*fm + m.f*linear, 6) AS s FROM done JOIN fm USING (event_id) JOIN linear USING (event_id), "
            f"(VALUES {', '.join(f"('{name}', {factor}::DOUBLE)" for name, factor in SNAPSHOTS.items())}) m(model, f)",
            True,
            *_feature_ctes(),
        ),
        "model",
    ),
    "sparse_features": with_clicks(
        f"SELECT event_id, CAST((SELECT sum(size) FROM sizes) + {len(CONTS)} AS INTEGER) AS size, "
        + " || ',' || ".join(f"({c} + coalesce((SELECT sum(size) FROM sizes WHERE slot < {s}), 0))" for s, c in enumerate(CATS))
        + "".join(f" || ',' || ((SELECT sum(size) FROM sizes) + {i})" for i in range(len(CONTS)))
        + f" AS indices, '{','.join(['1.0000'] * len(CATS))}'"
        + "".join(f" || ',' || CAST(CAST({rounded(c)} AS DECIMAL(12,4)) AS VARCHAR)" for c in CONTS)
        + " AS vals FROM done",
        True,
        *transformed_ctes(),
        "sizes AS (" + " UNION ALL ".join(f"SELECT {s} AS slot, count(*) + 1 AS size FROM vocab WHERE col = '{c}'" for s, c in enumerate(CATS)) + ")",
    ),
    "auc_nulls": _auc_sql(f"SELECT label, I3 AS s FROM ({clicks_sql()}) WHERE I3 IS NOT NULL AND event_id % 11 <> 0"),
    "rejected_all_reasons": "SELECT CAST(r AS VARCHAR) AS id, CASE r % 9 "
    + " ".join(f"WHEN {k} THEN '{reason}'" for k, reason in enumerate(REASONS))
    + " END AS reason FROM (SELECT DISTINCT event_id // 8 AS r FROM events) WHERE r % 9 <> 8",
    "rejected_text": _UNREADABLE,
    "rejected_text_stream": _UNREADABLE,
    "embedding_sum": with_clicks(
        "SELECT c.event_id, "
        + ", ".join(f"round(coalesce(l.v{j}, 0.0::DOUBLE), 4) + 0.0 AS v{j}" for j in range(VECTOR))
        + " FROM clicks c LEFT JOIN (SELECT event_id, "
        + ", ".join(f"sum(CAST((code*17 + {7 * j}) % 101 - 50 AS DOUBLE)/100) AS v{j}" for j in range(VECTOR))
        + " FROM coded GROUP BY event_id) l USING (event_id)",
        True,
        *LIST_CTES,
    ),
    "fm_order2": with_clicks(
        f"SELECT event_id, {rounded('fm')} AS fm FROM fm", True, *_feature_ctes()
    ),
    "linear_term": with_clicks(
        f"SELECT event_id, {rounded('linear')} AS linear FROM linear", True, *_feature_ctes()
    ),
    "fm_logit": with_clicks(
        f"SELECT event_id, label, {rounded('logit')} AS logit FROM logits", True, *_feature_ctes()
    ),
    "log_loss": with_clicks(
        "SELECT round(avg(ln(1 + exp(-abs(logit))) + greatest(logit, 0) - logit*label), 6) "
        "AS log_loss FROM logits",
        True,
        *_feature_ctes(),
    ),
    "auc": _auc_sql(f"SELECT label, coalesce(I3, 0) AS s FROM ({clicks_sql()})"),
    "auc_model": _auc_sql(
        with_clicks("SELECT label, round(logit, 6) AS s FROM logits", True, *_feature_ctes())
    ),
    "eval_capped": _auc_sql(
        f"SELECT label, coalesce(I3, 0) AS s FROM ({clicks_sql()}) ORDER BY event_id LIMIT 5120"
    ),
    "score_table": _SCORES,
    "score_raw": _SCORES,
    "model_reload": _SCORES,
    "decode_requests": with_clicks(
        f"SELECT CAST(event_id // 8 AS VARCHAR) AS id, {_POSITION}, {', '.join(CONTS + CATS)} FROM clicks"
    ),
    "rejected_requests": "SELECT DISTINCT CAST(event_id // 8 AS VARCHAR) AS id, "
    "'row counts differ' AS reason FROM events",
    "encode_scores": with_clicks(
        "SELECT CAST(event_id // 8 AS VARCHAR) AS id, string_agg(CAST(coalesce(I1, 0) AS VARCHAR), "
        "',' ORDER BY event_id) AS OUTPUT0 FROM clicks GROUP BY 1",
        False,
    ),
    "score_requests": _RESPONSES,
    "score_stream": _RESPONSES,
}
SQL["embedding_sum_tail"] = SQL["embedding_sum"]
