"""Scoring requests: column-wise JSON to rows and back, in batch or as a stream of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.scalar import to_int32
from clickloom.model.deepfm import DeepFM, RawScorer
from clickloom.schema import categorical_columns, continuous_columns
from clickloom.sources.scans import REQUEST_TEXT, scan_requests
from clickloom.storage import delete, scratch_path


def request_features() -> list[str]:
    return continuous_columns() + categorical_columns()


def _names() -> Column:
    return F.transform("inputs", lambda x: x["name"])


def rejection(features: Sequence[str]) -> Column:
    """Why a request cannot be decoded; null for a good one."""
    needed = F.array(*[F.lit(f) for f in features])
    rows = F.transform("inputs", lambda x: F.size(x["data"]))
    return (
        F.when(F.coalesce(F.size("inputs"), F.lit(0)) <= 0, "no inputs")
        .when(F.exists("inputs", lambda x: x["name"].isNull() | x["data"].isNull()), "malformed input")
        .when(F.size(F.array_distinct(_names())) < F.size("inputs"), "duplicate input")
        .when(F.size(F.array_except(needed, _names())) > 0, "missing feature")
        .when(F.size(F.array_distinct(rows)) > 1, "row counts differ")
        .when(F.element_at(rows, 1) == 0, "no records")
        .when(
            F.exists("inputs", lambda x: ~F.get(x["shape"], F.lit(0)).eqNullSafe(F.size(x["data"]))),
            "shape does not match data",
        )
        .when(
            F.exists("inputs", lambda x: F.exists(x["data"], lambda v: v.isNotNull() & to_int32(v).isNull())),
            "value out of range",
        )
    )


def decode(
    requests: DataFrame, features: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """`(rows, rejected)`: one row `(request, id, pos, features..)` per record; rejects `(id, reason, text)`.

    `request` numbers the documents read: clients may send the same id again and again. A document
    that did not parse as a whole (`text` of the scan) is unreadable, whatever was read of it, and is
    kept as text; the other rejects have null there.
    """
    features = list(features or request_features())
    text = F.col(REQUEST_TEXT) if REQUEST_TEXT in requests.columns else F.lit(None).cast("string")
    why = F.when(text.isNotNull(), "unreadable").otherwise(rejection(features))
    checked = requests.select(
        "id", "inputs", text.alias("text"), why.alias("reason"), F.monotonically_increasing_id().alias("request")
    )
    rejected = checked.where(F.col("reason").isNotNull()).select("id", "reason", "text")
    names = checked.where(F.col("reason").isNull()).withColumn("_names", _names())
    arrays = names.select(
        "request",
        "id",
        *[
            F.get("inputs", F.array_position("_names", F.lit(f)).cast("int") - 1)["data"].alias(f)
            for f in features
        ],
    )
    record = F.posexplode(F.arrays_zip(*features)).alias("pos", "_record")
    zipped = arrays.select("request", "id", record)
    values = [to_int32(F.col("_record")[f]).alias(f) for f in features]
    return zipped.select("request", "id", "pos", *values), rejected


def encode(scores: DataFrame, score: str = "score") -> DataFrame:
    """`(id, OUTPUT0)`: the scores of each request in record order, one response per request."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("pos"), F.col(score).alias("s"))))
    output = F.transform(ordered, lambda x: x["s"]).alias("OUTPUT0")
    return scores.groupBy("request", "id").agg(output).drop("request")


def to_requests(df: DataFrame, request_id: Column, order: str, features: Sequence[str]) -> DataFrame:
    """Records gathered into column-wise requests, `order` giving the record order."""
    records = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_order"), *features)))

    def one(f: str) -> Column:
        data = F.transform("_records", lambda x: x[f].cast("bigint"))
        return F.struct(
            F.lit(f).alias("name"),
            F.array(F.size("_records"), F.lit(1)).alias("shape"),
            F.lit("INT32").alias("datatype"),
            data.alias("data"),
        )

    return (
        df.groupBy(request_id.cast("string").alias("id"))
        .agg(records.alias("_records"))
        .select("id", F.array(*[one(f) for f in features]).alias("inputs"))
    )


def score_requests(requests: DataFrame, fitted, model: DeepFM) -> tuple[DataFrame, DataFrame]:
    """`(responses, rejected)` of a batch of requests."""
    return _answers(requests, RawScorer.of(fitted, model))


def _answers(requests: DataFrame, scorer: RawScorer) -> tuple[DataFrame, DataFrame]:
    rows, rejected = decode(requests)
    return encode(scorer.score(rows, ["request", "id", "pos"])), rejected


def score_stream(
    spark: SparkSession, source: str, out: str, checkpoint: str, fitted, model: DeepFM
) -> StreamingQuery:
    """Score request files as they arrive, until none is left.

    A micro-batch belongs to the stream's own session. It is written to the shared folder
    first, which parses the requests once for both outputs and lets the rest run in the
    session of the vocabulary and the model, through the same code as a batch. Every
    micro-batch replaces its own output folder, so one that is run again leaves one copy.
    """

    scorer = RawScorer.of(fitted, model)

    def run(batch: DataFrame, number: int) -> None:
        path = scratch_path(spark, "requests")
        batch.write.parquet(path)
        requests = spark.read.schema(batch.schema).parquet(path)
        responses, rejected = _answers(requests, scorer)
        responses.write.mode("overwrite").parquet(f"{out}/responses/batch={number}")
        rejected.write.mode("overwrite").parquet(f"{out}/rejected/batch={number}")
        delete(spark, path)

    return (
        scan_requests(spark, source, stream=True)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
