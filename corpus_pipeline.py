"""From raw documents to a mixed training set, stage by stage.

Each stage takes what its predecessor kept. All but the last return documents with all their
columns; the last returns how many words the mix takes of each. Null and empty texts pass toxicity
and the near-copy stage, lose nothing to the line stage unless all their lines go, and take no words. Rows of
one key and one text are one document in the line stage, and one of them stays in the near-copy
stage; ties there go to the smallest key. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import decontaminate, line_dedup, mixing, near_dedup, toxicity
from clickloom.llm.text import documents
from clickloom.storage import materialize

#: No SQL: the first stage rejects by a trained machine.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents among `docs` and drop what scores 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.learn(docs, labels, "doc_id", "text", "toxic", toxicity.LEARN_ROWS)
    return toxicity.drop_toxic(docs, machine)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated and nearly repeated lines, and documents of which nothing is left."""
    return line_dedup.drop_lines(docs, length="n_chars" if "n_chars" in docs.columns else None)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, linked as in `op3`: two-word shingles at 0.8.

    A changed word breaks two of them and five of the five-word ones, so with those a copy with a
    change in twenty words is no copy any more.
    """
    return near_dedup.one_of_each(docs, shingle=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of each remaining document."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
