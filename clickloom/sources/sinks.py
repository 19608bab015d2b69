"""Writing splits: sharded Parquet with a manifest and a schema side table, and tables."""

from __future__ import annotations

import json
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.shuffle import shuffle_rows
from clickloom.schema import role_of
from clickloom.sources.scans import FILE_LIST_NAME, MANIFEST_NAME, SIDECAR_NAME, read_manifest
from clickloom.storage import write_lines, write_text


def split_path(root: str, split: str) -> str:
    """The one rule for where a split lives."""
    return f"{root.rstrip('/')}/{split}"


def write_split(
    df: DataFrame,
    root: str,
    split: str,
    files: int | None = None,
    shuffle: str | None = None,
    seed: int = 0,
    key: str | None = None,
) -> str:
    """Write one split as Parquet, optionally shuffled and in a fixed number of files."""
    path = split_path(root, split)
    shuffle_rows(df, shuffle, seed, files, key=key).write.mode("overwrite").parquet(path)
    return path


def manifest(spark: SparkSession, directory: str) -> DataFrame:
    """`(file, num_rows)`; only file metadata is read, no data column."""
    return (
        spark.read.parquet(directory)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("num_rows"))
    )


def write_manifest(spark: SparkSession, directory: str) -> None:
    """List the shards and their rows in a table beside them, and their paths in a text file.

    The text file is a count line and then one path per line; it is written as the paths arrive.
    """
    directory = directory.rstrip("/")
    manifest(spark, directory).write.mode("overwrite").parquet(f"{directory}/{MANIFEST_NAME}")
    listed = read_manifest(spark, directory).select("file").orderBy("file")
    lines = (f"{r['file']}\n" for r in listed.toLocalIterator())
    write_lines(spark, f"{directory}/{FILE_LIST_NAME}", chain([f"{listed.count()}\n"], lines))


def sidecar_rows(df: DataFrame, cardinalities: dict[str, int]) -> list[dict]:
    rows = []
    for field in df.schema:
        role = role_of(field.name)
        rows.append(
            {
                "name": field.name,
                "dtype": field.dataType.simpleString(),
                "tags": [role] if role else [],
                "cardinality": cardinalities.get(field.name),
            }
        )
    return rows


def write_sidecar(df: DataFrame, directory: str, cardinalities: dict[str, int]) -> None:
    """One JSON line per column, beside the shards."""
    text = "\n".join(json.dumps(r) for r in sidecar_rows(df, cardinalities)) + "\n"
    write_text(df.sparkSession, f"{directory.rstrip('/')}/{SIDECAR_NAME}/columns.json", text)


def load_table(df: DataFrame, name: str) -> None:
    """Load a frame into a managed table, replacing what was there."""
    df.write.mode("overwrite").saveAsTable(name)


def export_table(spark: SparkSession, name: str, directory: str) -> None:
    """Write a table as Parquet shards."""
    spark.table(name).write.mode("overwrite").parquet(directory)
