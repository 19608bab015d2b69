"""Shared-folder tables: where a job writes what must outlive an executor."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[str, str]] = []  # application and path of every copy not yet deleted


def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; in local mode without one, the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/clickloom-{label}-{uuid.uuid4().hex}"
    _made.append((spark.sparkContext.applicationId, path))
    return path


def release(spark: SparkSession) -> None:
    """Delete the copies that this application has made.

    Results that read them cannot be used afterwards, so the caller decides when; at the end
    of the driver program it happens by itself.
    """
    own = spark.sparkContext.applicationId
    for made in [m for m in _made if m[0] == own]:
        delete(spark, made[1])
        _made.remove(made)


@atexit.register
def _release_at_exit() -> None:
    session = SparkSession.getActiveSession() if SparkContext._active_spark_context else None
    if session is not None:
        release(session)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Inside, generated code too long for the JVM to compile is run operator by operator.

    Dozens of long expressions in one projection pass the 8000 bytes above which the JVM interprets
    a method. Operators on their own cut their expressions into short methods. A long chain of joins
    would copy its wide row at each of them, so this is for writing projections.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Inside, Python workers get whole texts by `rows` at most, not by the session's ten thousand."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The copy has no lineage, survives lost executors and carries its true size, so that
    the optimizer's own broadcast threshold works on measured bytes.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _handle(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, pattern: str) -> bool:
    """True when a path, or any match of a glob, exists."""
    fs, jpath = _handle(spark, pattern)
    return len(fs.globStatus(jpath) or []) > 0


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_lines(spark, path, [text])


def write_lines(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """Write pieces of text one after the other, without holding them all."""
    fs, jpath = _handle(spark, path)
    stream = fs.create(jpath, True)
    try:
        for line in lines:
            stream.write(bytearray(line.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small side file, such as a spec or a file list."""
    fs, jpath = _handle(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _handle(spark, path)
    fs.delete(jpath, True)
