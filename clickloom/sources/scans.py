"""Reading click logs: delimited files, Parquet, ORC, tables, manifests, side tables."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickloom.functions.scalar import hex_to_int32
from clickloom.operators.ordering import running_total
from clickloom.schema import ROW_KEY, categorical_columns, raw_schema
from clickloom.storage import exists

MANIFEST_NAME = "_manifest"
FILE_LIST_NAME = "_file_list.txt"
SIDECAR_NAME = "_schema"


def present_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist, in order; each missing one is reported and left out."""
    found = []
    for path in paths:
        if exists(spark, path):
            found.append(path)
        else:
            warnings.warn(f"no such path, skipped: {path}", stacklevel=3)
    if not found:
        raise FileNotFoundError(f"none of the given paths exists: {list(paths)}")
    return found


def scan_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = "\t",
    recursive: bool = False,
    schema: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """Headerless delimited files or directories under one fixed schema.

    Empty and malformed fields are null, surplus fields are dropped and missing ones null, all
    without a word: `scan_checked` tells the good lines from the others. With `infer` and no
    schema the types come from the data, which costs a pass over the files; a given schema wins.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("sep", sep).option("header", False)
    if sep == "\t":
        reader = reader.option("quote", "")  # tab-separated logs do not quote: a stray one is data
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is None and infer:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema or raw_schema())
    return reader.csv(present_paths(spark, paths))


def _number(field: Column, kind: T.DataType) -> Column:
    """The field as a number, null where it is none of that size. Blanks around it are not skipped."""
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.when(field.rlike(r"^[+-]?[0-9]+$" if whole else r"^\S+$"), field.try_cast(kind))


def _fields(line: Column, n: int, sep: str) -> tuple[Column, Column]:
    """The fields of a line as text, and how many it has. Only tab-separated lines do not quote."""
    if sep == "\t":
        fields = F.split(line, "\t", -1)
        return fields, F.size(fields)
    names = [f"f{i}" for i in range(n)]
    parsed = F.from_csv(line, ", ".join(f"{x} string" for x in names), {"sep": sep})
    bare = F.regexp_replace(line, '"[^"]*"', "")  # a separator in quotes parts nothing
    return F.array(*[parsed[x] for x in names]), F.size(F.split(bare, re.escape(sep), -1))


def scan_checked(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = "\t",
    recursive: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Lines of headerless delimited files with their fields, and why a line cannot be used.

    Columns: those of the schema, `_file`, `_line` and `_reason`. The reason is null for a good
    line, else, in this order: `stray quote` (an odd number of them), `surplus fields`, `missing
    fields`, or `not a number: <columns>`. Fields of a rejected line are null. Empty fields are null
    and no fault; lines without a character are skipped. It is one pass over the files, as text.
    """
    schema = schema or raw_schema()
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("recursiveFileLookup", True) if recursive else spark.read
    lines = reader.text(present_paths(spark, paths)).where("value != ''")
    n = len(schema)
    values, count = _fields(F.col("value"), n, sep)
    fields = lines.select(
        F.col("_metadata.file_path").alias("_file"), F.col("value").alias("_line"), values.alias("_fields"), count.alias("_count")
    )
    texts, wrong = {}, []
    for i, field in enumerate(schema):
        text = F.nullif(F.get("_fields", F.lit(i)), F.lit(""))
        if not isinstance(field.dataType, T.StringType):
            number = _number(text, field.dataType)
            wrong.append(F.when(text.isNotNull() & number.isNull(), F.lit(field.name)))
            text = number
        texts[field.name] = text
    bad = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    quotes = F.length("_line") - F.length(F.replace("_line", F.lit('"'), F.lit("")))
    reason = (
        F.when(quotes % 2 == 1, "stray quote")
        .when(F.col("_count") > n, "surplus fields")
        .when(F.col("_count") < n, "missing fields")
        .when(F.size(bad) > 0, F.concat(F.lit("not a number: "), F.array_join(bad, ",")))
    )
    checked = fields.withColumn("_reason", reason)
    good = F.col("_reason").isNull()
    return checked.select(*[F.when(good, x).alias(name) for name, x in texts.items()], "_file", "_line", "_reason")


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`(rows, rejected)` of a checked scan: the schema's columns, and `(file, line, reason)`.

    Write the checked scan first where both are used, else the files are read twice.
    """
    rows = checked.where(F.col("_reason").isNull()).drop("_file", "_line", "_reason")
    rejected = checked.where(F.col("_reason").isNotNull())
    return rows, rejected.select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason"))


def decode_categoricals(df: DataFrame) -> DataFrame:
    """Hex text of the categorical columns to signed ints."""
    return df.withColumns({c: hex_to_int32(F.col(c)) for c in categorical_columns()})


def with_row_key(df: DataFrame) -> DataFrame:
    """Number the rows of a scan. Do it once, at conversion, and keep the written column."""
    return df.withColumn(ROW_KEY, F.monotonically_increasing_id())


def day_range(root: str, first: int, last: int, name: str = "day_{}") -> list[str]:
    """Paths of the day files first..last, both included."""
    return [f"{root.rstrip('/')}/{name.format(d)}" for d in range(first, last + 1)]


def sample_rows(df: DataFrame, rows: int) -> DataFrame:
    """The first rows of a scan of files: by path, then by place in the file.

    Rows are counted by file, and the counts summed in order, slice by slice, up to the file with the
    last row wanted; the same is done with the splits of that file. Files and splits before it are
    taken whole, by conditions on where a row comes from, which also spare reading the files
    behind. Of the last split the first rows are taken by their number in it. No row goes through
    a single task.
    """
    if rows <= 0:
        return df.limit(0)
    path, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    last = _holding(df.select(path.alias("at")), rows)
    if last is None:
        return df
    file, left = df.where(path == last[0]), rows - last[1]
    block, before = _holding(file.select(start.alias("at")), left)
    # Numbers are of a task's rows; after the condition those are the rows of one split.
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rest = file.where(start == block).withColumn("_nth", nth).where(F.col("_nth") < left - before).drop("_nth")
    return df.where(path < last[0]).unionByName(file.where(start < block)).unionByName(rest)


def _holding(places: DataFrame, nth: int) -> tuple | None:
    """The place (`at`) that holds the `nth` row in the order of places, and the rows before it."""
    counts = places.groupBy("at").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    before = running_total(counts, "all", [F.col("at").asc()], F.col("n"), "before", "places")
    found = before.where((F.col("before") < nth) & (F.col("before") + F.col("n") >= nth)).first()
    return (found["at"], found["before"]) if found else None


def scan_parquet(spark: SparkSession, directory: str) -> DataFrame:
    """The Parquet files of one directory, not of its subdirectories."""
    if not exists(spark, f"{directory.rstrip('/')}/*.parquet"):
        raise FileNotFoundError(f"no Parquet file in {directory}")
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(directory)


def scan_orc(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.orc(directory)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def union_days(frames: Sequence[DataFrame]) -> DataFrame:
    """Several day frames as one, matched by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """`(file, num_rows)`, the shards listed beside the data."""
    return spark.read.schema("file string, num_rows bigint").parquet(f"{directory.rstrip('/')}/{MANIFEST_NAME}")


def scan_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """The rows of the listed shards, by a join on the file that a row comes from.

    A listed shard that is not there, or has another number of rows, is an error.
    """
    listed, rows = read_manifest(spark, directory), spark.read.parquet(directory)
    there = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("num_rows"))
    lost = listed.where("num_rows > 0").join(there, ["file", "num_rows"], "left_anti").limit(3).collect()
    if lost:
        raise FileNotFoundError(f"not as listed in the manifest of {directory}: {[r['file'] for r in lost]}")
    placed = rows.select("*", F.col("_metadata.file_path").alias("_shard"))
    return placed.join(listed.select(F.col("file").alias("_shard")), "_shard", "left_semi").drop("_shard")


def read_sidecar(spark: SparkSession, directory: str) -> DataFrame:
    """`(name, dtype, tags, cardinality)`, one row per column."""
    return spark.read.json(
        f"{directory.rstrip('/')}/{SIDECAR_NAME}",
        schema="name string, dtype string, tags array<string>, cardinality bigint",
    )


def read_cardinalities(spark: SparkSession, directory: str) -> dict[str, int]:
    """Slot sizes of the columns tagged categorical."""
    tagged = read_sidecar(spark, directory).where(F.array_contains("tags", "categorical"))
    return {r["name"]: r["cardinality"] for r in tagged.select("name", "cardinality").collect()}


REQUEST_SCHEMA = (
    "id string, inputs array<struct<name: string, shape: array<int>, "
    "datatype: string, data: array<bigint>>>"
)
REQUEST_TEXT = "text"  # holds the document where it does not parse


def scan_requests(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Scoring requests, one JSON document per line; `text` keeps those that do not parse."""
    reader = spark.readStream if stream else spark.read
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REQUEST_TEXT)
    return reader.schema(f"{REQUEST_SCHEMA}, {REQUEST_TEXT} string").json(path)
