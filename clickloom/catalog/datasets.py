"""Sources and sinks: the view written out and read back, shuffles, side tables."""

from __future__ import annotations

import warnings

from pyspark.sql import Window, functions as F, types as T

from clickloom.catalog.clicks import TRAIN_DAYS, clicks, clicks_sql, int_clicks_sql
from clickloom.catalog.features import fitted_workflow, int_clicks
from clickloom.catalog.sqltext import counts_cte, rounded, transformed_columns_sql, transformed_ctes, with_clicks
from clickloom.operators.shuffle import assign_batches, shuffle_rows
from clickloom.plans.jobs import load_and_validate, preprocess_files, preprocess_tables
from clickloom.schema import categorical_columns, columns_named, continuous_columns, label_columns, rename_scheme
from clickloom.sources.scans import (
    FILE_LIST_NAME,
    MANIFEST_NAME,
    day_range,
    decode_categoricals,
    read_cardinalities,
    read_manifest,
    read_sidecar,
    sample_rows,
    scan_checked,
    scan_delimited,
    scan_manifest,
    scan_orc,
    scan_parquet,
    scan_table,
    split_checked,
    union_days,
    with_row_key,
)
from clickloom.sources.sinks import (
    export_table,
    load_table,
    manifest,
    write_manifest,
    write_sidecar,
    write_split,
)
from clickloom.storage import materialize, read_text, scratch_path, short_methods

CATS, CONTS = categorical_columns(), continuous_columns()
RECORD = [*label_columns(), *CONTS, *CATS]
DAYS = "day={}"


def write_days(spark, sf) -> str:
    """The raw log as tab-separated files, one directory per day."""
    path = scratch_path(spark, "raw")
    with short_methods(spark):
        clicks(spark, sf).select("day", *RECORD).write.partitionBy("day").option("sep", "\t").csv(path)
    return path


def csv_scan(spark, sf):
    paths = day_range(write_days(spark, sf), 0, 29, DAYS)
    return decode_categoricals(scan_delimited(spark, paths))


def csv_recursive(spark, sf):
    return decode_categoricals(scan_delimited(spark, write_days(spark, sf), recursive=True))


def csv_missing_path(spark, sf):
    paths = day_range(write_days(spark, sf), 0, 35, DAYS)  # days 30-35 do not exist
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return decode_categoricals(scan_delimited(spark, paths))


def csv_inferred(spark, sf):
    path = scratch_path(spark, "inferred")
    clicks(spark, sf).select("label", *CONTS).write.option("sep", "\t").csv(path)
    return scan_delimited(spark, path, infer=True).toDF("label", *CONTS)


def csv_days(spark, sf):
    """Training days out of a directory of day files."""
    return decode_categoricals(
        scan_delimited(spark, day_range(write_days(spark, sf), 0, 22, DAYS))
    )


def _texts(overrides: dict[str, str] | None = None, columns: list[str] = RECORD) -> str:
    """A raw line in SQL that both engines read."""
    fields = [(overrides or {}).get(c, f"coalesce(CAST({c} AS STRING), '')") for c in columns]
    return f"concat_ws(chr(9), {', '.join(fields)})"


# What is wrong with a line, in the order of the kinds of `damaged_sql`.
FAULTS = ["surplus fields", "missing fields", "not a number: label", "not a number: I1,I2", "stray quote"]


def damaged_sql() -> str:
    """Raw lines of which one in eight has a fault, by `event_id` modulo 40, with a quote in pairs in one more."""
    kinds = [
        f"{_texts()} || chr(9) || 'x'", _texts(columns=RECORD[:-1]), _texts({"label": "'1.5'"}),
        _texts({"I1": "'99999999999'", "I2": "'seven'"}), _texts({"C3": "'\"abc'"}), _texts({"C4": "'\"ab\"'"}),
    ]
    return "CASE event_id % 40 " + " ".join(f"WHEN {k} THEN {text}" for k, text in enumerate(kinds)) + f" ELSE {_texts()} END"


def _checked(spark, sf):
    """Damaged day files, scanned."""
    path = scratch_path(spark, "damaged")
    clicks(spark, sf).selectExpr("day", f"{damaged_sql()} AS value").write.partitionBy("day").text(path)
    return split_checked(materialize(scan_checked(spark, day_range(path, 0, 29, DAYS)), "checked"))


def csv_rejects(spark, sf):
    """The lines that cannot be used, by day, with the reason."""
    day = F.regexp_extract("file", r"day=(\d+)", 1).cast("int")
    return _checked(spark, sf)[1].select(day.alias("day"), "line", "reason")


def csv_accepted(spark, sf):
    """The records of the other lines."""
    return _checked(spark, sf)[0]


def csv_quoted_rejects(spark, sf):
    """Comma-separated lines with quoted fields: rejects among lines that hold the separator in quotes."""
    path = scratch_path(spark, "quoted")
    text = "CASE event_id % 4 WHEN 0 THEN concat_ws(',', label, 'a', 'b', 'c') WHEN 1 THEN concat_ws(',', label, 'a') ELSE concat_ws(',', label, '\"a,b\"', '') END"
    clicks(spark, sf).selectExpr(f"{text} AS value").write.text(path)
    rows, rejected = split_checked(scan_checked(spark, path, ",", schema=T.StructType.fromDDL("label int, name string, note string")))
    both = rows.select(F.lit(None).cast("string").alias("reason"), "label", "name").unionByName(
        rejected.select("reason", F.lit(None).cast("int").alias("label"), F.col("line").alias("name"))
    )
    return both.groupBy("reason", "label", "name").agg(F.count("*").alias("n"))


def sampled_read(spark, sf):
    """The first 5,000 lines of the log by file and line; a day's lines are in the order of their events."""
    path = scratch_path(spark, "ordered")
    days = clicks(spark, sf).repartition("day").sortWithinPartitions("day", "event_id")
    days.select("day", *RECORD).write.partitionBy("day").option("sep", "\t").csv(path)
    return sample_rows(scan_delimited(spark, path, recursive=True), 5_000)


def union_of_days(spark, sf):
    """Day files as one frame, by a read over all their paths."""
    path = scratch_path(spark, "days")
    clicks(spark, sf).write.partitionBy("day").parquet(path)
    return spark.read.parquet(*day_range(path, 0, 29, DAYS)).select("event_id", *RECORD)


def csv_to_parquet(spark, sf):
    raw = decode_categoricals(scan_delimited(spark, write_days(spark, sf), recursive=True))
    out = write_split(with_row_key(raw), scratch_path(spark, "pq"), "train", 5, "FULL", key="row_key")
    return scan_parquet(spark, out).drop("row_key")


def orc_scan(spark, sf):
    path = scratch_path(spark, "orc")
    clicks(spark, sf).write.orc(path)
    return scan_orc(spark, path).select("event_id", *RECORD)


def _database(spark, label: str) -> str:
    """A database of this session whose tables live in the shared folder."""
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def table_roundtrip(spark, sf):
    """Load into a table twice (the second load replaces the first), export, read back."""
    name = f"{_database(spark, 'db')}.clicks"
    df = clicks(spark, sf).select("event_id", *RECORD)
    load_table(df.where("label = 1"), name)
    load_table(df, name)
    path = scratch_path(spark, "export")
    export_table(spark, name, path)
    return scan_parquet(spark, path)


def table_scan(spark, sf):
    name = f"{_database(spark, 'db')}.clicks"
    load_table(clicks(spark, sf), name)
    return scan_table(spark, name).groupBy("day").agg(F.count("*").alias("n"))


def _loaded(spark, sf, root: str | None = None) -> tuple[dict, dict]:
    """Raw day files in train and valid tables: what the load reports, and the tables' names."""
    root, name = root or write_days(spark, sf), _database(spark, "db")
    tables = {"train": f"{name}.train", "valid": f"{name}.valid"}
    paths = {"train": day_range(root, 0, 22, DAYS), "valid": day_range(root, 23, 29, DAYS)}
    return load_and_validate(spark, paths, tables), tables


def load_validate(spark, sf):
    return _loaded(spark, sf)[0]["row_counts"]


def load_validate_labels(spark, sf):
    report, _ = _loaded(spark, sf)
    return report["label_counts"].join(report["label_percent"], "label")


def load_validate_preview(spark, sf):
    return _loaded(spark, sf)[0]["preview"]


def table_types(spark, sf):
    """The training table as loaded, in the types of the table form."""
    return scan_table(spark, _loaded(spark, sf)[1]["train"])


LARGE = 1_000_000_007  # counts times this no longer fit 32 bits


def load_large_values(spark, sf):
    """Counts beyond 32 bits, from day files to the training table."""
    path = scratch_path(spark, "large")
    counts = [(F.col(c).cast("bigint") * LARGE).alias(c) for c in CONTS]
    clicks(spark, sf).select("day", "label", *counts, *CATS).write.partitionBy("day").option("sep", "\t").csv(path)
    return scan_table(spark, _loaded(spark, sf, path)[1]["train"])


def load_rejects(spark, sf):
    """Rejected lines of a load, by split and reason."""
    path = scratch_path(spark, "damaged")
    clicks(spark, sf).selectExpr("day", f"{damaged_sql()} AS value").write.partitionBy("day").text(path)
    return _loaded(spark, sf, path)[0]["rejected"].groupBy("split", "reason").agg(F.count("*").alias("n"))


def prepare_tables(spark, sf, out: str):
    """The table job over the loaded tables."""
    _, tables = _loaded(spark, sf)
    return preprocess_tables(
        spark, tables["train"], tables["valid"], out, files={"train": 4, "valid": 2}, shuffle="PER_PARTITION"
    )


def _both_splits(spark, done):
    both = scan_manifest(spark, done.train_dir).unionByName(scan_manifest(spark, done.valid_dir))
    return both.select(*CATS, *[(F.round(F.col(c).cast("double"), 4) + 0.0).alias(c) for c in CONTS], "label")


def table_job(spark, sf):
    """The whole table job: tables in, all columns of both transformed splits out."""
    return _both_splits(spark, prepare_tables(spark, sf, scratch_path(spark, "job")))


def cat_columns(spark, sf):
    """Columns chosen by a part of their name."""
    df = rename_scheme(clicks(spark, sf), "table")
    return df.select("event_id", *columns_named(df, "cat"))


def _shuffled(mode, **options):
    def run(spark, sf):
        df = clicks(spark, sf).select("event_id", *RECORD)
        return shuffle_rows(df, mode, seed=7, key="event_id", **options)

    return run


def batch_sizes(spark, sf):
    """Rows of each mini-batch, in two epochs."""
    df = clicks(spark, sf).select("event_id")
    epochs = [assign_batches(df, "event_id", 16, e).select(F.lit(e).alias("epoch"), "batch") for e in (0, 1)]
    return union_days(epochs).groupBy("epoch", "batch").agg(F.count("*").alias("n"))


def shuffle_checks(spark, sf):
    """Per mode: rows, partitions that hold some, and whether keys still ascend in any of them."""
    given = clicks(spark, sf).select("event_id").repartitionByRange(4, "event_id").sortWithinPartitions("event_id")
    before = materialize(given, "ordered")
    modes = {"none": None, "PER_PARTITION": None, "PER_WORKER": 2, "FULL": 6}
    checks = []
    for mode, parts in modes.items():
        moved = shuffle_rows(
            before, None if mode == "none" else mode, 7, parts if mode == "FULL" else None,
            parts if mode == "PER_WORKER" else None, "event_id",
        )
        place = moved.select(
            "event_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
        )
        earlier = F.lag("event_id").over(Window.partitionBy("part").orderBy("at"))
        fell = materialize(place, "placed").withColumn("fell", F.coalesce(F.col("event_id") < earlier, F.lit(False)))
        sizes = fell.groupBy("part").agg(F.count("*").alias("n"), F.max("fell").alias("fell"))
        checks.append(
            sizes.agg(F.sum("n").alias("n"), F.count("*").alias("parts"), F.max("fell").alias("fell")).select(
                F.lit(mode).alias("mode"), "n", *([F.col("parts")] if parts else [F.lit(None).cast("bigint").alias("parts")]),
                (~F.col("fell")).alias("in_order"),
            )
        )
    return union_days(checks)


def _transformed(spark, sf) -> tuple:
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    done = fitted.transform(df.where(TRAIN_DAYS), "event_id")
    path = write_split(done, scratch_path(spark, "done"), "train", 4, key="event_id")
    return done, fitted, path


def sidecar(spark, sf):
    done, fitted, path = _transformed(spark, sf)
    write_sidecar(done, path, fitted.cardinalities())
    return read_sidecar(spark, path).select(
        "name", "dtype", F.array_join("tags", ",").alias("tags"), "cardinality"
    )


def sidecar_sizes(spark, sf):
    """Slot sizes of the columns tagged categorical, in the order of the side table."""
    done, fitted, path = _transformed(spark, sf)
    write_sidecar(done, path, fitted.cardinalities())
    sizes = list(read_cardinalities(spark, path).items())
    return spark.createDataFrame([(i, c, n) for i, (c, n) in enumerate(sizes)], "slot int, col string, cardinality bigint")


def manifest_rows(spark, sf):
    _, _, path = _transformed(spark, sf)
    return manifest(spark, path).agg(
        F.count("*").alias("files"), F.sum("num_rows").alias("num_rows")
    )


def manifest_scan(spark, sf):
    _, _, path = _transformed(spark, sf)
    write_manifest(spark, path)
    done = scan_manifest(spark, path)
    return done.select("event_id", *CATS, *[(F.round(F.col(c).cast("double"), 4) + 0.0).alias(c) for c in CONTS], "label")


def manifest_of_some(spark, sf):
    """Three of four files listed: rows of the others are not read, and the text copy agrees with the table."""
    _, _, path = _transformed(spark, sf)
    write_manifest(spark, path)
    listed = materialize(read_manifest(spark, path).orderBy("file").limit(3), "listed")
    listed.write.mode("overwrite").parquet(f"{path}/{MANIFEST_NAME}")
    lines = read_text(spark, f"{path}/{FILE_LIST_NAME}").splitlines()
    return scan_manifest(spark, path).agg(F.count("*").alias("n")).select(
        (F.col("n") == listed.agg(F.sum("num_rows")).first()[0]).alias("as_listed"), F.lit(len(lines) == int(lines[0]) + 1).alias("all_in_text"),
    )


def preprocess_job(spark, sf):
    """The whole file job: raw files in, both transformed splits out; codes of each column."""
    root = write_days(spark, sf)
    done = preprocess_files(
        spark,
        day_range(root, 0, 22, DAYS),
        day_range(root, 23, 29, DAYS),
        scratch_path(spark, "job"),
        files={"train": 4, "valid": 2},
        shuffle="PER_PARTITION",
    )
    both = scan_manifest(spark, done.train_dir).unionByName(scan_manifest(spark, done.valid_dir))
    return both.unpivot([], CATS, "col", "code").groupBy("col", "code").agg(F.count("*").alias("n"))


def preprocess_rows(spark, sf):
    """All columns of both splits of the file job, without a shuffle and a set number of files."""
    root = write_days(spark, sf)
    out = scratch_path(spark, "job")
    done = preprocess_files(spark, day_range(root, 0, 22, DAYS), day_range(root, 23, 29, DAYS), out)
    return _both_splits(spark, done)


QUERIES = {
    "csv_scan": csv_scan,
    "csv_recursive": csv_recursive,
    "csv_missing_path": csv_missing_path,
    "csv_inferred": csv_inferred,
    "csv_days": csv_days,
    "sampled_read": sampled_read,
    "union_days": union_of_days,
    "csv_to_parquet": csv_to_parquet,
    "orc_scan": orc_scan,
    "table_roundtrip": table_roundtrip,
    "table_scan": table_scan,
    "load_validate": load_validate,
    "shuffle_none": _shuffled(None),
    "shuffle_full": _shuffled("FULL", files=6),
    "shuffle_partition": _shuffled("PER_PARTITION"),
    "shuffle_worker": _shuffled("PER_WORKER", workers=2),
    "batch_sizes": batch_sizes,
    "sidecar": sidecar,
    "sidecar_sizes": sidecar_sizes,
    "manifest_rows": manifest_rows,
    "manifest_scan": manifest_scan,
    "manifest_of_some": manifest_of_some,
    "csv_rejects": csv_rejects,
    "csv_accepted": csv_accepted,
    "csv_quoted_rejects": csv_quoted_rejects,
    "load_large_values": load_large_values,
    "load_rejects": load_rejects,
    "preprocess_job": preprocess_job,
    "preprocess_rows": preprocess_rows,
    "table_job": table_job,
    "table_types": table_types,
    "load_validate_labels": load_validate_labels,
    "load_validate_preview": load_validate_preview,
    "cat_columns": cat_columns,
    "shuffle_checks": shuffle_checks,
}

_RECORDS = f"SELECT {', '.join(RECORD)} FROM ({int_clicks_sql()})"
_VIEW = f"SELECT event_id, {', '.join(RECORD)} FROM ({clicks_sql()})"

_TABLE_FORM = ", ".join(
    ["CAST(label AS BIGINT) AS label"]
    + [f"CAST({c} AS BIGINT) AS num_feature_{k}" for k, c in enumerate(CONTS, 1)]
    + [f"{c} AS cat_feature_{k}" for k, c in enumerate(CATS, 1)]
)
_DONE = f"SELECT {', '.join(CATS)}, {', '.join(f'{rounded(c)} AS {c}' for c in CONTS)}, label FROM done"


def _batch_sql(epoch: int) -> str:
    digest = f"md5(concat(event_id, ':{epoch}'))"
    return (
        f"SELECT {epoch} AS epoch, CAST(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % 16 AS INTEGER) AS batch, "
        "count(*) AS n FROM events GROUP BY 1, 2"
    )


SQL = {
    "preprocess_rows": with_clicks(_DONE, True, *transformed_ctes()),
    "table_job": with_clicks(_DONE, False, *transformed_ctes()),
    "table_types": f"SELECT {_TABLE_FORM} FROM ({clicks_sql()}) WHERE {TRAIN_DAYS}",
    "load_validate_labels": with_clicks(
        "SELECT CAST(label AS BIGINT) AS label, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM train) "
        "AS DOUBLE) * 100, 2) AS percentage FROM train GROUP BY label",
        False,
    ),
    "load_validate_preview": f"SELECT {_TABLE_FORM} FROM ({clicks_sql()}) WHERE {TRAIN_DAYS} ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in RECORD)
    + " LIMIT 10",
    "cat_columns": "SELECT event_id, "
    + ", ".join(f"{c} AS cat_feature_{k}" for k, c in enumerate(CATS, 1))
    + f" FROM ({clicks_sql()})",
    "shuffle_checks": "SELECT mode, n, CAST(parts AS BIGINT) AS parts, mode = 'none' AS in_order FROM (SELECT count(*) AS n "
    "FROM events), (VALUES ('none', NULL), ('PER_PARTITION', NULL), ('PER_WORKER', 2), ('FULL', 6)) m(mode, parts)",
    "csv_scan": _RECORDS,
    "csv_recursive": _RECORDS,
    "csv_missing_path": _RECORDS,
    "csv_inferred": f"SELECT label, {', '.join(CONTS)} FROM ({clicks_sql()})",
    "csv_days": f"{_RECORDS} WHERE {TRAIN_DAYS}",
    "sampled_read": f"SELECT {', '.join(RECORD)} FROM ({clicks_sql()}) ORDER BY 'day=' || day, event_id LIMIT 5000",
    "union_days": _VIEW,
    "csv_to_parquet": _RECORDS,
    "orc_scan": _VIEW,
    "table_roundtrip": _VIEW,
    "table_scan": f"SELECT day, count(*) AS n FROM ({clicks_sql()}) GROUP BY day",
    "load_validate": "SELECT CASE WHEN day < 23 THEN 'train' ELSE 'valid' END AS split, "
    f"count(*) AS n FROM ({clicks_sql()}) GROUP BY 1",
    "shuffle_none": _VIEW,
    "shuffle_full": _VIEW,
    "shuffle_partition": _VIEW,
    "shuffle_worker": _VIEW,
    "batch_sizes": f"{_batch_sql(0)} UNION ALL {_batch_sql(1)}",
    "sidecar": with_clicks(
        "SELECT f.name, f.dtype, f.tags, k.cardinality FROM (VALUES "
        + ", ".join(
            [f"('{c}', 'bigint', 'categorical')" for c in CATS]
            + [f"('{c}', 'float', 'continuous')" for c in CONTS]
            + ["('label', 'int', 'target')", "('event_id', 'bigint', '')"]
        )
        + ") f(name, dtype, tags) LEFT JOIN (SELECT col, count(*) + 1 AS cardinality FROM counts "
        "GROUP BY col) k ON k.col = f.name",
        True,
        counts_cte("train", CATS),
    ),
    "sidecar_sizes": with_clicks(
        "SELECT CAST(CAST(substr(col, 2) AS INTEGER) - 1 AS INTEGER) AS slot, col, count(*) + 1 AS cardinality FROM counts GROUP BY col",
        True,
        counts_cte("train", CATS),
    ),
    "manifest_rows": "SELECT CAST(4 AS BIGINT) AS files, count(*) AS num_rows "
    f"FROM ({clicks_sql()}) WHERE {TRAIN_DAYS}",
    "manifest_scan": with_clicks(
        f"SELECT {transformed_columns_sql()} FROM done WHERE {TRAIN_DAYS}", True, *transformed_ctes()
    ),
    "manifest_of_some": "SELECT true AS as_listed, true AS all_in_text",
    "csv_rejects": f"SELECT day, {damaged_sql()} AS line, CASE event_id % 40 "
    + " ".join(f"WHEN {k} THEN '{fault}'" for k, fault in enumerate(FAULTS))
    + f" END AS reason FROM ({clicks_sql()}) WHERE event_id % 40 < {len(FAULTS)}",
    "csv_accepted": f"SELECT {', '.join(RECORD)} FROM (SELECT * REPLACE (CASE WHEN event_id % 40 = 5 THEN '\"ab\"' ELSE C4 END AS C4) "
    f"FROM ({clicks_sql()})) WHERE event_id % 40 >= {len(FAULTS)}",
    "csv_quoted_rejects": "SELECT CASE event_id % 4 WHEN 0 THEN 'surplus fields' WHEN 1 THEN 'missing fields' END AS reason, "
    "CASE WHEN event_id % 4 > 1 THEN label END AS label, CASE event_id % 4 WHEN 0 THEN label || ',a,b,c' WHEN 1 THEN label || ',a' "
    f"ELSE 'a,b' END AS name, count(*) AS n FROM ({clicks_sql()}) GROUP BY ALL",
    "load_large_values": "SELECT CAST(label AS BIGINT) AS label, "
    + ", ".join(f"CAST({c} AS BIGINT) * {LARGE} AS num_feature_{k}" for k, c in enumerate(CONTS, 1))
    + ", "
    + ", ".join(f"{c} AS cat_feature_{k}" for k, c in enumerate(CATS, 1))
    + f" FROM ({clicks_sql()}) WHERE {TRAIN_DAYS}",
    # Under the table's types 99999999999 is a number, so there only the second count is none.
    "load_rejects": f"SELECT CASE WHEN {TRAIN_DAYS} THEN 'train' ELSE 'valid' END AS split, CASE event_id % 40 "
    + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate([*FAULTS[:3], "not a number: num_feature_2", FAULTS[4]]))
    + f" END AS reason, count(*) AS n FROM ({clicks_sql()}) WHERE event_id % 40 < {len(FAULTS)} GROUP BY ALL",
    "preprocess_job": with_clicks(
        "SELECT col, code, count(*) AS n FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS col, coalesce(v.code, 0) AS code FROM splits LEFT JOIN vocab v "
            f"ON v.col = '{c}' AND v.value = splits.{c}"
            for c in CATS
        )
        + ") GROUP BY col, code",
        True,
        "counts AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS col, {c} AS value, count(*) AS n FROM train WHERE {c} IS NOT NULL "
            f"GROUP BY {c}"
            for c in CATS
        )
        + ")",
        "vocab AS (SELECT col, value, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) "
        "AS code FROM counts)",
        "splits AS (SELECT * FROM clicks)",
    ),
}
