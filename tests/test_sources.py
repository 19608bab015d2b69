"""Lines that cannot be used, first rows of files, and lists of shards."""

import datetime
import random

import pytest
from pyspark.sql import functions as F, types as T

from clickloom.operators.lookup import Limits, maybe_in_tail
from clickloom.operators.vocab import Vocabulary
from clickloom.plans.jobs import load_and_validate
from clickloom.plans.ops import Clip, FillMissing, Log1p, Normalize
from clickloom.schema import table_schema
from clickloom.sources.scans import read_manifest, sample_rows, scan_checked, scan_delimited, scan_manifest, split_checked
from clickloom.sources.sinks import write_manifest
from clickloom.storage import read_text

FIELDS = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])


def test_each_fault_has_its_reason(spark, tmp_path):
    lines = {
        "1\t2.5\ta": None, "\t\t": None, "+7\t1e3\t ": None, "-2147483648\tNaN\t\"a\"": None,
        "1\t2": "missing fields", "1\t2\ta\t": "surplus fields", "1\t2\ta\"b": "stray quote", " 1\t2\ta": "not a number: n",
        "2147483648\tx\ta": "not a number: n,x", "1.0\t2\ta": "not a number: n", "only": "missing fields",
    }
    (tmp_path / "f.tsv").write_text("\n".join([*lines, "", ""]))
    checked = scan_checked(spark, str(tmp_path / "f.tsv"), schema=FIELDS).collect()
    assert {r["_line"]: r["_reason"] for r in checked} == lines
    assert all(r["n"] is None and r["s"] is None for r in checked if r["_reason"])
    rows, rejected = split_checked(scan_checked(spark, str(tmp_path), schema=FIELDS))
    good = scan_delimited(spark, str(tmp_path), schema=FIELDS).collect()
    assert rows.columns == ["n", "x", "s"] and set(map(str, rows.collect())) <= set(map(str, good))
    assert {r.reason for r in rejected.collect()} == {x for x in lines.values() if x} and rejected.first().file.endswith("f.tsv")
    quoted = tmp_path / "q.csv"
    quoted.write_text('1,2,"a,b"\n1,2,"a ""b"" c"\n1,2\n1,2,"a",4\n1,2,\n')
    got = [(r["_reason"], r["s"]) for r in scan_checked(spark, str(quoted), ",", schema=FIELDS).collect()]
    assert got[2:] == [("missing fields", None), ("surplus fields", None), (None, None)] and got[0] == (None, "a,b") and got[1][0] is None


def test_load_keeps_64_bit_values_and_reports_rejects(spark, tmp_path):
    good = "\t".join(["1", "3000000000", *["5"] * 12, *["0000000a"] * 26])
    (tmp_path / "day").write_text(f"{good}\n{good}\t9\n")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS large LOCATION '{tmp_path}/db'")
    tables = {"train": "large.train", "valid": "large.valid"}
    report = load_and_validate(spark, {"train": [f"{tmp_path}/day"], "valid": [f"{tmp_path}/day"]}, tables)
    assert [r.num_feature_1 for r in spark.table("large.train").collect()] == [3_000_000_000]
    assert spark.table("large.train").schema.simpleString() == table_schema().simpleString()
    assert [(r.split, r.reason) for r in report["rejected"].orderBy("split").collect()] == [("train", "surplus fields"), ("valid", "surplus fields")]


def test_first_rows_of_files_cut_into_many_splits(spark, tmp_path):
    lines = [f"{i}\t{'x' * (i % 37)}" for i in range(3000)]
    for k, part in enumerate((lines[:1200], [], lines[1200:1203], lines[1203:])):
        (tmp_path / f"part-{k}").write_text("".join(x + "\n" for x in part))
    schema = T.StructType.fromDDL("n int, s string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        for rows in (0, 1, 77, 1200, 1201, 1203, 2999, 3000, 9000):
            first = sample_rows(scan_delimited(spark, str(tmp_path), schema=schema), rows)
            assert first.columns == ["n", "s"] and sorted(r.n for r in first.collect()) == list(range(min(rows, 3000)))
        plan = sample_rows(scan_delimited(spark, str(tmp_path), schema=schema), 77)._jdf.queryExecution().executedPlan().toString()
        assert "Limit" not in plan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_manifest_tells_lost_and_foreign_shards(spark, tmp_path):
    path = f"{tmp_path}/data"
    spark.range(90).repartition(3).write.parquet(path)
    write_manifest(spark, path)
    listed = read_manifest(spark, path)
    assert (listed.count(), listed.agg(F.sum("num_rows")).first()[0]) == (3, 90)
    text = read_text(spark, f"{path}/_file_list.txt").splitlines()
    assert text[0] == "3" and text[1:] == sorted(r.file for r in listed.collect())
    spark.range(1000, 1010).write.mode("append").parquet(path)  # not listed, not read
    assert sorted(r.id for r in scan_manifest(spark, path).collect()) == list(range(90))
    spark.createDataFrame([(f"{path}/none.parquet", 5)], "file string, num_rows bigint").write.mode("append").parquet(f"{path}/_manifest")
    with pytest.raises(FileNotFoundError):
        scan_manifest(spark, path)


def test_values_of_many_kinds_are_coded_in_their_own_order(spark):
    day = datetime.date(2024, 1, 9)
    values = {
        "i bigint": [-5, 10, 9, -40, 10, None], "d double": [-0.0, 0.0, 1e10, 2.5, -3.0, float("nan")], "s string": ["b", "a", "10", "9", "", None],
        "t date": [day, day.replace(day=1), None, day, None, None], "b boolean": [True, False, False, None, True, True], "f float": [0.1, 0.2, 0.1, 10.5, 9.25, None],
        "m decimal(10,2)": [*[__import__("decimal").Decimal(x) for x in ("10.00", "9.50", "9.50", "-1.25")], None, None],
    }
    df = spark.createDataFrame(list(zip(*values.values(), strict=True)), ", ".join(values))
    vocab = Vocabulary.fit(df, df.columns)
    order = {c: [r.value for r in vocab.table.where(F.col("col") == c).orderBy("code").collect()] for c in df.columns}
    assert order["i"] == ["10", "-40", "-5", "9"] and order["d"] == ["0.0", "-3.0", "2.5", "1.0E10", "NaN"]
    assert order["s"] == ["", "10", "9", "a", "b"] and order["t"] == ["2024-01-09", "2024-01-01"] and order["b"] == ["true", "false"]
    assert order["f"] == ["0.1", "0.2", "9.25", "10.5"] and order["m"] == ["9.50", "-1.25", "10.00"]
    coded = vocab.encode(df).collect()
    assert [r.d for r in coded] == [1, 1, 4, 3, 2, 5] and [r.b for r in coded] == [1, 2, 2, 0, 1, 1] and [r.i for r in coded] == [3, 1, 4, 2, 1, 0]
    with pytest.raises(ValueError):
        Vocabulary.fit(df.select(F.array("i").alias("a")), ["a"])


def test_vectors_go_through_operators_by_position(spark):
    rows = [(1, [1.0, None, 3.0], 5.0), (2, [3.0, 2.0, -9.0], 7.0), (3, None, None), (4, [5.0, 4.0], 6.0), (5, [], 1.0)]
    df = spark.createDataFrame(rows, "id int, v array<double>, x double")
    done = df
    for op in (FillMissing(["v", "x"], 0), Clip(["v", "x"], 0, 4), Normalize(["v", "x"])):
        done = op.apply(done, op.fit(done))
    got = {r.id: r.v for r in done.collect()}
    assert got[3] is None and got[5] == [] and [round(x, 4) for x in got[1]] == [-1.0911, -1.0, 0.7071]  # of 1 3 4, of 0 2 4, of 3 0
    logs = Log1p(["v"]).apply(df, None).where("id = 2").first().v
    assert round(logs[0], 6) == 1.386294
    other = Normalize(["v"]).apply(spark.createDataFrame([([9.0] * 5,)], "v array<double>"), {"v": [[1.0, 9.0], [2.0, 0.0]]}).first().v
    assert other == [4.0, 0.0, 9.0, 9.0, 9.0]


def test_most_unseen_values_are_told_without_a_shuffle(spark):
    random.seed(1)
    tail = spark.range(5000).selectExpr("'c' AS name", "id * 3 AS value", "id AS payload")
    pairs = spark.range(20_000).selectExpr("id AS key", "'c' AS column", "'c' AS name", "CASE WHEN id < 2000 THEN id * 3 ELSE -id END AS value")
    passed = maybe_in_tail(pairs, tail, Limits())
    assert passed.columns == pairs.columns and passed.where("key < 2000").count() == 2000
    assert passed.count() < 2000 + 18_000 * 0.03
    assert maybe_in_tail(pairs, tail.limit(0), Limits()).count() == 0
    crowded = maybe_in_tail(pairs, tail, Limits(filter_bits=64))
    assert crowded.where("key < 2000").count() == 2000
