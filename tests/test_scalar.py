from pyspark.sql import functions as F

from clickloom.functions import scalar
from clickloom.plans.ops import FilterRange, Impute, Normalize


def one(spark, sql_value, make):
    return spark.sql(f"SELECT {sql_value} AS x").select(make(F.col("x"))).collect()[0][0]


def test_hex_to_int32(spark):
    texts = ["ffffffff", "7fffffff", "80000000", "0", "FF", "zz", "", None, "123456789", "12 "]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(scalar.hex_to_int32(F.col("x"))).collect()]
    assert got == [-1, 2**31 - 1, -(2**31), 0, 255, None, None, None, None, None]


def test_clip_keeps_null_and_bounds(spark):
    df = spark.createDataFrame([(-5,), (None,), (7,), (900,)], "x int")
    got = [r[0] for r in df.select(scalar.clip(F.col("x"), 0, 100)).collect()]
    assert got == [0, None, 7, 100]


def test_bucketize_edges_belong_to_the_upper_bucket(spark):
    df = spark.createDataFrame([(4.0,), (5.0,), (9.9,), (10.0,), (None,)], "x double")
    got = [r[0] for r in df.select(scalar.bucketize(F.col("x"), [10, 5])).collect()]
    assert got == [0, 1, 1, 2, None]


def test_to_int32_out_of_range_is_null(spark):
    assert one(spark, "3000000000L", scalar.to_int32) is None
    assert one(spark, "-7L", scalar.to_int32) == -7


def test_cross_with_a_missing_part_is_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    got = [r[0] for r in df.select(scalar.cross([F.col("x"), F.col("y")])).collect()]
    assert got == ["1_a", None]


def test_normalize_without_spread_only_centres(spark):
    df = spark.createDataFrame([(5,), (5,), (5,)], "x int")
    op = Normalize(["x"])
    assert [r[0] for r in op.apply(df, op.fit(df)).collect()] == [0.0, 0.0, 0.0]
    single = df.limit(1)
    assert op.apply(single, op.fit(single)).collect()[0][0] == 0.0


def test_impute_median_interpolates(spark):
    df = spark.createDataFrame([(1,), (2,), (10,), (3,), (None,)], "x int")
    op = Impute(["x"], "median")
    assert op.fit(df) == {"x": 2.5}
    assert sorted(r[0] for r in op.apply(df, op.fit(df)).collect()) == [1, 2, 2.5, 3, 10]


def test_filter_range_null_handling(spark):
    df = spark.createDataFrame([(1,), (50,), (None,)], "x int")
    assert FilterRange(["x"], 0, 10).apply(df, None).count() == 1
    assert FilterRange(["x"], 0, 10, keep_null=True).apply(df, None).count() == 2
