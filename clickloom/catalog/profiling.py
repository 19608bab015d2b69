"""Looking at the log: conversions, counts, shares, statistics, previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.catalog.clicks import TRAIN_DAYS, VALID_DAYS, clicks, clicks_sql, hex_sql
from clickloom.catalog.sqltext import rounded, with_clicks
from clickloom.operators import profile
from clickloom.schema import categorical_columns, continuous_columns, label_columns, rename_scheme
from clickloom.sources.scans import decode_categoricals

CATS, CONTS = categorical_columns(), continuous_columns()
FIELDS = ["event_id", *label_columns(), *CONTS, *CATS]


def _round(name: str):
    return (F.round(F.col(name).cast("double"), 4) + 0.0).alias(name)


def hex_to_int32(spark, sf):
    return decode_categoricals(clicks(spark, sf)).select("event_id", *CATS)


def rename(spark, sf):
    return rename_scheme(clicks(spark, sf), "table")


def _splits(spark, sf):
    df = clicks(spark, sf)
    return df.withColumn(
        "split", F.expr(f"CASE WHEN {TRAIN_DAYS} THEN 'train' WHEN {VALID_DAYS} THEN 'valid' END")
    )


def row_counts(spark, sf):
    return profile.row_counts(_splits(spark, sf))


def label_counts(spark, sf):
    return profile.label_counts(clicks(spark, sf))


def label_percent(spark, sf):
    return profile.label_percent(clicks(spark, sf))


STATS = ["mean", "std", "min", "max", "q25", "q50", "q75"]


def describe(spark, sf):
    stats = profile.describe(clicks(spark, sf), [*label_columns(), *CONTS])
    return stats.select("col", "n", *[_round(s) for s in STATS])


def describe_orders(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    stats = profile.describe(orders, ["o_custkey", "o_totalprice"])
    return stats.select("col", "n", *[_round(s) for s in STATS])


def _describe_sql(columns, source):
    each = [
        f"SELECT '{c}' AS col, count({c}) AS n, {rounded(f'avg({c})')} AS mean, "
        f"{rounded(f'stddev_samp({c})')} AS std, {rounded(f'min({c})')} AS min, "
        f"{rounded(f'max({c})')} AS max, {rounded(f'quantile_cont({c}, 0.25)')} AS q25, "
        f"{rounded(f'quantile_cont({c}, 0.5)')} AS q50, "
        f"{rounded(f'quantile_cont({c}, 0.75)')} AS q75 FROM {source}"
        for c in columns
    ]
    return " UNION ALL ".join(each)


def preview(spark, sf):
    return profile.preview(clicks(spark, sf).select(*FIELDS), "event_id")


def preview_transposed(spark, sf):
    return profile.preview_transposed(clicks(spark, sf), "event_id", FIELDS[1:])


def _preview_transposed_sql():
    head = "head AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS r FROM clicks ORDER BY event_id LIMIT 5)"
    each = [
        f"SELECT '{c}' AS col, "
        + ", ".join(f"max(CASE WHEN r = {i} THEN CAST({c} AS VARCHAR) END) AS row_{i}" for i in range(5))
        + " FROM head"
        for c in FIELDS[1:]
    ]
    return with_clicks(" UNION ALL ".join(each), False, head)


def filter_days(spark, sf):
    return clicks(spark, sf).where(F.col("day").between(0, 22)).select("day", *FIELDS)


QUERIES = {
    "hex_to_int32": hex_to_int32,
    "rename": rename,
    "row_counts": row_counts,
    "label_counts": label_counts,
    "label_percent": label_percent,
    "describe": describe,
    "describe_orders": describe_orders,
    "preview": preview,
    "preview_transposed": preview_transposed,
    "day_range": filter_days,
}

SQL = {
    "hex_to_int32": "SELECT event_id, "
    + ", ".join(f"{hex_sql(c)} AS {c}" for c in CATS)
    + f" FROM ({clicks_sql()})",
    "rename": "SELECT event_id, day, label, "
    + ", ".join(f"I{k} AS num_feature_{k}" for k in range(1, 14))
    + ", "
    + ", ".join(f"C{k} AS cat_feature_{k}" for k in range(1, 27))
    + f" FROM ({clicks_sql()})",
    "row_counts": f"SELECT CASE WHEN {TRAIN_DAYS} THEN 'train' ELSE 'valid' END AS split, "
    f"count(*) AS n FROM ({clicks_sql()}) GROUP BY 1",
    "label_counts": f"SELECT label, count(*) AS n FROM ({clicks_sql()}) GROUP BY label",
    "label_percent": with_clicks(
        "SELECT label, round(count(*) / CAST((SELECT count(*) FROM clicks) AS DOUBLE) * 100, 2) "
        "AS percentage FROM clicks GROUP BY label",
        False,
    ),
    "describe": with_clicks(_describe_sql([*label_columns(), *CONTS], "clicks"), False),
    "describe_orders": _describe_sql(["o_custkey", "o_totalprice"], "orders"),
    "preview": f"SELECT {', '.join(FIELDS)} FROM ({clicks_sql()}) ORDER BY event_id LIMIT 10",
    "preview_transposed": _preview_transposed_sql(),
    "day_range": f"SELECT day, {', '.join(FIELDS)} FROM ({clicks_sql()}) WHERE day BETWEEN 0 AND 22",
}
