"""The click-log view derived from `events`; one text serves Spark and the checking engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.schema import categorical_columns, continuous_columns

# Most distinct values a categorical column of the view can hold, C1..C26.
DISTINCT = [
    3, 7, 12, 25, 40, 64, 100, 150, 200, 300, 400, 500, 600,
    700, 800, 900, 1000, 1200, 1500, 2000, 2500, 3000, 3500, 4000, 4500, 5000,
]

TRAIN_DAYS = "day < 23"
VALID_DAYS = "day >= 23"


def _columns() -> list[str]:
    out = [
        "event_id",
        "CAST(day(ts) - 1 AS INT) AS day",
        "CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS label",
    ]
    for k, name in enumerate(continuous_columns(), 1):
        out.append(
            f"CASE WHEN (event_id*{2 * k + 1} + user_id) % 7 = 0 THEN NULL "
            f"ELSE CAST((event_id*{2 * k + 3} + user_id*{k}) % {50 * k + 13} - 5 AS INT) END AS {name}"
        )
    for k, name in enumerate(categorical_columns(), 1):
        value = (
            f"(((event_id*{2 * k + 1} + user_id) % {DISTINCT[k - 1]}) * 2654435761 + {k})"
            " % 4294967296"
        )
        out.append(
            f"CASE WHEN (event_id + {k}) % 19 = 0 THEN NULL "
            f"ELSE lpad(lower(hex({value})), 8, '0') END AS {name}"
        )
    return out


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over `events`, dealt out by key before its columns are made.

    A record of the file takes a few bytes and its 40 columns take most of the work, so that splits
    by bytes, or few row groups, would leave most cores without a task.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    dealt = events.select("event_id", "ts", "user_id", "event_type").repartition("event_id")
    return dealt.selectExpr(*_columns())


def clicks_sql() -> str:
    return "SELECT " + ", ".join(_columns()) + " FROM events"


def hex_sql(column: str) -> str:
    """Signed 32-bit value of hex text."""
    unsigned = f"CAST('0x' || {column} AS BIGINT)"
    return (
        f"CAST(CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 "
        f"ELSE {unsigned} END AS INTEGER)"
    )


def int_clicks_sql() -> str:
    """The view with integer categoricals, as the file path delivers them."""
    cats = ", ".join(f"{hex_sql(c)} AS {c}" for c in categorical_columns())
    return f"SELECT * REPLACE ({cats}) FROM ({clicks_sql()})"
