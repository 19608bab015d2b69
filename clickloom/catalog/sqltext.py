"""Defining SQL shared by several queries."""

from __future__ import annotations

from clickloom.catalog.clicks import TRAIN_DAYS, clicks_sql, int_clicks_sql
from clickloom.schema import categorical_columns, continuous_columns

DIGITS = 4


def rounded(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), {DIGITS}) + 0.0"


def with_clicks(body: str, ints: bool = True, *ctes: str) -> str:
    view = int_clicks_sql() if ints else clicks_sql()
    parts = [f"clicks AS ({view})", f"train AS (SELECT * FROM clicks WHERE {TRAIN_DAYS})", *ctes]
    return f"WITH {', '.join(parts)} {body}"


def counts_cte(source: str, columns: list[str], name: str = "counts") -> str:
    each = [
        f"SELECT '{c}' AS col, {c} AS value, count(*) AS n FROM {source} "
        f"WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in columns
    ]
    return f"{name} AS ({' UNION ALL '.join(each)})"


def vocab_ctes(columns: list[str], max_size: int | None = None, source: str = "train") -> list[str]:
    cut = f" WHERE code <= {max_size - 1}" if max_size else ""
    return [
        counts_cte(source, columns),
        "vocab AS (SELECT * FROM (SELECT col, value, n, "
        f"row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS code FROM counts){cut})",
    ]


def coded(columns: list[str]) -> tuple[str, str]:
    """Select list and joins that turn the columns of `clicks c` into codes."""
    items = ", ".join(f"coalesce(v{c}.code, 0) AS {c}" for c in columns)
    joins = " ".join(
        f"LEFT JOIN vocab v{c} ON v{c}.col = '{c}' AND v{c}.value = c.{c}" for c in columns
    )
    return items, joins


def filled(column: str) -> str:
    return f"greatest(coalesce({column}, 0), 0)"


def moments_cte(columns: list[str], name: str = "moments") -> str:
    items = ", ".join(
        f"avg({filled(c)}) AS m{c}, stddev_samp({filled(c)}) AS s{c}" for c in columns
    )
    return f"{name} AS (SELECT {items} FROM train)"


def normal(column: str) -> str:
    """The normalized value as a 32-bit float, the type of the transformed record."""
    return f"CAST(({filled('c.' + column)} - m{column}) / s{column} AS FLOAT)"


def transformed_ctes() -> list[str]:
    """`done`: event_id, day, label, codes and normalized counts of the whole view."""
    cats, conts = categorical_columns(), continuous_columns()
    items, joins = coded(cats)
    values = ", ".join(f"{normal(c)} AS {c}" for c in conts)
    return [
        *vocab_ctes(cats),
        moments_cte(conts),
        f"done AS (SELECT c.event_id, c.day, c.label, {items}, {values} "
        f"FROM clicks c {joins}, moments)",
    ]


def transformed_columns_sql() -> str:
    cats, conts = categorical_columns(), continuous_columns()
    return ", ".join(["event_id", *cats, *[f"{rounded(c)} AS {c}" for c in conts], "label"])
