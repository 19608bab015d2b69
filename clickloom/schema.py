"""Column roles, record schemas and the two naming schemes of the click log."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, functions as F, types as T

CONTINUOUS = 13
CATEGORICAL = 26
ROW_KEY = "row_key"


def continuous_columns() -> list[str]:
    return [f"I{k}" for k in range(1, CONTINUOUS + 1)]


def categorical_columns() -> list[str]:
    return [f"C{k}" for k in range(1, CATEGORICAL + 1)]


def label_columns() -> list[str]:
    return ["label"]


def raw_schema() -> T.StructType:
    """File form: integer label and counts, categoricals as 32-bit hex text."""
    return T.StructType(
        [T.StructField(c, T.IntegerType()) for c in label_columns() + continuous_columns()]
        + [T.StructField(c, T.StringType()) for c in categorical_columns()]
    )


def _table_names() -> dict[str, str]:
    """File-form name -> table-form name."""
    names = {f"I{k}": f"num_feature_{k}" for k in range(1, CONTINUOUS + 1)}
    names.update({f"C{k}": f"cat_feature_{k}" for k in range(1, CATEGORICAL + 1)})
    return names


def table_schema() -> T.StructType:
    """Table form: 64-bit integers, except that names holding "cat" are text."""
    names = label_columns() + list(_table_names().values())
    return T.StructType(
        [T.StructField(n, T.StringType() if "cat" in n else T.LongType()) for n in names]
    )


def rename_scheme(df: DataFrame, to: str) -> DataFrame:
    """Rename between the "file" (I1, C1) and "table" (num_feature_1, cat_feature_1) schemes."""
    names = _table_names()
    if to == "file":
        names = {new: old for old, new in names.items()}
    elif to != "table":
        raise ValueError(f"unknown naming scheme: {to!r}")
    return df.withColumnsRenamed(names)


def columns_named(df: DataFrame, part: str) -> list[str]:
    """Names holding `part`, in frame order."""
    return [c for c in df.columns if part in c]


def role_of(name: str) -> str | None:
    if name in categorical_columns():
        return "categorical"
    if name in continuous_columns():
        return "continuous"
    return "target" if name in label_columns() else None


def with_roles(df: DataFrame, cardinalities: dict[str, int] | None = None) -> DataFrame:
    """Attach role tags, and cardinalities where known, as column metadata."""
    out = df
    for field in df.schema:
        role = role_of(field.name)
        if role is None:
            continue
        metadata: dict = {"tags": [role]}
        if cardinalities and field.name in cardinalities:
            metadata["cardinality"] = int(cardinalities[field.name])
        out = out.withMetadata(field.name, metadata)
    return out


def columns_tagged(df: DataFrame, tag: str) -> list[str]:
    return [f.name for f in df.schema if tag in f.metadata.get("tags", [])]


def transformed_columns() -> list[str]:
    return categorical_columns() + continuous_columns() + label_columns()


def as_transformed_types(df: DataFrame, but: Collection[str] = ()) -> DataFrame:
    """Codes as bigint, continuous as float, label as int; `but` and other columns untouched."""
    target = {"categorical": "bigint", "continuous": "float", "target": "int"}
    return df.select(
        *[
            F.col(c).cast(target[role_of(c)]).alias(c) if role_of(c) and c not in but else F.col(c)
            for c in df.columns
        ]
    )
