"""Frequency vocabularies: fit, cut, code, apply, and checks against them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.operators.lookup import Limits, SideTable, lookup
from clickloom.operators.ordering import running_total
from clickloom.storage import materialize


_INTEGERS = {"tinyint", "smallint", "int", "bigint"}
_FRACTIONS = {"float", "double"}


def _value_type(df: DataFrame, columns: list[str]) -> str:
    """The type in which the values of all columns of one vocabulary are counted together.

    Integers stay integers where there is nothing else; any other mixture is counted as text.
    """
    kinds = {t for c, t in df.select(*columns).dtypes}
    if any(t.startswith(("array", "map", "struct", "binary", "variant")) for t in kinds):
        raise ValueError(f"categorical columns hold single values, not {sorted(kinds)}")
    return "bigint" if kinds <= _INTEGERS else "string"


def as_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with fractions free of a negative zero, so that equal numbers have one text."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.col(c) + F.lit(0).cast(kinds[c]) for c in columns if kinds[c] in _FRACTIONS})


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """`(col, value, n)` of the non-null values of all columns, in one shuffle."""
    kind = _value_type(df, columns)
    return (
        as_values(df.select(*columns), columns)
        .select(*[F.col(c).cast(kind).alias(c) for c in columns])
        .unpivot([], columns, "col", "value")
        .where(F.col("value").isNotNull())
        .groupBy("col", "value")
        .agg(F.count("*").alias("n"))
    )


def value_order(kinds: dict[str, str]) -> list[Column]:
    """Sort keys that put the values, as text, in the order of their columns' own types.

    Whole numbers and fractions are read back, one key for each; dates, times, truth values and
    text sort as they are written. Decimals go by their fraction, then by what is left as text.
    """
    whole = [c for c, t in kinds.items() if t in _INTEGERS]
    rest = [c for c, t in kinds.items() if t in _FRACTIONS or t.startswith("decimal")]
    keys = []
    for columns, kind in ((whole, "bigint"), (rest, "double")):
        if columns:
            keys.append(F.when(F.col("col").isin(columns), F.col("value").try_cast(kind)).asc())
    return [*keys, F.col("value").asc()]


def rank_values(counts: DataFrame, max_size: int | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """Code the values of each column 1.. by (count desc, value asc); with `max_size`, keep max_size - 1.

    `kinds` names the columns' types where the values are text of several of them.
    """
    order = [F.col("n").desc(), *(value_order(kinds) if kinds else [F.col("value").asc()])]
    ranked = running_total(counts, "col", order, F.lit(1), "_before", "ranked").select(
        "col", "value", "n", (F.col("_before") + 1).cast("bigint").alias("code")
    )
    return ranked if max_size is None else ranked.where(F.col("code") <= max_size - 1)


@dataclass(frozen=True)
class Vocabulary:
    """Fitted codes `(col, value, n, code)` in the shared folder, and their sizes."""

    table: DataFrame
    columns: list[str]
    side: SideTable

    @staticmethod
    def of(table: DataFrame, columns: list[str]) -> "Vocabulary":
        entries = table.select(
            F.col("col").alias("name"),
            "value",
            F.col("code").alias("rank"),
            F.col("code").alias("payload"),
        )
        return Vocabulary(table, list(columns), SideTable.measure(entries, payload_bytes=8))

    @staticmethod
    def fit(
        df: DataFrame, columns: list[str], max_size: int | None = None
    ) -> "Vocabulary":
        """Codes of all columns in one count; they may be of different types."""
        text = _value_type(df, columns) == "string"
        coded = rank_values(value_counts(df, columns), max_size, dict(df.select(*columns).dtypes) if text else None)
        return Vocabulary.of(materialize(coded, "vocab", partition_by="col"), columns)

    def cardinalities(self) -> dict[str, int]:
        """Kept values plus the reserved code 0."""
        return {c: self.side.sizes.get(c, (0, 0))[0] + 1 for c in self.columns}

    def encode(
        self,
        df: DataFrame,
        columns: dict[str, str] | None = None,
        key: str | None = None,
        limits: Limits = Limits(),
    ) -> DataFrame:
        """Replace values by codes; null, unseen and cut-off values become 0."""
        columns = columns or {c: c for c in self.columns}
        text = dict(self.table.dtypes)["value"] == "string"
        coded = lookup(as_values(df, list(columns)) if text else df, self.side, columns, "{}__code", key, limits)
        return coded.select(
            *[
                F.coalesce(F.col(f"{c}__code"), F.lit(0)).cast("bigint").alias(c)
                if c in columns
                else F.col(c)
                for c in df.columns
            ]
        )


def cardinality_table(vocab: DataFrame) -> DataFrame:
    """`(col, cardinality)`, the slot sizes; codes are dense so the largest is the count."""
    return vocab.groupBy("col").agg((F.max("code") + 1).alias("cardinality"))


def slot_offsets(cardinalities: DataFrame, columns: list[str]) -> DataFrame:
    """`(slot, col, cardinality, offset)`: (slot, code) -> offset + code is a global key.

    One row per categorical column, so the ordered window over all of them is tiny.
    """
    slots = F.create_map(*[F.lit(x) for slot, c in enumerate(columns) for x in (c, slot)])
    earlier = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return cardinalities.withColumn("slot", slots[F.col("col")]).select(
        "slot",
        "col",
        "cardinality",
        F.coalesce(F.sum("cardinality").over(earlier), F.lit(0)).alias("offset"),
    )


def unseen_values(df: DataFrame, vocab: DataFrame, columns: list[str]) -> DataFrame:
    """`(col, value, n)` of values without a code; counted first, so the join is on values."""
    return value_counts(df, columns).join(vocab.select("col", "value"), ["col", "value"], "left_anti")


def encode_lists(
    df: DataFrame,
    vocab: Vocabulary,
    column: str,
    key: str,
    nnz: int | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Codes of an array column, ascending; with `nnz` only that many, the most frequent.

    `key` must be unique; an empty or null list stays an empty list.
    """
    name = vocab.columns[0]
    position = "_element"
    elements = df.select(key, F.posexplode(column).alias("_pos", position))
    codes = (
        vocab.encode(elements, {position: name}, None, limits)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(position)).alias("_codes"))
    )
    if nnz is not None:
        codes = codes.withColumn("_codes", F.slice("_codes", 1, nnz))
    return (
        df.join(codes, key, "left")
        .withColumn(column, F.coalesce("_codes", F.array().cast("array<bigint>")))
        .drop("_codes")
    )


def fit_lists(
    df: DataFrame, column: str, max_size: int | None = None
) -> Vocabulary:
    """Vocabulary over the elements of an array column."""
    return Vocabulary.fit(df.select(F.explode(column).alias(column)), [column], max_size)
