"""Embedding tables and the factorization-machine terms, as joins and expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickloom.operators.lookup import Limits, SideTable, lookup
from clickloom.storage import materialize

LATENT = 10
VECTOR = LATENT + 1  # ten latent numbers and one linear weight


@dataclass(frozen=True)
class Embeddings:
    """`(slot, code, vec)` for the slots of `columns`; slot k belongs to columns[k].

    Codes are frequency ranks, so low codes are the frequent ones. `sizes` may be handed
    on from an earlier version of the same table, whose keys are the same.
    """

    table: DataFrame
    columns: Sequence[str]
    side: SideTable

    @staticmethod
    def of(table: DataFrame, columns: Sequence[str], sizes: dict | None = None) -> "Embeddings":
        entries = table.select(
            F.col("slot").alias("name"),
            F.col("code").alias("value"),
            F.col("code").alias("rank"),
            F.col("vec").alias("payload"),
        )
        side = SideTable(entries, sizes) if sizes else SideTable.measure(entries, 8 * VECTOR)
        return Embeddings(table, list(columns), side)

    def lookup(
        self,
        df: DataFrame,
        columns: dict[str, str] | None = None,
        key: str | None = None,
        limits: Limits = Limits(),
    ) -> DataFrame:
        """Add `<column>__vec` for scalar code columns; a missing key gives the zero vector."""
        columns = columns or {c: c for c in self.columns}
        slots = {c: list(self.columns).index(name) for c, name in columns.items()}
        joined = lookup(df, self.side, slots, "{}__vec", key, limits)
        zero = F.array(*[F.lit(0.0)] * VECTOR).cast(self.table.schema["vec"].dataType)
        made = {f"{c}__vec" for c in columns}
        return joined.select(
            *[F.coalesce(F.col(n), zero).alias(n) if n in made else F.col(n) for n in joined.columns]
        )

    def lookup_sum(
        self, df: DataFrame, column: str, name: str, key: str, limits: Limits = Limits()
    ) -> DataFrame:
        """Add `<column>__vec` for an array column of codes: the sum of its key vectors."""
        elements = df.select(key, F.explode(column).alias("_code"))
        vectors = self.lookup(elements, {"_code": name}, None, limits)
        sums = vectors.groupBy(key).agg(
            F.array(*[F.sum(F.col("_code__vec")[j]) for j in range(VECTOR)])
            .cast(self.table.schema["vec"].dataType)
            .alias("_sum")
        )
        zero = F.array(*[F.lit(0.0)] * VECTOR).cast(self.table.schema["vec"].dataType)
        return (
            df.join(sums, key, "left")
            .withColumn(f"{column}__vec", F.coalesce("_sum", zero))
            .drop("_sum")
        )


@dataclass(frozen=True)
class ValueVectors:
    """The vector of each raw value, so that a raw column needs one lookup, not two.

    `unseen` holds, per column, the vector of code 0: that of null and unseen values.
    """

    side: SideTable
    unseen: dict[str, list[float]]
    kind: T.DataType

    @staticmethod
    def of(vocab: DataFrame, embeddings: Embeddings) -> "ValueVectors":
        """Join the vocabulary with the vectors once; keys are as many as values."""
        kind = embeddings.table.schema["vec"].dataType
        zero = F.array(*[F.lit(0.0)] * VECTOR).cast(kind)
        slots = F.create_map(*[F.lit(x) for s, c in enumerate(embeddings.columns) for x in (c, s)])
        entries = (
            vocab.where(F.col("col").isin(list(embeddings.columns)))
            .select(F.col("col").alias("name"), "value", "code", slots[F.col("col")].alias("slot"))
            .join(embeddings.table.select("slot", "code", "vec"), ["slot", "code"], "left")
            .select("name", "value", F.col("code").alias("rank"), F.coalesce("vec", zero).alias("payload"))
        )
        entries = materialize(entries, "value-vectors", partition_by="name")
        of_zero = {r["slot"]: list(r["vec"]) for r in embeddings.table.where("code = 0").collect()}  # one per slot
        unseen = {c: of_zero.get(s, [0.0] * VECTOR) for s, c in enumerate(embeddings.columns)}
        return ValueVectors(SideTable.measure(entries, 8 * VECTOR), unseen, kind)

    def lookup(self, df: DataFrame, key: str | None = None, limits: Limits = Limits()) -> DataFrame:
        """Add `<column>__vec` for the raw columns."""
        joined = lookup(df, self.side, {c: c for c in self.unseen}, "{}__vec", key, limits)
        other = {f"{c}__vec": F.array(*[F.lit(float(x)) for x in v]).cast(self.kind) for c, v in self.unseen.items()}
        return joined.select(
            *[F.coalesce(F.col(n), other[n]).alias(n) if n in other else F.col(n) for n in joined.columns]
        )


def slot_keys(vocab: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(slot, code)` of every kept value, and code 0 of every slot."""
    slots = F.create_map(*[F.lit(x) for s, c in enumerate(columns) for x in (c, s)])
    kept = vocab.select(slots[F.col("col")].alias("slot"), "code")
    zeros = vocab.sparkSession.range(len(columns)).select(
        F.col("id").cast("int").alias("slot"), F.lit(0).cast("bigint").alias("code")
    )
    return zeros.unionByName(kept)


def random_vectors(keys: DataFrame, seed: int, scale: float) -> DataFrame:
    """Starting vectors, uniform in [-scale, scale): a hash of key, position and seed."""
    unit = [
        F.pmod(F.xxhash64("slot", "code", F.lit(j), F.lit(seed)), F.lit(1 << 24)) / float(1 << 23) - 1
        for j in range(VECTOR)
    ]
    vector = F.array(*[(u * scale).cast("float") for u in unit])
    return keys.select("slot", "code", vector.alias("vec"))


def multiply_weights(dense: Column, weights: Sequence[Sequence[float]]) -> Column:
    """Each continuous value of an array times its own weight row: an array of arrays."""
    rows = F.array(*[F.array(*[F.lit(float(w)) for w in row]) for row in weights])
    return F.zip_with(dense, rows, lambda x, row: F.transform(row, lambda w: x * w))


def latent_vectors(
    vectors: Sequence[Column], dense: Column, weights: Sequence[Sequence[float]]
) -> Column:
    """The latent parts of all slots and of all continuous values, one array each."""
    slots = F.transform(
        F.array(*vectors), lambda v: F.slice(v, 1, LATENT).cast("array<double>")
    )
    return F.concat(slots, multiply_weights(dense, weights))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x)


def fm_order2(df: DataFrame, latents: Column, name: str) -> DataFrame:
    """Add half of (square of sum - sum of squares), summed over the latent dimensions."""
    zeros = F.array(*[F.lit(0.0)] * LATENT)
    summed = F.aggregate("_latents", zeros, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    squares = F.transform(F.flatten("_latents"), lambda x: x * x)
    return (
        df.withColumn("_latents", latents)
        .withColumn("_summed", F.transform(summed, lambda x: x * x))
        .withColumn(name, (total(F.col("_summed")) - total(squares)) * 0.5)
        .drop("_latents", "_summed")
    )


def linear_term(vectors: Sequence[Column], dense: Column, weights: Sequence[float]) -> Column:
    """Linear weights of the keys plus the weighted continuous values."""
    keys = F.transform(F.array(*vectors), lambda v: v[LATENT].cast("double"))
    row = F.array(*[F.lit(float(w)) for w in weights])
    return total(keys) + total(F.zip_with(dense, row, lambda x, w: x * w))
