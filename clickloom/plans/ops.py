"""Feature operators. Each can be fitted, and applies its state to any frame.

`fit(df)` returns the state (None when there is nothing to learn). `apply(df, state)` is lazy,
except that a lookup in a vocabulary too large to broadcast writes the frame out. Operators that
rewrite values in place take array columns too, element by element. `reads` and `writes` name the columns touched, so that a workflow fits an operator
on just the operators its columns depend on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickloom.functions import scalar
from clickloom.operators.lookup import Limits
from clickloom.operators.moments import moments, moments_by_position, quantiles
from clickloom.operators.vocab import Vocabulary, encode_lists, fit_lists


def array_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.ArrayType)]


class Op:
    """Base: an operator that rewrites its columns in place and learns nothing."""

    columns: Sequence[str]

    @property
    def reads(self) -> set[str]:
        return set(self.columns)

    @property
    def writes(self) -> set[str]:
        return set(self.columns)

    @property
    def fitted(self) -> bool:
        """True when the operator learns from data."""
        return False

    def fit(self, df: DataFrame) -> Any:
        return None

    def each(self, value: Column, name: str, state: Any) -> Column:
        raise NotImplementedError

    def elements(self, vector: Column, name: str, state: Any) -> Column:
        """The same for every element of an array; a null array stays null."""
        return F.transform(vector, lambda v: self.each(v, name, state))

    def apply(
        self, df: DataFrame, state: Any, key: str | None = None, limits: Limits = Limits()
    ) -> DataFrame:
        lists = set(array_columns(df, self.columns))
        return df.withColumns(
            {c: (self.elements if c in lists else self.each)(F.col(c), c, state) for c in self.columns}
        )

    def spec(self) -> dict:
        return {"op": type(self).__name__, **asdict(self)}


@dataclass
class HexToInt32(Op):
    columns: Sequence[str]

    def each(self, value, name, state):
        return scalar.hex_to_int32(value)


@dataclass
class FillMissing(Op):
    columns: Sequence[str]
    value: float = 0

    def each(self, value, name, state):
        return scalar.fill_missing(value, self.value)


@dataclass
class Clip(Op):
    columns: Sequence[str]
    low: float | None = None
    high: float | None = None

    def each(self, value, name, state):
        return scalar.clip(value, self.low, self.high)


@dataclass
class Log1p(Op):
    columns: Sequence[str]

    def each(self, value, name, state):
        return scalar.log1p(value)


@dataclass
class Bucketize(Op):
    columns: Sequence[str]
    edges: Sequence[float]

    def each(self, value, name, state):
        return scalar.bucketize(value, self.edges)


@dataclass
class Normalize(Op):
    """State: column -> [mean, std], a handful of numbers that become literals.

    For an array column both are lists, one number per position. A position that the fitted rows
    do not have is left as it is.
    """

    columns: Sequence[str]

    @property
    def fitted(self):
        return True

    def fit(self, df):
        lists = array_columns(df, self.columns)
        single = [c for c in self.columns if c not in lists]
        state: dict = {r["col"]: [r["mean"], r["std"]] for r in moments(df, single).collect()} if single else {}
        if lists:
            rows = moments_by_position(df, lists).orderBy("col", "pos").collect()  # one row per position
            for c in lists:
                own = [r for r in rows if r["col"] == c]
                state[c] = [[r["mean"] for r in own], [r["std"] for r in own]]
        return state

    def each(self, value, name, state):
        return scalar.normalize(value, *state[name]).cast("float")

    def elements(self, vector, name, state):
        means, stds = (F.array(*[F.lit(x).cast("double") for x in numbers]) for numbers in state[name])
        centre = lambda i: F.coalesce(F.get(means, i), F.lit(0.0))
        scale = lambda i: F.coalesce(F.nullif(F.get(stds, i), F.lit(0.0)), F.lit(1.0))
        return F.transform(vector, lambda v, i: ((v.cast("double") - centre(i)) / scale(i)).cast("float"))


@dataclass
class Impute(Op):
    """Fill nulls with a constant, the mean or the median of the fitted split."""

    columns: Sequence[str]
    strategy: str = "mean"
    value: float | None = None

    @property
    def fitted(self):
        return self.strategy != "constant"

    def fit(self, df):
        columns = list(self.columns)
        if self.strategy == "constant":
            return None
        if self.strategy == "mean":
            return {r["col"]: r["mean"] for r in moments(df, columns).collect()}
        if self.strategy == "median":
            return {r["col"]: r["value"] for r in quantiles(df, columns, [0.5]).collect()}
        raise ValueError(f"unknown imputation strategy: {self.strategy!r}")

    def each(self, value, name, state):
        return scalar.fill_missing(
            value.cast("double"), self.value if state is None else state.get(name)
        )


@dataclass
class MissingFlag(Op):
    """Add `<column><suffix>`: 1 where the column is null."""

    columns: Sequence[str]
    suffix: str = "_missing"

    @property
    def writes(self):
        return {c + self.suffix for c in self.columns}

    def apply(self, df, state, key=None, limits=Limits()):
        return df.withColumns({c + self.suffix: scalar.missing_flag(F.col(c)) for c in self.columns})


@dataclass
class DateParts(Op):
    columns: Sequence[str]

    @property
    def writes(self):
        return {f"{c}_{p}" for c in self.columns for p in ("dayofweek", "month", "dayofmonth")}

    def apply(self, df, state, key=None, limits=Limits()):
        parts = [p for c in self.columns for p in scalar.date_parts(F.col(c), c)]
        return df.select("*", *parts)


@dataclass
class Cross(Op):
    """Add one text column combining several; encode it with a following Categorify."""

    columns: Sequence[str]
    name: str = "cross"

    @property
    def writes(self):
        return {self.name}

    def apply(self, df, state, key=None, limits=Limits()):
        return df.withColumn(self.name, scalar.cross([F.col(c) for c in self.columns]))


@dataclass
class OneHot(Op):
    """Add a 0/1 column per listed category."""

    columns: Sequence[str]
    categories: Sequence[Any] = ()

    @property
    def writes(self):
        return {f"{c}_{k}" for c in self.columns for k in self.categories}

    def apply(self, df, state, key=None, limits=Limits()):
        added = [h for c in self.columns for h in scalar.one_hot(F.col(c), self.categories, c)]
        return df.select("*", *added)


@dataclass
class FilterRange(Op):
    """Keep rows whose columns lie within the bounds; nulls are kept on request."""

    columns: Sequence[str]
    low: float | None = None
    high: float | None = None
    keep_null: bool = False

    def apply(self, df, state, key=None, limits=Limits()):
        for c in self.columns:
            inside = F.col(c).isNotNull()
            if self.low is not None:
                inside = inside & (F.col(c) >= F.lit(self.low))
            if self.high is not None:
                inside = inside & (F.col(c) <= F.lit(self.high))
            df = df.where(inside | F.col(c).isNull() if self.keep_null else inside)
        return df


@dataclass
class DropMissing(Op):
    """Keep rows in which none of the columns is null."""

    columns: Sequence[str]

    def apply(self, df, state, key=None, limits=Limits()):
        return df.dropna(subset=list(self.columns))


@dataclass
class Categorify(Op):
    """Frequency codes; state: a Vocabulary in the shared folder."""

    columns: Sequence[str]
    max_size: int | None = None

    @property
    def fitted(self):
        return True

    def fit(self, df):
        return Vocabulary.fit(df, list(self.columns), self.max_size)

    def apply(self, df, state, key=None, limits=Limits()):
        return state.encode(df, None, key, limits)


@dataclass
class MultiHotCategorify(Op):
    """Codes of one array column, all of them or at most `nnz` per row. Needs a row key."""

    columns: Sequence[str]
    nnz: int | None = None
    max_size: int | None = None
    limits: Limits = field(default=Limits(), repr=False)

    @property
    def fitted(self):
        return True

    def fit(self, df):
        return fit_lists(df, self.columns[0], self.max_size)

    def apply(self, df, state, key=None, limits=Limits()):
        if key is None:
            raise ValueError("multi-hot encoding needs a row key")
        return encode_lists(df, state, self.columns[0], key, self.nnz, limits)

    def spec(self):
        return {
            "op": "MultiHotCategorify",
            "columns": list(self.columns),
            "nnz": self.nnz,
            "max_size": self.max_size,
        }


ALL_OPS = {
    c.__name__: c
    for c in (
        HexToInt32,
        FillMissing,
        Clip,
        Log1p,
        Bucketize,
        Normalize,
        Impute,
        MissingFlag,
        DateParts,
        Cross,
        OneHot,
        FilterRange,
        DropMissing,
        Categorify,
        MultiHotCategorify,
    )
}
