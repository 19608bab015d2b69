"""Fit on one split, apply to any: an ordered list of feature operators."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.lookup import Limits
from clickloom.operators.vocab import Vocabulary
from clickloom.plans.ops import ALL_OPS, Categorify, Clip, FillMissing, Normalize, Op
from clickloom.schema import (
    as_transformed_types,
    categorical_columns,
    continuous_columns,
    label_columns,
)
from clickloom.storage import read_text, write_text


def _needed(stages: Sequence[Op], upto: int) -> list[int]:
    """Earlier stages that the columns of stage `upto` depend on.

    A stage that removes rows matters to every later one.
    """
    wanted = set(stages[upto].reads)
    chosen = []
    for i in range(upto - 1, -1, -1):
        filters = type(stages[i]).__name__ in ("FilterRange", "DropMissing")
        if filters or stages[i].writes & wanted:
            chosen.append(i)
            wanted |= stages[i].reads
    return chosen[::-1]


@dataclass
class FittedWorkflow:
    stages: Sequence[Op]
    states: list[Any]
    outputs: Sequence[str]
    limits: Limits = Limits()

    def transform(
        self, df: DataFrame, key: str | None = None, keep: Sequence[str] = (), coded: bool = True
    ) -> DataFrame:
        """Apply all stages; `key` and `keep` columns ride along behind the outputs.

        Without `coded` the columns of `only_coded` stay as they come.

        An output the frame lacks (the label, in scoring) is left out.
        """
        before = set(df.columns)
        made = set().union(*[s.writes for s in self.stages]) | before
        raw = set() if coded else self.only_coded()
        for stage, state in zip(self.stages, self.states):
            if not (isinstance(stage, Categorify) and stage.writes <= raw):
                df = stage.apply(df, state, key, self.limits)
        names = [c for c in self.outputs if c in made and c in df.columns]
        names += [c for c in ([key] if key else []) + list(keep) if c not in names]
        return as_transformed_types(df.select(*names), raw)

    def only_coded(self) -> set[str]:
        """Columns of frequency codings whose columns no other stage touches."""
        out: set[str] = set()
        for i, stage in enumerate(self.stages):
            others = self.stages[:i] + self.stages[i + 1 :]
            used = set().union(*[s.reads | s.writes for s in others])
            if isinstance(stage, Categorify) and not stage.writes & used:
                out |= stage.writes
        return out

    def vocabulary(self) -> DataFrame:
        """Values and codes of every encoded column."""
        tables = [s.table for s in self.states if isinstance(s, Vocabulary)]
        out = tables[0]
        for table in tables[1:]:
            out = out.unionByName(table)
        return out

    def cardinalities(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for state in self.states:
            if isinstance(state, Vocabulary):
                out.update(state.cardinalities())
        return out

    def save(self, directory: str) -> None:
        """Vocabularies as Parquet by column, everything small as JSON."""
        spark = None
        specs = []
        for i, (stage, state) in enumerate(zip(self.stages, self.states)):
            spec: dict = {"stage": stage.spec()}
            if isinstance(state, Vocabulary):
                spark = state.table.sparkSession
                state.table.write.mode("overwrite").partitionBy("col").parquet(
                    f"{directory}/vocab/stage_{i}"
                )
                spec["vocab"] = {
                    "columns": state.columns,
                    "type": state.table.schema["value"].dataType.simpleString(),
                }
            else:
                spec["state"] = state
            specs.append(spec)
        spark = spark or SparkSession.getActiveSession()
        body = {"outputs": list(self.outputs), "stages": specs}
        write_text(spark, f"{directory}/spec.json", json.dumps(body))

    @staticmethod
    def load(spark: SparkSession, directory: str, limits: Limits = Limits()) -> "FittedWorkflow":
        body = json.loads(read_text(spark, f"{directory}/spec.json"))
        stages, states = [], []
        for i, spec in enumerate(body["stages"]):
            given = dict(spec["stage"])
            stages.append(ALL_OPS[given.pop("op")](**given))
            if "vocab" in spec:
                schema = f"value {spec['vocab']['type']}, n bigint, code bigint, col string"
                table = spark.read.schema(schema).parquet(f"{directory}/vocab/stage_{i}")
                states.append(
                    Vocabulary.of(
                        table.select("col", "value", "n", "code"), spec["vocab"]["columns"]
                    )
                )
            else:
                states.append(spec["state"])
        return FittedWorkflow(stages, states, body["outputs"], limits)


@dataclass
class Workflow:
    stages: Sequence[Op]
    outputs: Sequence[str]
    limits: Limits = field(default=Limits())

    def fit(self, df: DataFrame, key: str | None = None) -> FittedWorkflow:
        """Learn the state of each stage on the output of the stages it depends on."""
        states: list[Any] = [None] * len(self.stages)
        for i, stage in enumerate(self.stages):
            if stage.fitted:
                seen = df
                for j in _needed(self.stages, i):
                    seen = self.stages[j].apply(seen, states[j], key, self.limits)
                states[i] = stage.fit(seen)
        return FittedWorkflow(self.stages, states, self.outputs, self.limits)


def click_workflow(max_size: int | None = None, limits: Limits = Limits()) -> Workflow:
    """The click-log workflow: coded categoricals; filled, clipped, normalized counts; label.

    The arithmetic comes first: it then runs before the chain of lookups, in a generated
    function of its own, small enough for the JVM to compile.
    """
    cats, conts = categorical_columns(), continuous_columns()
    return Workflow(
        [FillMissing(conts, 0), Clip(conts, low=0), Normalize(conts), Categorify(cats, max_size)],
        [*cats, *conts, *label_columns()],
        limits,
    )
