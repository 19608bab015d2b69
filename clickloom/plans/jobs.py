"""End-to-end jobs, composed of the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.model.deepfm import DeepFM
from clickloom.model.search import best_trial, search
from clickloom.model.training import Settings, evaluate, log_table, train_deepfm
from clickloom.operators.profile import label_counts, label_percent, preview, row_counts
from clickloom.plans.workflow import FittedWorkflow, Workflow, click_workflow
from clickloom.schema import ROW_KEY, categorical_columns, continuous_columns, rename_scheme, table_schema
from clickloom.sources.scans import (
    decode_categoricals,
    read_cardinalities,
    scan_checked,
    scan_delimited,
    scan_manifest,
    scan_parquet,
    scan_table,
    split_checked,
    with_row_key,
)
from clickloom.sources.sinks import (
    export_table,
    load_table,
    split_path,
    write_manifest,
    write_sidecar,
    write_split,
)
from clickloom.storage import materialize

TRAIN, VALID = "train", "valid"


@dataclass(frozen=True)
class Prepared:
    """Where a preprocessing job left its data."""

    fitted: FittedWorkflow
    workflow_dir: str
    train_dir: str
    valid_dir: str


def _prepare(
    spark: SparkSession, splits: dict[str, DataFrame], out: str, workflow: Workflow, shuffle, files
) -> Prepared:
    """Fit on train, transform both splits, write data with manifest and schema table."""
    fitted = workflow.fit(splits[TRAIN], ROW_KEY)
    workflow_dir = f"{out}/workflow"
    fitted.save(workflow_dir)
    fitted = FittedWorkflow.load(spark, workflow_dir, workflow.limits)
    dirs = {}
    for split, df in splits.items():
        done = fitted.transform(df, ROW_KEY)
        dirs[split] = write_split(
            done, f"{out}/transformed", split, (files or {}).get(split), shuffle, key=ROW_KEY
        )
        write_sidecar(done, dirs[split], fitted.cardinalities())
        write_manifest(spark, dirs[split])
    return Prepared(fitted, workflow_dir, dirs[TRAIN], dirs[VALID])


def preprocess_files(
    spark: SparkSession,
    train_paths: Sequence[str],
    valid_paths: Sequence[str],
    out: str,
    sep: str = "\t",
    recursive: bool = False,
    files: dict[str, int] | None = None,
    shuffle: str | None = None,
    workflow: Workflow | None = None,
) -> Prepared:
    """Delimited files to Parquet with row keys, then fit and transform."""
    splits = {}
    for split, paths in ((TRAIN, train_paths), (VALID, valid_paths)):
        raw = with_row_key(decode_categoricals(scan_delimited(spark, paths, sep, recursive)))
        path = write_split(
            raw, f"{out}/converted", split, (files or {}).get(split), shuffle, key=ROW_KEY
        )
        splits[split] = scan_parquet(spark, path)
    return _prepare(spark, splits, out, workflow or click_workflow(), shuffle, files)


def preprocess_tables(
    spark: SparkSession,
    train_table: str,
    valid_table: str,
    out: str,
    files: dict[str, int] | None = None,
    shuffle: str | None = None,
    workflow: Workflow | None = None,
) -> Prepared:
    """Tables to Parquet, then fit and transform; categoricals stay text."""
    splits = {}
    for split, table in ((TRAIN, train_table), (VALID, valid_table)):
        exported = split_path(f"{out}/exported", split)
        export_table(spark, table, exported)
        keyed = with_row_key(rename_scheme(scan_parquet(spark, exported), "file"))
        path = write_split(keyed, f"{out}/converted", split)
        splits[split] = scan_parquet(spark, path)
    return _prepare(spark, splits, out, workflow or click_workflow(), shuffle, files)


def load_and_validate(
    spark: SparkSession, paths: dict[str, Sequence[str]], tables: dict[str, str], sep: str = "\t"
) -> dict[str, DataFrame]:
    """Load each split's good lines into its table; row counts, label shares, a preview and the rejects.

    Lines are read under the table's own 64-bit types. `rejected` has `(split, file, line, reason)` of
    the lines left out.
    """
    rejected = None
    for split, files in paths.items():
        checked = materialize(scan_checked(spark, files, sep, schema=table_schema()), f"checked-{split}")
        rows, lost = split_checked(checked)
        load_table(rows, tables[split])
        lost = lost.select(F.lit(split).alias("split"), "*")
        rejected = lost if rejected is None else rejected.unionByName(lost)
    train = scan_table(spark, tables[TRAIN])
    counted = None
    for split, name in tables.items():
        part = spark.sql("SELECT :split AS split FROM {t}", args={"split": split}, t=spark.table(name))
        counted = part if counted is None else counted.unionByName(part)
    return {
        "row_counts": row_counts(counted),
        "label_counts": label_counts(train),
        "label_percent": label_percent(train),
        "preview": preview(train, *train.columns),
        "rejected": rejected,
    }


def train_prepared(
    spark: SparkSession, prepared: Prepared, settings: Settings, model_dir: str
) -> tuple[DeepFM, DataFrame, float | None]:
    """Train from written splits, save the model, evaluate it on the validation split."""
    train, valid = scan_manifest(spark, prepared.train_dir), scan_manifest(spark, prepared.valid_dir)
    slots = list(read_cardinalities(spark, prepared.train_dir))
    model, log = train_deepfm(
        train, prepared.fitted.vocabulary(), slots, continuous_columns(), ROW_KEY, settings, valid
    )
    model.save(model_dir)
    return model, log_table(spark, log), evaluate(valid, model, ROW_KEY, settings)


def tune_prepared(
    spark: SparkSession, prepared: Prepared, settings: Settings, **choices
) -> tuple[DataFrame, DataFrame]:
    """`(trials, best)` of a search over written splits."""
    trials = search(
        scan_manifest(spark, prepared.train_dir),
        scan_manifest(spark, prepared.valid_dir),
        prepared.fitted.vocabulary(),
        categorical_columns(),
        continuous_columns(),
        ROW_KEY,
        settings,
        **choices,
    )
    return trials, best_trial(trials)


def train_from_tables(
    spark: SparkSession, train_table: str, valid_table: str, out: str, settings: Settings
) -> tuple[Prepared, DeepFM, float | None]:
    """Tables to a saved, evaluated model with its workflow beside it."""
    prepared = preprocess_tables(spark, train_table, valid_table, out)
    model, _, quality = train_prepared(spark, prepared, settings, f"{out}/model")
    return prepared, model, quality


def load_package(spark: SparkSession, out: str) -> tuple[FittedWorkflow, DeepFM]:
    """Workflow and model of a finished job: what scoring raw records needs."""
    return FittedWorkflow.load(spark, f"{out}/workflow"), DeepFM.load(spark, f"{out}/model")
