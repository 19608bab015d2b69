import pytest
from pyspark.sql import functions as F

from clickloom.operators.lookup import Limits
from clickloom.plans.jobs import (
    load_and_validate,
    load_package,
    preprocess_files,
    preprocess_tables,
    train_prepared,
)
from clickloom.catalog.clicks import clicks
from clickloom.model.training import Settings
from clickloom.plans.ops import Categorify, Clip, Cross, FillMissing, MissingFlag, Normalize
from clickloom.plans.workflow import FittedWorkflow, Workflow
from clickloom.schema import (
    ROW_KEY,
    categorical_columns,
    columns_named,
    columns_tagged,
    continuous_columns,
    raw_schema,
    rename_scheme,
    table_schema,
    with_roles,
)
from clickloom.sources.scans import (
    read_cardinalities,
    read_manifest,
    scan_delimited,
    scan_manifest,
    scan_parquet,
    union_days,
)
from conftest import SMALL


def small(**options):
    cats, conts = ["C1", "C2", "C9"], ["I1", "I2"]
    return Workflow(
        [FillMissing(conts, 0), Clip(conts, low=0), Normalize(conts), Categorify(cats)],
        [*cats, *conts, "label"],
        **options,
    )


@pytest.fixture(scope="module")
def view(spark):
    return clicks(spark, SMALL).cache()


@pytest.fixture(scope="module")
def raw(spark, view, tmp_path_factory):
    """Tab-separated files, one per day, written from the view."""
    root = tmp_path_factory.mktemp("raw")
    for day in (0, 1, 2):
        names = ["label", *continuous_columns(), *categorical_columns()]
        rows = view.where(F.col("day") == day).select(*names).collect()
        lines = ["\t".join("" if v is None else str(v) for v in r) for r in rows]
        (root / f"day_{day}").write_text("\n".join(lines) + "\n")
    return str(root)


def test_train_is_centred_and_scaled_and_valid_does_not_matter(spark, view):
    train, valid = view.where("day < 23"), view.where("day >= 23")
    fitted = small().fit(train)
    got = fitted.transform(train).agg(F.avg("I1"), F.stddev_samp("I1")).collect()[0]
    assert got[0] == pytest.approx(0, abs=1e-6) and got[1] == pytest.approx(1, abs=1e-6)
    done = fitted.transform(valid, "event_id")
    assert done.columns == ["C1", "C2", "C9", "I1", "I2", "label", "event_id"]
    assert dict(done.dtypes)["C1"] == "bigint" and dict(done.dtypes)["I1"] == "float"
    assert valid.count() == done.count()


def test_saved_workflow_transforms_alike_on_either_join(spark, view, tmp_path):
    fitted = small().fit(view.where("day < 23"))
    fitted.save(str(tmp_path / "w"))
    limits = Limits(column_bytes=300, total_bytes=600, head_entries=3, hot_rows=20)
    again = FittedWorkflow.load(spark, str(tmp_path / "w"), limits)
    assert again.cardinalities() == fitted.cardinalities()
    one, two = fitted.transform(view, "event_id"), again.transform(view, "event_id")
    assert one.exceptAll(two).isEmpty() and one.count() == two.count()


def test_dependent_stages_are_fitted_in_order(spark, view):
    made = Workflow(
        [Cross(["C1", "C2"], "X"), MissingFlag(["I1"]), Categorify(["X"])], ["X", "I1_missing"]
    )
    fitted = made.fit(view)
    assert fitted.cardinalities()["X"] == view.where("C1 IS NOT NULL AND C2 IS NOT NULL").select(
        "C1", "C2"
    ).distinct().count() + 1


def test_scan_skips_missing_and_keeps_malformed_as_null(spark, tmp_path):
    good = tmp_path / "day_0"
    width = len(raw_schema())
    good.write_text("\t".join(["1", "x7", "-3"] + [""] * (width - 3)) + "\n")
    with pytest.warns(UserWarning):
        row = scan_delimited(spark, [str(good), str(tmp_path / "none")]).collect()[0]
    assert (row["label"], row["I1"], row["I2"], row["C26"]) == (1, None, -3, None)
    with pytest.raises(FileNotFoundError):
        scan_delimited(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        scan_parquet(spark, str(tmp_path))


def test_directory_scan_depth(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    line = "\t".join(["1"] + [""] * (len(raw_schema()) - 1)) + "\n"
    (tmp_path / "a").write_text(line)
    (tmp_path / "sub" / "b").write_text(line)
    assert scan_delimited(spark, str(tmp_path)).count() == 1
    assert scan_delimited(spark, str(tmp_path), recursive=True).count() == 2


def test_names_roles_and_union(spark, view):
    table = rename_scheme(view, "table")
    assert len(columns_named(table, "cat")) == 26
    assert table_schema()["cat_feature_3"].dataType.simpleString() == "string"
    assert rename_scheme(table, "file").columns == view.columns
    tagged = with_roles(view, {"C1": 4})
    assert columns_tagged(tagged, "categorical") == categorical_columns()
    assert tagged.schema["C1"].metadata["cardinality"] == 4
    parts = [view.where(F.col("day") == d) for d in (0, 1)]
    assert union_days(parts).count() == view.where("day < 2").count()
    with pytest.raises(ValueError):
        rename_scheme(view, "other")


def test_file_job_leaves_data_manifest_and_side_table(spark, view, raw, tmp_path):
    done = preprocess_files(
        spark,
        [f"{raw}/day_0", f"{raw}/day_1"],
        [f"{raw}/day_2"],
        str(tmp_path),
        files={"train": 3, "valid": 1},
        shuffle="FULL",
    )
    files = read_manifest(spark, done.train_dir)
    train = scan_manifest(spark, done.train_dir)
    assert files.count() == 3 and train.count() == view.where("day < 2").count()
    assert train.select(ROW_KEY).distinct().count() == train.count()
    sizes = read_cardinalities(spark, done.valid_dir)
    assert list(sizes) == categorical_columns()
    assert sizes["C2"] == view.where("day < 2").select("C2").dropna().distinct().count() + 1


def test_tables_to_model(spark, raw, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS clickjobs LOCATION '{tmp_path}/db'")
    reports = load_and_validate(
        spark,
        {"train": [f"{raw}/day_0", f"{raw}/day_1"], "valid": [f"{raw}/day_2"]},
        {"train": "clickjobs.train", "valid": "clickjobs.valid"},
    )
    assert {r["split"] for r in reports["row_counts"].collect()} == {"train", "valid"}
    assert reports["preview"].count() == 10
    prepared = preprocess_tables(spark, "clickjobs.train", "clickjobs.valid", str(tmp_path))
    settings = Settings(batch_rows=1000, hidden=(4,), epochs=0, max_iter=2, dropout=0.0)
    model, log, quality = train_prepared(spark, prepared, settings, f"{tmp_path}/model")
    assert log.count() == 2 and 0.0 <= quality <= 1.0
    fitted, loaded = load_package(spark, str(tmp_path))
    assert loaded.slots == model.slots and fitted.outputs[-1] == "label"
