import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as registry
from compare import connect, difference
from conftest import SMALL

from clickloom.catalog.clicks import clicks
from clickloom.catalog.features import int_clicks
from clickloom.storage import short_methods

QUICK = [
    "label_percent",
    "describe",
    "preview_transposed",
    "vocab_topn",
    "unseen_values",
    "workflow_valid",
    "impute_median",
    "multi_hot",
    "csv_missing_path",
    "sidecar",
    "embedding_sum",
    "score_table",
    "auc",
    "eval_capped",
    "categorify_tail",
    "embedding_sum_tail",
    "score_raw",
    "auc_nulls",
    "batch_sizes",
    "shuffle_checks",
    "rejected_all_reasons",
    "table_types",
    "csv_rejects",
    "csv_accepted",
    "load_large_values",
    "sampled_read",
    "manifest_of_some",
    "rejected_text",
    "vocab_mixed",
    "vector_normalize",
    "multi_hot_cut",
    "auc_by_day",
    "sparse_features",
]


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() == 207


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SMALL), SMALL, name) is None


def test_view_is_dealt_out_and_derived_once(spark):
    dealt = clicks(spark, SMALL)._jdf.queryExecution().toString()
    assert "REPARTITION_BY_COL" in dealt  # not as many tasks as the file has splits
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    rows = int_clicks(spark, SMALL)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
    assert rows.inputFiles() and not any("events.parquet" in f for f in rows.inputFiles())


def test_setting_for_short_methods_is_given_back_after_a_failure(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), short_methods(spark):
        assert spark.conf.get(name) == "8000"
        raise RuntimeError
    assert spark.conf.get(name) == before
