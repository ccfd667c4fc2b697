"""What the plans of the large steps may and may not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import CHECK
from tallgrove.operators import evaluation as ev
from tallgrove.operators.sampling import stratified_folds, stratified_partition
from tallgrove.operators.scoring import score
from tallgrove.plans import given_splits as gs
from tallgrove.sources import features as ft


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Make Spark treat the test tables as too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_feature_view_shuffles_each_side_once(large):
    plan = plan_of(ft.churn_view(large, CHECK))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in plan and "SinglePartition" not in plan
    assert "partial_sum" in plan  # facts are added up before the shuffle


def test_feature_view_reads_only_what_it_needs(large):
    narrow = ft.churn_view(large, CHECK).select(ft.ID, ft.LABEL)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(narrow))
    assert any(s.replace(",", " ").split() == ["o_custkey:bigint", "o_orderdate:timestamp_ntz"] for s in schemas)


def test_splits_move_no_rows(large, churn):
    for parts in (
        stratified_partition(churn, ft.ID, ft.LABEL, check_ids=False, keep_columns=True),
        stratified_folds(churn, ft.ID, ft.LABEL, 10, 1, check_ids=False),
    ):
        plan = plan_of(parts)
        assert "hashpartitioning" not in plan and "Window" not in plan and "LocalTableScan" in plan


def test_scoring_moves_no_rows(large, churn, forest):
    for engine in ("arrays", "expression"):
        plan = plan_of(score(churn, forest.model, ft.ID, engine=engine))
        assert "Exchange" not in plan


def test_small_models_run_in_the_jvm(large):
    model = gs.model(large, CHECK)
    plan = plan_of(score(gs.feature_table(large, CHECK), model, ft.ID))
    assert "Python" not in plan and "Exchange" not in plan


def test_scoring_reads_only_the_models_columns(large):
    plan = plan_of(score(gs.feature_table(large, CHECK), gs.model(large, CHECK), ft.ID))
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert "Device_Lifetime" not in read and "Revenue_Month#" in read


def test_matrix_collapses_before_the_shuffle(large, churn):
    rows = churn.select(F.col(ft.LABEL).alias("ORIGINAL_LABEL"), F.col(ft.LABEL).alias("PREDICTED_LABEL"))
    plan = plan_of(ev.confusion_matrix(rows))
    assert "partial_count" in plan and "Window" not in plan and "CartesianProduct" not in plan


def test_no_cross_join_in_the_library():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "tallgrove"
    for path in root.rglob("*.py"):
        text = path.read_text()
        if path.name == "oracle.py":
            continue
        for word in ("crossJoin", "localCheckpoint", ".rdd", "broadcast(F", "F.broadcast"):
            assert word not in text, f"{word} in {path}"


def test_bucketed_split_moves_no_row(spark):
    import __spark_entry__ as contract

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = contract.queries()["split_bucketed"](spark, CHECK)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
