from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest

from tallgrove.functions import routines
from tallgrove.operators import scoring as sc
from tallgrove.sources import features as ft
from tallgrove.sources.registry import BOOSTED, COLUMNS, FOREST, TREE, Registry
from tallgrove.sources.tables import append, hash_partitioned, refill, register

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture
def registry(spark, tmp_path):
    return Registry.create(spark, str(tmp_path / "registry"))


def test_save_load_and_list(spark, registry, forest, churn):
    assert registry.versions().isEmpty()
    registry.save("CHURN", "1.1", FOREST, forest.model_rows, NOW)
    assert registry.table().columns == COLUMNS
    back = registry.load("CHURN", 1.1, FOREST)
    assert back.exceptAll(forest.model_rows).isEmpty() and back.count() == forest.model_rows.count()
    before = sc.score(churn, forest.model, ft.ID)
    assert before.exceptAll(sc.score(churn, back, ft.ID)).isEmpty()
    version = registry.versions("CHURN").collect()
    assert [tuple(r) for r in version] == [("CHURN", 1.1, FOREST, NOW.date(), "07:08:09")]
    assert registry.versions("CHURN", above=99).isEmpty()
    # A string compares with the version as a number.
    assert registry.table().filter("MODEL_VERSION = '1.1'").count() == back.count()


def test_columns_a_layout_lacks_are_null(spark, registry):
    rows = spark.createDataFrame([(0, "header", "x"), (1, "tree_0", "y")], "ROW_INDEX int, KEY string, VALUE string")
    registry.save("M", 1.2, BOOSTED, rows, NOW)
    stored = registry.table().collect()
    assert all(r["TREE_INDEX"] is None and r["MODEL_CONTENT"] is None for r in stored)
    assert registry.load("M", 1.2, BOOSTED).columns == ["ROW_INDEX", "KEY", "VALUE"]
    assert registry.load("M", 1.2, TREE).columns == ["ROW_INDEX", "MODEL_CONTENT"]


def test_a_version_is_saved_once(registry, forest):
    registry.save("CHURN", 1.1, FOREST, forest.model_rows)
    with pytest.raises(ValueError, match="already saved"):
        registry.save("CHURN", "1.1", FOREST, forest.model_rows)
    registry.save("CHURN", "1.1", TREE, forest.model_rows)


def test_concurrent_saves_commit_once(registry, forest):
    """Both savers see no version and write their rows; one commit fails and leaves nothing behind."""
    folders = [registry.stage("CHURN", 1.1, FOREST, forest.model_rows, NOW) for _ in range(2)]
    assert registry.versions().isEmpty()
    registry.commit("CHURN", 1.1, FOREST, folders[0])
    with pytest.raises(ValueError, match="already saved"):
        registry.commit("CHURN", "1.10", FOREST, folders[1])
    assert registry.load("CHURN", 1.1, FOREST).count() == forest.model_rows.count()
    assert registry.table().count() == forest.model_rows.count()


def test_threads_that_save_one_version(registry, forest):
    with ThreadPoolExecutor(4) as pool:
        runs = [pool.submit(registry.save, "A/B =1", 2, TREE, forest.model_rows) for _ in range(4)]
    assert sorted(r.exception() is None for r in runs) == [False, False, False, True]
    assert registry.load("A/B =1", 2.0, TREE).count() == forest.model_rows.count()


def test_champion(registry, forest, spark):
    other = spark.createDataFrame([(0, "header", "x")], "ROW_INDEX int, KEY string, VALUE string")
    assert registry.save_champion("CHURN", "b", (FOREST, forest.model_rows), (BOOSTED, other)) == BOOSTED
    assert [r["MODEL_TYPE"] for r in registry.versions(above=99).collect()] == [BOOSTED]


def test_loading_reads_only_its_partition(registry, forest):
    registry.save("CHURN", 1.1, FOREST, forest.model_rows)
    registry.save("CHURN", 1.2, FOREST, forest.model_rows)
    files = registry.load("CHURN", 1.1, FOREST).inputFiles()
    assert files and all("/rows/CHURN=1.1=RDT-" in f for f in files)
    assert len(registry.table().inputFiles()) == 2 * len(files)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_function_procedure_and_wrapper_agree(spark, churn, forest):
    register(churn.drop(ft.LABEL), "accounts")
    routines.register_scoring_tvf(spark, "predict_all", "accounts", forest.model, ft.ID)
    routines.register_scoring_tvf(spark, "predict_one", "accounts", forest.model, ft.ID, "ip_id")
    procedure = routines.scoring_procedure(churn, forest.model, ft.ID)
    routines.register_wrapper(spark, "predict_wrapper", procedure)
    everything = rows(procedure)
    assert rows(spark.sql("SELECT * FROM predict_all()")) == everything
    assert rows(spark.sql("SELECT * FROM predict_wrapper()")) == everything
    one = spark.sql("SELECT * FROM predict_one(7)")
    assert rows(one) == [r for r in everything if r[0] == 7]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(AccountID,7)" in plan


def test_introspection_and_scripting(spark, churn, forest):
    register(churn, "accounts")
    routines.register_scoring_tvf(spark, "predict_one", "accounts", forest.model, ft.ID, "ip_id")
    text = "\n".join(r[0] for r in routines.describe_routine(spark, "predict_one").collect())
    assert "ip_id" in text and "PRED_CONFIDENCE" in text
    assert any(f.name == "predict_one" for f in spark.catalog.listFunctions())
    result = spark.sql("""
        BEGIN
          DECLARE wanted BIGINT;
          SET wanted = (SELECT min(AccountID) FROM accounts);
          SELECT * FROM predict_one(wanted);
        END
    """)
    assert result.columns == ["ACCOUNTID", "PREDICTION", "PRED_CONFIDENCE"] and result.count() == 1


def test_boosted_model_as_function(spark, churn):
    from tallgrove.operators.training import train_boosted

    params = {"HAS_ID": 1, "DEPENDENT_VARIABLE": ft.LABEL, "ITER_NUM": 3, "MAX_TREE_DEPTH": 3}
    model = train_boosted(churn, params).model
    register(churn, "accounts")
    routines.register_scoring_tvf(spark, "predict_boosted", "accounts", model, ft.ID)
    mine = {r[0]: r for r in spark.sql("SELECT * FROM predict_boosted()").collect()}
    for r in sc.score(churn, model, ft.ID).collect():
        assert mine[r[0]][1] == r[1] and mine[r[0]][2] == pytest.approx(r[2], abs=1e-12)


def test_model_state(spark, churn, forest):
    handle = routines.load_state(forest.model_rows, {"ALGORITHM": 2, "STATE_DESCRIPTION": "churn 1.1"})
    assert routines.find_state("churn 1.1") is handle
    listed = {r["STATE_ID"]: r["DESCRIPTION"] for r in routines.states(spark).collect()}
    assert listed[handle.state_id] == "churn 1.1"
    scored = routines.score_with_params(churn, None, {"STATE_ID": handle.state_id, "VERBOSE": 0}, ft.ID)
    assert rows(scored) == rows(sc.score(churn, forest.model, ft.ID))
    verbose = routines.score_with_params(churn, forest.model_rows, {"VERBOSE": 1}, ft.ID)
    assert verbose.count() == 2 * churn.count()
    routines.drop_state(handle.state_id)
    with pytest.raises(ValueError, match="no model state"):
        routines.score_with_params(churn, None, {"STATE_ID": handle.state_id}, ft.ID)
    with pytest.raises(ValueError, match="0 model states"):
        routines.find_state("churn 1.1")


def test_partitioned_scoring_changes_nothing(churn, forest):
    parts = hash_partitioned(churn, ft.ID, 8)
    assert parts.rdd.getNumPartitions() == 8
    assert rows(sc.score(parts, forest.model, ft.ID)) == rows(sc.score(churn, forest.model, ft.ID))


def test_refill_then_append(spark, tmp_path):
    path = str(tmp_path / "result")
    assert refill(spark.range(5), path).count() == 5
    assert refill(spark.range(3), path).count() == 3
    assert append(spark.range(4), path).count() == 7
