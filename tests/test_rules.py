"""Rules that must not depend on a model's size, a relation's size or a session's settings."""

from __future__ import annotations

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallgrove.functions import routines
from tallgrove.functions.params import Params
from tallgrove.operators import evaluation as ev
from tallgrove.operators import payloads as pl
from tallgrove.operators import scoring as sc
from tallgrove.operators import training as tr
from tallgrove.operators.forecasting import ses_forecast
from tallgrove.operators.nodes import export_nodes
from tallgrove.operators.sampling import exact_share, stratified_partition
from tallgrove.sources import features as ft
from tallgrove.sources.model_rows import chunk, encode, unchunk

BASE = {"HAS_ID": 1, "DEPENDENT_VARIABLE": ft.LABEL, "SEED": 2}


def test_tree_groups_need_no_key(churn, forest):
    twice = churn.unionByName(churn)
    parts = sc.load_model(forest.model_rows, broadcast_chars=3000)
    assert len(parts.parts) > 2
    split, whole = sc.score(twice, parts, ft.ID), sc.score(twice, forest.model, ft.ID)
    assert split.count() == 2 * churn.count()
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()


def test_training_matrix_of_tree_groups(churn, forest):
    want = sorted(map(tuple, forest.confusion_matrix.collect()))
    kept, forest._model = forest.model, sc.load_model(forest.model_rows, broadcast_chars=3000)
    got = sorted(map(tuple, tr.training_matrix(churn, forest, ft.LABEL).collect()))
    forest._model = kept
    assert got == want


def test_one_null_rule(spark, churn):
    """A NULL is an error on and off the trees' paths, for every engine, function and group size; a fill helps all alike."""
    prepared = tr.prepare(churn, Params.of(**BASE))
    header = prepared.header("tree")
    model = tr.tree_estimator(prepared, Params.of(**BASE), 2).fit(prepared.rows)
    rows = encode(header, export_nodes(model, header, spark))
    used = {n.get("FEATURE") for t in sc.load_model(rows).trees for n in t.nodes.values()}
    off = next(n for n, known in header.features if known is None and n not in used)
    on = next(n for n, known in header.features if known is None and n in used)
    for name in (on, off):
        holes = churn.withColumn(name, F.when(F.col(ft.ID) != 7, F.col(name)))
        holes.createOrReplaceTempView("holes")
        for engine in ("expression", "arrays"):
            with pytest.raises(Exception, match=f"NULL in feature {name}"):
                sc.score(holes, sc.load_model(rows), ft.ID, engine=engine).collect()
        routines.register_scoring_tvf(spark, "score_holes", "holes", sc.load_model(rows), ft.ID)
        with pytest.raises(Exception, match=f"NULL in feature {name}"):
            spark.sql("SELECT * FROM score_holes()").collect()
        filled = [sc.score(holes, sc.load_model(rows), ft.ID, engine=e, fill=0.0) for e in ("expression", "arrays")]
        assert filled[0].exceptAll(filled[1]).isEmpty()


def test_text_ids_in_functions(spark, churn, forest):
    text = churn.withColumn(ft.ID, F.concat(F.lit("id'"), F.col(ft.ID).cast("string")))
    routines.register_wrapper(spark, "text_ids", routines.scoring_procedure(text, forest.model, ft.ID))
    assert spark.sql("SELECT * FROM text_ids()").count() == churn.count()


def test_states_belong_to_their_session(spark, forest):
    handle = routines.load_state(forest.model_rows, {"STATE_DESCRIPTION": "mine"})
    assert routines.states(spark).filter(F.col("STATE_ID") == handle.state_id).count() == 1
    assert routines.states(spark.newSession()).count() == 0
    routines.drop_state(handle.state_id)


@pytest.mark.parametrize(
    "train,name", [(tr.train_forest, "MIN_RECORDS_OF_LEAF"), (tr.train_boosted, "TREES_NUM"), (tr.train_tree, "ITER_NUM")]
)
def test_names_of_another_task_are_errors(churn, train, name):
    with pytest.raises(ValueError, match=f"no parameter of .*{name}"):
        train(churn, {**BASE, name: 3})


def test_depth_comes_from_the_parameters(churn):
    for train, more in ((tr.train_forest, {"TREES_NUM": 3}), (tr.train_tree, {})):
        shallow = train(churn, {**BASE, **more, "MAX_TREE_DEPTH": 1}).model
        deep = train(churn, {**BASE, **more}).model
        assert max(t.depth for t in shallow.trees) <= 1 < max(t.depth for t in deep.trees)


def test_forests_ignore_the_session(spark, churn):
    def nodes(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        return sorted(map(str, tr.train_forest(churn, {**BASE, "TREES_NUM": 2}, max_depth=4).nodes.collect()))

    try:
        assert nodes(3) == nodes(8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_rows_without_id_are_spread(churn):
    prepared = tr.prepare(churn.drop(ft.ID), Params.of(DEPENDENT_VARIABLE=ft.LABEL))
    sizes = prepared.rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == tr.LEAST_PARTITIONS and max(r["count"] for r in sizes) < 2 * churn.count() / len(sizes)


def test_nan_and_null_scores_at_any_size(spark):
    rows = [(i, str(i % 2), float(i % 7)) for i in range(60)] + [(100, "1", float("nan")), (101, "0", None), (102, "1", float("inf"))]
    df = spark.createDataFrame(rows, "ID int, ORIGINAL_LABEL string, PROBABILITY double")
    assert ev.auc(df).collect() == ev.auc(df, rows_per_bucket=2).collect()
    assert sorted(ev.roc_curve(df).collect()) == sorted(ev.roc_curve(df, rows_per_bucket=2).collect())


def test_thirds_lose_no_row(spark):
    third = 1 / 3
    assert exact_share(third) == Fraction(1, 3) and exact_share(0.6) == Fraction(3, 5)
    got = stratified_partition(spark.range(1000), "id", None, (third, third, third)).groupBy("PARTITION_TYPE").count().collect()
    assert sorted(r["count"] for r in got) == [333, 333, 334]


def test_null_text_stays_null(spark):
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "abcdef")], "k int, t string")
    back = unchunk(chunk(texts, ["k"], "t", 4), ["k"]).collect()
    assert {r["k"]: r["TEXT"] for r in back} == {1: None, 2: "", 3: "abcdef"}


def test_listed_model_without_flag_is_not_unknown(spark):
    catalogue = spark.createDataFrame([("a", None), ("b", True)], "MODEL_NAME string, AVAILABLE boolean")
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "MODEL_NAME string")
    assert {r["MODEL_NAME"]: r["Code"] for r in pl.check_models(asked, catalogue).collect()} == {"a": "1", "b": "0", "c": "2"}


def test_forecast_of_a_null_value_is_an_error(spark):
    sales = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None), ("a", 3, 4.0)], "g string, t int, v double")
    params = spark.createDataFrame([("a", "ALPHA", None, 0.1, None)], "g string, PARAM_NAME string, INT_VALUE int, DOUBLE_VALUE double, STRING_VALUE string")
    with pytest.raises(Exception, match="NULL value in group a"):
        ses_forecast(sales, "g", "t", "v", params)[0].collect()
