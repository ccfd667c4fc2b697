from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallgrove.functions.params import Params
from tallgrove.operators import scoring as sc
from tallgrove.operators import training as tr
from tallgrove.operators.nodes import export_nodes, prune
from tallgrove.sources import features as ft
from tallgrove.sources.model_rows import decode, encode

BASE = {"HAS_ID": 1, "DEPENDENT_VARIABLE": ft.LABEL, "SEED": 2}


@pytest.fixture(scope="module")
def prepared(churn):
    done = tr.prepare(churn, Params.of(**BASE))
    yield done
    done.release()


def fitted(prepared, kind):
    params = Params.of(**BASE)
    if kind == "forest":
        estimator = tr.forest_estimator(prepared, Params.of(**BASE, TREES_NUM=6, TRY_NUM=5), 4)
    elif kind == "boosted":
        estimator = tr.boosted_estimator(prepared, Params.of(**BASE, ITER_NUM=4, MAX_TREE_DEPTH=3))
    else:
        estimator = tr.tree_estimator(prepared, params, 5)
    return estimator.fit(prepared.rows)


@pytest.mark.parametrize("kind", ["forest", "boosted", "tree"])
def test_scores_equal_the_fitted_model(spark, churn, prepared, kind):
    model = fitted(prepared, kind)
    header = prepared.header(kind)
    loaded = sc.load_model(encode(header, export_nodes(model, header, spark)))
    theirs = {
        r[0]: (header.labels[int(r[1])], r[2])
        for r in model.transform(prepared.rows)
        .select(ft.ID, "prediction", F.array_max(vector_to_array("probability")))
        .collect()
    }
    for engine in ("expression", "arrays"):
        ours = sc.score(churn, loaded, ft.ID, vote="soft", engine=engine).collect()
        assert len(ours) == len(theirs)
        for row in ours:
            label, confidence = theirs[row[ft.ID]]
            assert row["SCORE"] == label and row["CONFIDENCE"] == pytest.approx(confidence, abs=1e-9)


def test_model_rows_round_trip_and_width(spark, churn, forest, prepared):
    for kind, columns, width in (
        ("forest", ["ROW_INDEX", "TREE_INDEX", "MODEL_CONTENT"], 5000),
        ("boosted", ["ROW_INDEX", "KEY", "VALUE"], 1000),
        ("tree", ["ROW_INDEX", "MODEL_CONTENT"], 5000),
    ):
        header = prepared.header(kind)
        nodes = forest.nodes if kind != "tree" else forest.nodes.filter("TREE = 0")
        rows = encode(header, nodes)
        assert rows.columns == columns
        assert rows.agg(F.max(F.length(columns[-1]))).first()[0] <= width
        ids = sorted(r[0] for r in rows.select("ROW_INDEX").collect())
        assert ids == list(range(len(ids)))
        model = sc.load_model(rows.repartition(5))
        assert model.header == header
        assert len(model.trees) == nodes.select("TREE").distinct().count()
        again = sc.load_model(rows)
        assert [t.nodes for t in model.trees] == [t.nodes for t in again.trees]
        assert decode(rows).count() == len(model.trees) + 1


def test_tree_groups_add_up(spark, churn, forest):
    whole = sc.score(churn, forest.model, ft.ID)
    parts = sc.load_model(forest.model_rows, broadcast_chars=3000)
    assert len(parts.parts) > 2
    split = sc.score(churn, parts, ft.ID)
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()


def test_confidence_and_ids(churn, forest):
    scored = sc.score(churn, forest.model, ft.ID)
    low, high, n, ids = scored.agg(
        F.min("CONFIDENCE"), F.max("CONFIDENCE"), F.count("*"), F.countDistinct(ft.ID)
    ).first()
    assert 0.5 <= low <= high <= 1 and n == ids == churn.count()


def test_verbose_doubles_the_rows(churn, forest):
    verbose = sc.score(churn, forest.model, ft.ID, verbose=True)
    assert verbose.count() == 2 * churn.count()
    sums = verbose.groupBy(ft.ID).agg(F.round(F.sum("CONFIDENCE"), 9).alias("s")).select("s").distinct().collect()
    assert [r[0] for r in sums] == [1.0]


@pytest.mark.parametrize("engine", ["expression", "arrays"])
def test_unknown_category_and_missing_number(churn, prepared, spark, engine):
    header = prepared.header("tree")
    model = sc.load_model(encode(header, export_nodes(fitted(prepared, "tree"), header, spark)))
    strange = churn.withColumn("ServiceType", F.lit("NEW")).withColumn("ServiceName", F.lit(None).cast("string"))
    assert sc.score(strange, model, ft.ID, engine=engine).count() == churn.count()
    holes = churn.withColumn("Revenue_Month", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="NULL in feature Revenue_Month"):
        sc.score(holes, model, ft.ID, engine=engine).collect()
    filled = sc.score(holes, model, ft.ID, engine=engine, fill=0.0)
    zeros = sc.score(churn.withColumn("Revenue_Month", F.lit(0.0)), model, ft.ID, engine=engine)
    assert filled.exceptAll(zeros).isEmpty()


def test_missing_column_is_an_error(churn, forest):
    with pytest.raises(ValueError, match="missing feature columns: Revenue_Month"):
        sc.score(churn.drop("Revenue_Month"), forest.model, ft.ID)


def test_label_free_view_scores_the_same(churn, forest):
    with_label = sc.score(churn, forest.model, ft.ID)
    without = sc.score(churn.drop(ft.LABEL), forest.model, ft.ID)
    assert with_label.exceptAll(without).isEmpty()


def test_filter_on_id_reaches_the_scan(churn, forest):
    plan = sc.score(churn, forest.model, ft.ID, engine="arrays").filter(F.col(ft.ID) == 7)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "EqualTo(AccountID,7)" in text


def test_pruning_equals_a_stricter_fit(spark, churn, prepared):
    loose = tr.tree_estimator(prepared, Params.of(**BASE, SPLIT_THRESHOLD=0.0), 6).fit(prepared.rows)
    strict = tr.tree_estimator(prepared, Params.of(**BASE, SPLIT_THRESHOLD=0.01), 6).fit(prepared.rows)
    header = prepared.header("tree")
    cut = encode(header, prune(export_nodes(loose, header, spark), min_gain=0.01))
    own = encode(header, export_nodes(strict, header, spark))
    ours = sc.score(churn, cut, ft.ID).select(ft.ID, "SCORE")
    theirs = sc.score(churn, own, ft.ID).select(ft.ID, "SCORE")
    assert ours.exceptAll(theirs).isEmpty()


def test_parent_minimum_leaves_no_small_inner_node(spark, prepared):
    header = prepared.header("tree")
    nodes = prune(export_nodes(fitted(prepared, "tree"), header, spark), min_parent=100)
    assert nodes.filter("LEFT >= 0 AND RAW_COUNT < 100").isEmpty()
