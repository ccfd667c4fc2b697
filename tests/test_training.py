from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrove.operators import evaluation as ev
from tallgrove.operators import training as tr
from tallgrove.operators import tuning
from tallgrove.operators.out_of_bag import bag_counts, bag_weight, bag_weights, stream_start
from tallgrove.operators.sampling import stratified_partition
from tallgrove.operators.scoring import score
from tallgrove.operators.tuning import search, prepare_with_folds
from tallgrove.functions.params import Params
from tallgrove.sources import features as ft
from tallgrove.sources.tables import snapshot

BASE = {"HAS_ID": 1, "DEPENDENT_VARIABLE": ft.LABEL, "SEED": 2, "THREAD_RATIO": 1.0}


def area_of(df, model):
    scored = score(df, model, ft.ID, keep=(ft.LABEL,))
    prob = ev.positive_probability(F.col("SCORE"), F.col("CONFIDENCE"), ft.POSITIVE)
    return ev.auc(scored.withColumn("p", F.round(prob, 9)), ft.LABEL, "p", ft.POSITIVE).first()["STAT_VALUE"]


@pytest.fixture(scope="module")
def parts(churn):
    tagged = snapshot(stratified_partition(churn, ft.ID, ft.LABEL, (0.7, 0.3, 0.0), 1, keep_columns=True))
    return [tagged.filter(F.col("PARTITION_TYPE") == k).drop("PARTITION_TYPE") for k in (1, 2)]


def test_forest_finds_a_planted_rule(parts):
    train, test = parts
    result = tr.train_forest(train, {**BASE, "TREES_NUM": 20, "TRY_NUM": 8}, max_depth=6)
    assert area_of(test, result.model) > 0.9
    assert result.importance.agg(F.sum("IMPORTANCE")).first()[0] == pytest.approx(1.0)
    assert result.importance.count() == len(ft.feature_columns())
    top = result.importance.orderBy(F.desc("IMPORTANCE")).first()["COLUMN_NAME"]
    assert top.startswith(("Revenue_Month", "DataUsage", "CustomerLifetime"))
    assert result.confusion_matrix.agg(F.sum("COUNT")).first()[0] == train.count()


def test_shuffled_labels_are_not_learnt(parts):
    train, test = parts
    coin = F.when(F.md5(F.concat(F.lit("x"), F.col(ft.ID).cast("string"))) < "8", ft.POSITIVE).otherwise("Active")
    result = tr.train_forest(train.withColumn(ft.LABEL, coin), {**BASE, "TREES_NUM": 10, "TRY_NUM": 5}, max_depth=4)
    assert abs(area_of(test.withColumn(ft.LABEL, coin), result.model) - 0.5) < 0.12


def test_boosted_finds_a_planted_rule(parts):
    train, test = parts
    result = tr.train_boosted(train, {**BASE, "ITER_NUM": 6, "MAX_TREE_DEPTH": 4, "ROW_SAMPLE_RATE": 0.7})
    assert area_of(test, result.model) > 0.9
    assert "VARIABLE_NAME" in result.importance.columns


def test_fits_do_not_depend_on_the_layout(parts):
    train, _ = parts
    rows = []
    for n in (3, 11):
        result = tr.train_forest(train.repartition(n), {**BASE, "TREES_NUM": 3, "TRY_NUM": 5}, max_depth=4)
        rows.append(sorted(map(tuple, result.model_rows.collect())))
    assert rows[0] == rows[1]


def test_out_of_bag_error_tracks_the_test_error(parts):
    train, test = parts
    result = tr.train_forest(
        train, {**BASE, "TREES_NUM": 12, "TRY_NUM": 8, "CALCULATE_OOB": 1}, max_depth=6
    )
    curve = [r["OOB_ERROR"] for r in result.oob.orderBy("TREE_INDEX").collect()]
    assert len(curve) == 12 and all(0 <= e <= 1 for e in curve)
    wrong = score(test, result.model, ft.ID, keep=(ft.LABEL,)).filter(F.col("SCORE") != F.col(ft.LABEL)).count()
    assert abs(curve[-1] - wrong / test.count()) < 0.08
    assert len(result.model.trees) == 12


def test_bag_weights_are_poisson(spark):
    w = spark.range(20000).select(bag_weight("id", 3, 1).alias("w"))
    mean, none = w.agg(F.avg("w"), F.avg((F.col("w") == 0).cast("int"))).first()
    assert mean == pytest.approx(1.0, abs=0.03) and none == pytest.approx(0.3679, abs=0.015)


def test_bags_of_columns_and_arrays_agree(spark):
    first, second = stream_start("id", 3)
    trees = (0, 1, 50, 99)
    rows = spark.range(3000).select(first.alias("a"), second.alias("b"), *[bag_weight("id", 3, t).alias(f"t{t}") for t in trees])
    plain = rows.toPandas()
    weights = bag_weights(plain["a"].to_numpy(), plain["b"].to_numpy(), 100)
    assert all((weights[:, t] == plain[f"t{t}"]).all() for t in trees)
    # Bags of any two trees are drawn apart.
    apart = np.corrcoef(weights.T) - np.eye(100)
    assert abs(apart).max() < 0.1
    assert weights.mean() == pytest.approx(1.0, abs=0.01) and weights.var() == pytest.approx(1.0, abs=0.02)
    with_null = spark.range(3000).unionByName(spark.createDataFrame([(None,)], "id long"))
    counts = {r["TREE_INDEX"]: (r["N_OUTSIDE"], r["N_DRAWN"]) for r in bag_counts(with_null, "id", 3, 100).collect()}
    assert counts == {t: (int((weights[:, t] == 0).sum()), int(weights[:, t].sum())) for t in range(100)}


def test_unlabelled_rows_are_left_out(parts):
    train, _ = parts
    holes = train.withColumn(ft.LABEL, F.when(F.col(ft.ID) % 5 > 0, F.col(ft.LABEL)))
    result = tr.train_tree(holes, {**BASE, "ALGORITHM": 3}, max_depth=3)
    assert result.confusion_matrix.agg(F.sum("COUNT")).first()[0] == holes.filter(f"{ft.LABEL} is not null").count()


def test_three_classes(spark, parts):
    train, _ = parts
    three = train.withColumn(ft.LABEL, F.least(F.col("DataUsage_PCT"), F.lit(2)).cast("string"))
    result = tr.train_tree(three, {**BASE, "ALGORITHM": 3}, max_depth=5)
    wrong = result.confusion_matrix.filter("ACTUAL_CLASS <> PREDICTED_CLASS").agg(F.sum("COUNT")).first()[0]
    assert wrong == 0
    with pytest.raises(ValueError, match="two classes"):
        tr.train_boosted(train.withColumn(ft.LABEL, F.lit("one")), {**BASE, "ITER_NUM": 2})


def test_boosted_trees_of_three_classes(spark, parts):
    """Each class has its trees and key; probabilities are those of the single models, normalised."""
    three = parts[0].withColumn(ft.LABEL, F.least(F.col("DataUsage_PCT"), F.lit(2)).cast("string"))
    params = {**BASE, "MAX_TREE_DEPTH": 2, "LEARNING_RATE": 0.3}
    result = tr.train_boosted(three, {**params, "ITER_NUM": 3})
    keys = {r["KEY"] for r in result.model_rows.select("KEY").distinct().collect()}
    assert keys == {"header", *[f"class_{i // 3}_tree_{i}" for i in range(9)]}
    assert result.confusion_matrix.filter("ACTUAL_CLASS <> PREDICTED_CLASS").agg(F.sum("COUNT")).first()[0] == 0
    got = {(r[ft.ID], r["SCORE"]): r["CONFIDENCE"] for r in score(three, result.model, ft.ID, verbose=True).collect()}
    alone = {}
    for c in "012":
        two = three.withColumn(ft.LABEL, F.when(F.col(ft.LABEL) == c, "b").otherwise("a"))
        model = tr.train_boosted(two, {**params, "ITER_NUM": 3}).model
        alone |= {(r[ft.ID], c): r["CONFIDENCE"] for r in score(two, model, ft.ID, verbose=True).filter("SCORE = 'b'").collect()}
    for (i, c), p in got.items():
        assert p == pytest.approx(alone[i, c] / sum(alone[i, k] for k in "012"), abs=1e-9)
    found = tr.train_boosted(three, {**params, "FOLD_NUM": 2, "RANGE_ITER_NUM": "[1,3,5]"})
    rates = {r["ITER_NUM"]: (r["ERROR_RATE"], r["AUC"]) for r in found.candidates.collect()}
    assert set(rates) == {1, 3, 5} and all(rate < 0.2 and area is None for rate, area in rates.values())


def test_only_cart(parts):
    with pytest.raises(ValueError, match="CART"):
        tr.train_tree(parts[0], {**BASE, "ALGORITHM": 1})


def test_tree_rules_cover_all_leaves(parts):
    params = {**BASE, "ALGORITHM": 3, "IS_OUTPUT_RULES": 1, "MIN_RECORDS_OF_PARENT": 40, "MIN_RECORDS_OF_LEAF": 5}
    result = tr.train_tree(parts[0], params, max_depth=5)
    tree = result.model.trees[0]
    leaves = [n for n in tree.reachable() if tree.is_leaf(n)]
    assert sorted(r["ROW_INDEX"] for r in result.rules.collect()) == sorted(leaves)
    assert all(n["RAW_COUNT"] >= 40 for k, n in tree.nodes.items() if not tree.is_leaf(k))


def test_search_picks_the_best_mean_and_prunes_correctly(parts):
    """One fit per leaf size gives the same answers as one fit per candidate."""
    train, _ = parts
    grid = {
        "MIN_RECORDS_OF_PARENT_VALUES": "{2,120}", "MIN_RECORDS_OF_LEAF_VALUES": "{3}",
        "SPLIT_THRESHOLD_VALUES": "{0.0, 0.03}", "FOLD_NUM": 3, "EVALUATION_METRIC": "AUC", "ALGORITHM": 3,
    }
    params = Params.of(**BASE, **grid)
    prepared = prepare_with_folds(train, params)
    found = search(prepared, params, "tree", 5)
    rows = found.candidates.orderBy("CANDIDATE").collect()
    assert len(rows) == 4
    best = max(rows, key=lambda r: (r["AUC"], -r["CANDIDATE"]))
    assert found.best["MIN_RECORDS_OF_PARENT"] == best["MIN_RECORDS_OF_PARENT"]
    assert found.best["SPLIT_THRESHOLD"] == best["SPLIT_THRESHOLD"]
    assert found.selected("PARAM_NAME").count() == 3

    strict = next(r for r in rows if r["SPLIT_THRESHOLD"] == 0.03 and r["MIN_RECORDS_OF_PARENT"] == 2)
    errors = []
    for fold in range(3):
        one = Params.of(**BASE, MIN_RECORDS_OF_LEAF=3, SPLIT_THRESHOLD=0.03)
        model = tr.tree_estimator(prepared, one, 5).fit(prepared.rows.filter(F.col("FOLD") != fold))
        held = model.transform(prepared.rows.filter(F.col("FOLD") == fold))
        errors.append(held.agg(F.avg((F.col("prediction") != F.col("label")).cast("int"))).first()[0])
    assert strict["ERROR_RATE"] == pytest.approx(sum(errors) / 3, abs=1e-12)
    prepared.release()


def test_search_skips_finished_fits(parts, tmp_path, monkeypatch):
    """A search started again makes the fits that were stopped and no others; other rows or parameters share none."""
    grid = {"MIN_RECORDS_OF_LEAF_VALUES": "{3,30}", "FOLD_NUM": 2, "ALGORITHM": 3}
    params, store = Params.of(**BASE, **grid), str(tmp_path / "fits")
    prepared = prepare_with_folds(parts[0], params)
    first = search(prepared, params, "tree", 4, store).candidates.orderBy("CANDIDATE").collect()
    folders = sorted((tmp_path / "fits").iterdir())
    assert len(folders) == 4
    made, fit = [], tuning._Tree.fit
    monkeypatch.setattr(tuning._Tree, "fit", staticmethod(lambda *a: made.append(a) or fit(*a)))
    (folders[1] / "_SUCCESS").unlink()
    assert search(prepared, params, "tree", 4, store).candidates.orderBy("CANDIDATE").collect() == first
    assert len(made) == 1
    search(prepared, params, "tree", 3, store)
    assert len(made) == 5
    told = tuning.rows_digest(prepared.rows)
    assert tuning.rows_digest(prepared.rows.repartition(3)) == told
    assert tuning.rows_digest(prepared.rows.filter(F.col(ft.ID) > 3)) != told
    prepared.release()


def test_boosted_search_truncates_correctly(parts):
    train, _ = parts
    params = Params.of(
        **BASE, FOLD_NUM=2, CV_METRIC="ERROR_RATE", REF_METRIC="AUC", MAX_TREE_DEPTH=2, RANGE_ITER_NUM="[1,3,5]"
    )
    prepared = prepare_with_folds(train, params)
    found = search(prepared, params, "boosted")
    rows = {r["ITER_NUM"]: r["ERROR_RATE"] for r in found.candidates.collect()}
    assert set(rows) == {1, 3, 5} and found.best["ITER_NUM"] == min(rows, key=lambda k: (rows[k], k))
    errors = []
    for fold in range(2):
        model = tr.boosted_estimator(prepared, Params.of(**params, ITER_NUM=3)).fit(
            prepared.rows.filter(F.col("FOLD") != fold)
        )
        held = model.transform(prepared.rows.filter(F.col("FOLD") == fold))
        errors.append(held.agg(F.avg((F.col("prediction") != F.col("label")).cast("int"))).first()[0])
    assert rows[3] == pytest.approx(sum(errors) / 2, abs=1e-12)
    prepared.release()
