from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tallgrove.operators import evaluation as ev
from tallgrove.operators.ordering import running_totals
from tallgrove.plans import queries

SCHEMA = "ID long, ORIGINAL_LABEL string, PROBABILITY double"


def brute_area(rows):
    pos = [p for _, y, p in rows if y == "1"]
    neg = [p for _, y, p in rows if y != "1"]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def sample(n, digits, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.random() < 0.4
        rows.append((i, "1" if y else "0", round(min(max(rng.gauss(0.6 if y else 0.4, 0.2), 0.0), 1.0), digits)))
    return rows


@pytest.mark.parametrize("digits", [1, 2, 9])
@pytest.mark.parametrize("per_bucket", [1_000_000, 17])
def test_area_matches_pair_counting(spark, digits, per_bucket):
    rows = sample(400, digits)
    got = ev.auc(spark.createDataFrame(rows, SCHEMA), rows_per_bucket=per_bucket).first()["STAT_VALUE"]
    assert got == pytest.approx(brute_area(rows), abs=1e-12)


@pytest.mark.parametrize("name", ["auc_pieces", "roc_pieces"])
def test_queries_of_pieces_bound_their_number(spark, name, monkeypatch):
    """The pieces do not grow with the table until each holds a million rows, and are more than one."""
    asked = []

    def noted(df, by, order, sums, rows_per_bucket):
        asked.append(-(-df.count() // rows_per_bucket))
        return running_totals(df, by, order, sums, rows_per_bucket)

    monkeypatch.setattr(ev, "running_totals", noted)
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "F").otherwise("O").alias("o_orderstatus"), (F.col("id") * 1.5).alias("o_totalprice"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    monkeypatch.setattr(queries, "load", lambda *_: rows)
    getattr(queries, name)(spark, "").collect()
    assert len(asked) == 1 and 1 < asked[0] <= 64
    assert all(-(-n // queries._piece_rows(n)) <= max(64, -(-n // 1_000_000)) for n in (0, 1, 96, 6208, 6209, 45_000_000, 10**10))


def test_area_matches_the_ml_evaluator(spark):
    rows = spark.createDataFrame(sample(800, 2), SCHEMA)
    ours = ev.auc(rows).first()["STAT_VALUE"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="PROBABILITY", labelCol="y", numBins=0).evaluate(
        rows.withColumn("y", F.col("ORIGINAL_LABEL").cast("double"))
    )
    assert ours == pytest.approx(theirs, abs=1e-9)


def test_area_per_group_with_one_hot_group(spark):
    big, small = sample(900, 9, 2), sample(60, 2, 3)
    rows = [("big", *r) for r in big] + [("small", *r) for r in small]
    df = spark.createDataFrame(rows, "g string, " + SCHEMA)
    got = {r["g"]: r["STAT_VALUE"] for r in ev.auc(df, by=("g",), rows_per_bucket=50).collect()}
    assert got["big"] == pytest.approx(brute_area(big)) and got["small"] == pytest.approx(brute_area(small))


def test_degenerate_areas(spark):
    tied = [(i, str(i % 2), 0.5) for i in range(10)]
    assert ev.auc(spark.createDataFrame(tied, SCHEMA)).first()["STAT_VALUE"] == 0.5
    one_class = [(i, "1", i / 10) for i in range(10)]
    assert ev.auc(spark.createDataFrame(one_class, SCHEMA)).first()["STAT_VALUE"] is None
    unknown = tied + [(99, None, 0.9), (98, "1", None)]
    assert ev.auc(spark.createDataFrame(unknown, SCHEMA)).first()["STAT_VALUE"] == 0.5
    assert ev.auc(spark.createDataFrame([], SCHEMA), by=()).first()["STAT_VALUE"] is None


@pytest.mark.parametrize("per_bucket", [1_000_000, 5])
def test_curve_points(spark, per_bucket):
    rows = sample(100, 1)
    points = ev.roc_curve(spark.createDataFrame(rows, SCHEMA), rows_per_bucket=per_bucket).orderBy("ID").collect()
    scores = sorted({p for _, _, p in rows}, reverse=True)
    assert [r["ID"] for r in points] == list(range(len(scores) + 1))
    assert (points[0]["FPR"], points[0]["TPR"]) == (0.0, 0.0)
    assert (points[-1]["FPR"], points[-1]["TPR"]) == (1.0, 1.0)
    positives = sum(y == "1" for _, y, _ in rows)
    for point, score in zip(points[1:], scores):
        assert point["TPR"] == pytest.approx(sum(y == "1" and p >= score for _, y, p in rows) / positives)


def test_running_totals_do_not_depend_on_buckets(spark):
    df = spark.range(1000).selectExpr("id % 3 as g", "cast(id * id % 997 as double) as s", "id % 5 as x")
    df = df.groupBy("g", "s").agg(F.sum("x").alias("x"))
    one = running_totals(df, ["g"], "s", ["x"]).select("g", "s", "x_before", "x_all", "position")
    many = running_totals(df, ["g"], "s", ["x"], 40).select("g", "s", "x_before", "x_all", "position")
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_many_scores_use_no_single_task(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as s", "id % 5 as x")
    plan = running_totals(df, [], "s", ["x"], 100)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_matrix_has_every_pair_and_counts_rows(spark):
    rows = [("a", "a"), ("a", "b"), ("c", "a"), ("a", "a"), (None, "a")]
    df = spark.createDataFrame(rows, "ORIGINAL_LABEL string, PREDICTED_LABEL string")
    cells = {(r[0], r[1]): r[2] for r in ev.confusion_matrix(df).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 4
    assert cells["a", "a"] == 2 and cells["b", "c"] == 0


def test_class_stats_by_hand(spark):
    rows = [("p", "p")] * 6 + [("p", "n")] * 2 + [("n", "p")] * 3 + [("n", "n")] * 9 + [("x", "n")]
    df = spark.createDataFrame(rows, "ORIGINAL_LABEL string, PREDICTED_LABEL string")
    stats = {r["CLASS"]: r for r in ev.class_stats(ev.confusion_matrix(df), beta=2.0).collect()}
    p = stats["p"]
    assert p["PRECISION"] == pytest.approx(6 / 9) and p["RECALL"] == pytest.approx(6 / 8)
    assert p["FBETA"] == pytest.approx(5 * (6 / 9) * (6 / 8) / (4 * (6 / 9) + 6 / 8))
    assert stats["x"]["PRECISION"] is None and stats["x"]["RECALL"] == 0 and stats["x"]["FBETA"] is None
    assert p["ACCURACY"] == pytest.approx(15 / 21)
    chance = (8 * 9 + 12 * 12 + 0) / 21**2
    assert p["KAPPA"] == pytest.approx((15 / 21 - chance) / (1 - chance))


def test_champion_rule():
    assert ev.select_champion(0.9474023185916701, 0.8539072563331904) == "a"
    assert ev.select_champion(0.8, 0.8) == "b"
    assert ev.select_champion(None, 0.1) == "b"


def test_single_value(spark):
    df = spark.range(2).toDF("v")
    with pytest.raises(ValueError, match="one row"):
        ev.single_value(df, "v")
