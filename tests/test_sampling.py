from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallgrove.operators.ordering import distributed_rank, positions, shuffle_key
from tallgrove.operators.sampling import folds_by_rank, split, stratified_folds, stratified_partition

SCHEMA = "id long, label string"


def expected_parts(rows, seed, shares):
    """Plain-Python split: rank by hash in each stratum, cut at rounded shares."""
    strata = {}
    for i, label in rows:
        strata.setdefault(label, []).append(i)
    parts, upto = {}, [shares[0], shares[0] + shares[1], sum(shares)]
    for ids in strata.values():
        ordered = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
        ends = [math.floor(len(ids) * round(u, 6) + 0.5) for u in upto]
        for rank, i in enumerate(ordered, 1):
            part = next((k for k, end in enumerate(ends, 1) if rank <= end), None)
            if part:
                parts[i] = part
    return parts


@pytest.mark.parametrize("shares", [(0.6, 0.2, 0.2), (0.7, 0.3, 0.0), (0.5, 0.2, 0.1), (0.0, 1.0, 0.0)])
def test_split_matches_plain_ranks(spark, shares):
    labels = ["a"] * 701 + ["b"] * 44 + ["c"] + [None] * 13
    rows = list(enumerate(labels))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r["PARTITION_TYPE"] for r in stratified_partition(df, "id", "label", shares, 5).collect()}
    assert got == expected_parts(rows, 5, shares)


def test_split_does_not_depend_on_layout(spark, churn):
    results = []
    for n in (1, 7, 32):
        parts = stratified_partition(churn.repartition(n), "AccountID", "ContractActivityLABEL")
        results.append(sorted(map(tuple, parts.collect())))
    assert results[0] == results[1] == results[2]


def test_kept_columns_equal_the_join(spark, churn):
    parts = stratified_partition(churn, "AccountID", "ContractActivityLABEL")
    kept = stratified_partition(churn, "AccountID", "ContractActivityLABEL", keep_columns=True)
    for part in (1, 2, 3):
        joined = split(churn, parts, "AccountID", part)
        direct = kept.filter(F.col("PARTITION_TYPE") == part).select(*joined.columns)
        assert joined.exceptAll(direct).isEmpty() and direct.exceptAll(joined).isEmpty()


def test_assignment_is_a_map(spark, churn):
    parts = stratified_partition(churn, "AccountID", "ContractActivityLABEL", check_ids=False)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_duplicate_ids_are_rejected(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (1, "b")], SCHEMA)
    with pytest.raises(ValueError, match="duplicate id"):
        stratified_partition(df, "id", "label")


def test_bad_shares_are_rejected(spark):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    with pytest.raises(ValueError, match="shares"):
        stratified_partition(df, "id", "label", (0.8, 0.3, 0.0))


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert stratified_partition(df, "id", "label").collect() == []
    assert stratified_folds(df, "id", "label", 3, 1).collect() == []


def test_folds_are_balanced_per_stratum(spark):
    rows = [(i, "ab"[i % 3 == 0]) for i in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA)
    folds = stratified_folds(df, "id", "label", 7, 25).join(df, "id").collect()
    assert len(folds) == 1000
    for label in "ab":
        sizes = Counter(r["FOLD"] for r in folds if r["label"] == label)
        assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1


def test_more_folds_than_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], SCHEMA)
    folds = stratified_folds(df, "id", "label", 5, 1).collect()
    assert len({r["FOLD"] for r in folds}) == 2


@pytest.mark.parametrize("digits", [1, 4])
def test_distributed_rank(spark, digits):
    rows = [(i, "hot" if i % 4 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("k", shuffle_key("id", 3))
    got = {r["id"]: (r["RANK"], r["TOTAL"]) for r in distributed_rank(df, ["label"], "k", "id", digits).collect()}
    for label in ("hot", None):
        ids = [i for i, x in rows if x == label]
        order = sorted(ids, key=lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest())
        assert [got[i] for i in order] == [(k, len(ids)) for k in range(1, len(ids) + 1)]
    folds = Counter((dict(rows)[r["id"]], r["FOLD"]) for r in folds_by_rank(df, "id", "label", 7, 3).collect())
    assert {max(n) - min(n) for x in ("hot", None) for n in [[folds[x, f] for f in range(7)]]} == {1}


def test_positions_of_a_hot_value(spark):
    rows = [(i, "hot" if i % 9 else None) for i in range(2000)] + [(5, "hot")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = positions(df, "label", [F.desc("id")]).collect()
    for label in ("hot", None):
        mine = sorted((r["POSITION"], -r["id"]) for r in got if r["label"] == label)
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1)) and [i for _, i in mine] == sorted(i for _, i in mine)
    assert len(got) == len(rows) and positions(df.limit(0), "label", ["id"]).collect() == []
