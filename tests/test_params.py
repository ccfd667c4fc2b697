from __future__ import annotations

import pytest

from tallgrove.functions.params import Params, parse_range, parse_values, typed_row
from tallgrove.functions.roles import resolve_roles


def test_round_trip_through_a_table(spark):
    params = Params.of(TREES_NUM=100, SPLIT_THRESHOLD=1e-5, DEPENDENT_VARIABLE="y", THREAD_RATIO=1.0)
    table = params.to_df(spark)
    assert table.columns == ["PARAM_NAME", "INT_VALUE", "DOUBLE_VALUE", "STRING_VALUE"]
    assert Params.from_df(table) == params
    assert Params.read(dict(params)) == params


def test_arrays_and_overwriting(spark):
    params = Params.from_arrays(
        ["THREAD_RATIO", "VERBOSE", "VERBOSE"], [None, 0, 1], [0.5, None, None], [None, None, None]
    )
    assert params == {"THREAD_RATIO": 0.5, "VERBOSE": 1}


def test_unknown_names_are_errors():
    with pytest.raises(ValueError, match="unknown parameter TREE_NUM"):
        Params.of(TREE_NUM=3)


def test_an_int_is_accepted_for_a_double():
    assert Params.of(BETA=1).number("BETA", 2.0) == 1.0
    assert Params().number("BETA", 2.0) == 2.0
    assert typed_row("BETA", 1) == ("BETA", 1, None, None)


def test_ranges_and_value_lists():
    assert parse_range("[0.1,10,1.0]") == [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
    assert parse_range("[10,3,20]", whole=True) == [10, 15, 20]
    assert parse_values("{1e-1, 1e-2,3}") == [0.1, 0.01, 3]
    assert len(parse_range("[0.1,10,1.0]")) * len(parse_range("[0.0,10,1.0]")) * 3 == 300
    with pytest.raises(ValueError):
        parse_values("[1,2]")


def test_roles(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 3, "y")], "id long, c string, x double, k int, label string")
    roles = resolve_roles(df, Params.of(HAS_ID=1, DEPENDENT_VARIABLE="label", CATEGORICAL_VARIABLE="k"))
    assert (roles.id, roles.label, roles.categorical, roles.numeric) == ("id", "label", ("c", "k"), ("x",))
    roles = resolve_roles(df, Params.of())
    assert roles.id is None and roles.label == "label" and roles.numeric == ("id", "x", "k")
    with pytest.raises(ValueError, match="no column"):
        resolve_roles(df, Params.of(DEPENDENT_VARIABLE="missing"))


def test_calls_with_parameter_tables(spark, churn):
    from tallgrove.functions import calls

    params = Params.of(
        PARTITION_METHOD=1, RANDOM_SEED=23, HAS_ID=1, STRATIFIED_COLUMN="ContractActivityLABEL",
        TRAINING_PERCENT=0.6, TESTING_PERCENT=0.2, VALIDATION_PERCENT=0.2,
    ).to_df(spark)
    parts = calls.partition(churn, params)
    sizes = {r["PARTITION_TYPE"]: r["count"] for r in parts.groupBy("PARTITION_TYPE").count().collect()}
    assert sum(sizes.values()) == churn.count() and abs(sizes[1] - 0.6 * churn.count()) <= 1
    rows = [(1, "a", "a"), (2, "a", "b"), (3, "b", "b")]
    df = spark.createDataFrame(rows, "ID long, ORIGINAL_LABEL string, PREDICTED_LABEL string")
    matrix, stats = calls.confusion_matrix(df, {"BETA": 1})
    assert matrix.count() == 4 and stats.count() == 2
    rows = [(1, "a", 0.9), (2, "a", 0.4), (3, "b", 0.4)]
    df = spark.createDataFrame(rows, "ID long, ORIGINAL_LABEL string, CHURN_PROBABILITY double")
    area, points = calls.auc(df, {"POSITIVE_LABEL": "a"})
    assert area.first()["STAT_VALUE"] == 0.75 and points.count() == 3
    with pytest.raises(ValueError, match="POSITIVE_LABEL"):
        calls.auc(df, {})
