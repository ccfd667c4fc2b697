from __future__ import annotations

import random
from statistics import NormalDist

import pytest

from tallgrove.functions.params import SCHEMA, Params
from tallgrove.operators.forecasting import _blocks, _carried, _entering, group_settings, ses_forecast, unmatched_groups


def param_rows(spark, **by_group):
    rows = [(g, *row) for g, values in by_group.items() for row in Params.of(**values).rows()]
    return spark.createDataFrame(rows, f"g string, {SCHEMA}")


def plain(series, alpha, delta=None):
    """One value after the other: fitted levels, next level, squared error, last weight."""
    level, fitted, sse, e, m, a = series[0], [], 0.0, 0.0, 0.0, alpha
    for y in series:
        fitted.append(level)
        error = y - level
        if delta is not None:
            e, m = delta * error + (1 - delta) * e, delta * abs(error) + (1 - delta) * m
            a = abs(e / m) if m > 0 else a
        sse += error * error
        level = a * y + (1 - a) * level
    return fitted[1:], level, sse / (len(series) - 1) if len(series) > 1 else None, a


def series(n, seed):
    rng = random.Random(seed)
    return [round(100 + 10 * rng.random() + i * 0.1, 3) for i in range(n)]


@pytest.mark.parametrize("block", [20_000, 7])
@pytest.mark.parametrize("adaptive", [0, 1])
def test_against_a_plain_loop(spark, block, adaptive):
    data = {"a": series(60, 1), "b": series(23, 2), "hot": series(300, 3)}
    rows = [(g, t + 5, y) for g, ys in data.items() for t, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "g string, t int, y double").repartition(5)
    settings = dict(
        ADAPTIVE_METHOD=adaptive, MEASURE_NAME="MSE", ALPHA=0.3, DELTA=0.2, FORECAST_NUM=3, EXPOST_FLAG=1,
        PREDICTION_CONFIDENCE_1=0.8, PREDICTION_CONFIDENCE_2=0.95,
    )
    params = param_rows(spark, **{g: settings for g in data})
    forecast, stats = ses_forecast(df, "g", "t", "y", params, block_points=block)
    got = {}
    for r in forecast.collect():
        got.setdefault(r["g"], {})[r["t"]] = r
    errors = {r["g"]: r["STAT_VALUE"] for r in stats.collect()}
    for g, ys in data.items():
        fitted, level, mse, a = plain(ys, 0.3, 0.2 if adaptive else None)
        assert sorted(got[g]) == list(range(6, 5 + len(ys) + 3))
        for t, f in enumerate(fitted, 6):
            assert got[g][t]["y"] == pytest.approx(f, rel=1e-10) and got[g][t]["PI1_LOWER"] is None
        assert errors[g] == pytest.approx(mse, rel=1e-9)
        for h in (1, 2, 3):
            row = got[g][4 + len(ys) + h]
            spread = NormalDist().inv_cdf(0.975) * (mse * (1 + (h - 1) * a * a)) ** 0.5
            assert row["y"] == pytest.approx(level, rel=1e-10)
            assert row["PI2_UPPER"] - row["y"] == pytest.approx(spread, rel=1e-8)
            assert row["PI1_LEVEL"] == 0.8


@pytest.mark.parametrize("adaptive", [0, 1])
def test_many_blocks(spark, adaptive):
    """A series of 10 000 blocks: no job per block, and no row holds all blocks."""
    ys = [100 + (i * 7919 % 1000) / 50 for i in range(10_000)]
    df = spark.createDataFrame([("a", t, y) for t, y in enumerate(ys)] + [("b", 3, 1.0)], "g string, t int, y double")
    settings = dict(ADAPTIVE_METHOD=adaptive, ALPHA=0.3, DELTA=0.2, FORECAST_NUM=1)
    forecast, stats = ses_forecast(df, "g", "t", "y", param_rows(spark, a=settings, b=settings), block_points=1, range_blocks=64)
    fitted, level, mse, _ = plain(ys, 0.3, 0.2 if adaptive else None)
    got = {r["t"]: r["y"] for r in forecast.filter("g = 'a'").collect()}
    assert [got[t] for t in range(1, 10_000)] == pytest.approx(fitted, rel=1e-10) and got[10_000] == pytest.approx(level)
    assert {r["g"]: r["STAT_VALUE"] for r in stats.collect()}["a"] == pytest.approx(mse, rel=1e-9)


@pytest.mark.parametrize("adaptive,plan", [(0, "collect_list"), (1, "MapInArrow")])
def test_ranges_bound_the_rows(spark, adaptive, plan):
    df = spark.createDataFrame([("a", t, 1.0) for t in range(900)], "g string, t int, y double")
    params = group_settings(param_rows(spark, a=dict(ADAPTIVE_METHOD=adaptive, FORECAST_NUM=1)), "g")
    blocks = _blocks(df, "g", "t", "y", 1).join(params, "g")
    if adaptive:
        run = _carried(blocks, "g")
        assert plan in run._jdf.queryExecution().executedPlan().toString() and run.count() == 900
        return
    entering = _entering(blocks, "g", 30)
    assert sorted(r["ORD"] for r in entering.collect()) == list(range(900))
    assert "RANGE" in entering._jdf.queryExecution().optimizedPlan().toString()


def test_short_series(spark):
    df = spark.createDataFrame([("one", 1, 5.0), ("two", 1, 5.0), ("two", 2, 7.0)], "g string, t int, y double")
    settings = dict(ALPHA=0.5, FORECAST_NUM=2, PREDICTION_CONFIDENCE_1=0.9)
    forecast, stats = ses_forecast(df, "g", "t", "y", param_rows(spark, one=settings, two=settings))
    values = {(r["g"], r["t"]): r["y"] for r in forecast.collect()}
    assert values == {("one", 2): 5.0, ("one", 3): 5.0, ("two", 2): 5.0, ("two", 3): 6.0, ("two", 4): 6.0}
    assert {r["g"]: r["STAT_VALUE"] for r in stats.collect()} == {"one": None, "two": 4.0}


def test_groups_without_parameters_are_dropped_and_listed(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, 5.0)], "g string, t int, y double")
    params = param_rows(spark, a=dict(ALPHA=0.5, FORECAST_NUM=1), z=dict(ALPHA=0.5, FORECAST_NUM=1))
    forecast, _ = ses_forecast(df, "g", "t", "y", params)
    assert [r["g"] for r in forecast.collect()] == ["a"]
    assert [r["g"] for r in unmatched_groups(df, "g", params).collect()] == ["b"]


def test_expost_rows_can_be_left_out(spark):
    df = spark.createDataFrame([("a", t, float(t)) for t in range(5)], "g string, t int, y double")
    forecast, _ = ses_forecast(df, "g", "t", "y", param_rows(spark, a=dict(FORECAST_NUM=2, EXPOST_FLAG=0)))
    assert sorted(r["t"] for r in forecast.collect()) == [5, 6]


def test_two_values_for_one_step_are_an_error(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 6.0)], "g string, t int, y double")
    with pytest.raises(Exception, match="two values for one step"):
        ses_forecast(df, "g", "t", "y", param_rows(spark, a=dict(FORECAST_NUM=1)))


def test_unknown_measure_is_an_error(spark):
    df = spark.createDataFrame([("a", 1, 5.0)], "g string, t int, y double")
    with pytest.raises(Exception, match="unknown MEASURE_NAME MAPE"):
        ses_forecast(df, "g", "t", "y", param_rows(spark, a=dict(MEASURE_NAME="MAPE", FORECAST_NUM=1)))
