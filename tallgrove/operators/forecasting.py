"""Single exponential smoothing per group, with forecasts, intervals and accuracy.

A series is cut into blocks of consecutive time points, so that no task holds
more than a block however long a series is. With a constant smoothing weight a
block maps its incoming level F to ``a * F + c``. Such maps compose, so ranges of
``RANGE_BLOCKS`` blocks are composed first, a scan over a series' ranges gives every range its
incoming level and with it every block, and all blocks then unfold side
by side. The adaptive weight has no such form: there the blocks of a series stream in order through
one task that carries the state from block to block, all series in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrove.functions.params import pivot_params
from tallgrove.sources.tables import bounded, snapshot

BLOCK_POINTS = 20_000
RANGE_BLOCKS = 1000
SCAN_PIECE = 128
SETTINGS = [
    "ADAPTIVE_METHOD", "ALPHA", "DELTA", "FORECAST_NUM", "EXPOST_FLAG",
    "PREDICTION_CONFIDENCE_1", "PREDICTION_CONFIDENCE_2",
]
# The settings of a group whose parameter rows leave them out.
DEFAULTS = {"ADAPTIVE_METHOD": 0.0, "ALPHA": 0.1, "DELTA": 0.2, "FORECAST_NUM": 0.0, "EXPOST_FLAG": 1.0}


def unmatched_groups(df: DataFrame, group: str, params: DataFrame) -> DataFrame:
    """Groups of the data that have no parameter rows and are therefore not forecast."""
    return df.select(group).distinct().join(params.select(group).distinct(), group, "left_anti")


def group_settings(params: DataFrame, group: str) -> DataFrame:
    """One row per group with typed settings and the interval factors."""
    # The error measure is text; the mean squared error is the one there is.
    wrong = F.concat(F.lit("unknown MEASURE_NAME "), F.col("STRING_VALUE"))
    other = (F.col("PARAM_NAME") == "MEASURE_NAME") & (F.col("STRING_VALUE") != "MSE")
    params = params.withColumn("INT_VALUE", F.when(other, F.raise_error(wrong).cast("int")).otherwise(F.col("INT_VALUE")))
    wide = pivot_params(params, group, [*SETTINGS, "MEASURE_NAME"])
    for name, default in DEFAULTS.items():
        wide = wide.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    for i in (1, 2):
        wide = wide.withColumn(f"Z{i}", _interval_factor(F.col(f"PREDICTION_CONFIDENCE_{i}")))
    return bounded(wide)


@F.pandas_udf(T.DoubleType())
def _interval_factor(levels: pd.Series) -> pd.Series:
    """The normal quantile that bounds a central interval of the given level."""
    return levels.map(lambda c: NormalDist().inv_cdf((1 + c) / 2), na_action="ignore")


def _blocks(df: DataFrame, group: str, time: str, value: str, points: int) -> DataFrame:
    """``(group, BLOCK, POINTS)`` with at most ``points`` ordered points per block.

    Time counts in whole steps and a series has one row per step, which is
    checked: two values for one step are an error, and so is a step without a value.
    """
    steps = df.groupBy(group, F.col(time).cast("bigint").alias("t")).agg(
        F.max(F.col(value).cast("double")).alias("y"), F.count(F.lit(1)).alias("_rows")
    )
    twice = F.raise_error(F.concat(F.lit("two values for one step of group "), F.col(group).cast("string")))
    none = F.raise_error(F.concat(F.lit("NULL value in group "), F.coalesce(F.col(group).cast("string"), F.lit("NULL"))))
    one = F.when(F.col("_rows") > 1, twice.cast("double")).otherwise(F.coalesce("y", none.cast("double")))
    return (
        steps.withColumn("y", one)
        .groupBy(group, F.floor(F.col("t") / points).alias("BLOCK"))
        .agg(F.array_sort(F.collect_list(F.struct("t", "y"))).alias("POINTS"))
    )


def scan(items: Column, start: Column, step, emit) -> Column:
    """Fold ``items`` from ``start`` and keep ``emit(state)`` before every item.

    A struct of the final ``state`` and ``out``, the emitted pieces. Growing one long array item by item
    would copy it every time, so pieces of ``SCAN_PIECE`` items are folded into
    short arrays that are joined at the end.
    """
    count = F.ceil(F.size(items) / SCAN_PIECE).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
        lambda i: F.slice(items, i * SCAN_PIECE + 1, SCAN_PIECE),
    )

    def inner(acc: Column, item: Column) -> Column:
        state = acc["state"]
        return F.struct(
            step(state, item).alias("state"), F.concat(acc["out"], F.array(emit(state))).alias("out")
        )

    def outer(acc: Column, piece: Column) -> Column:
        empty = F.filter(F.array(emit(acc["state"])), lambda _: F.lit(False))
        done = F.aggregate(piece, F.struct(acc["state"].alias("state"), empty.alias("out")), inner)
        # The one-element array lets the final map see both results of the piece.
        return F.element_at(F.transform(F.array(done), lambda d: F.struct(
            d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")
        )), 1)

    nothing = F.filter(F.array(F.array(emit(start))), lambda _: F.lit(False))
    return F.aggregate(pieces, F.struct(start.alias("state"), nothing.alias("out")), outer)


def _unfolded(blocks: DataFrame, group: str) -> DataFrame:
    """Run the recursion with a constant weight over blocks with a known incoming state (f, e, m, a).

    Returns ``(group, BLOCK, ORD, STATE, SSE, N, LAST, FITTED)``; ``FITTED`` pairs
    each point's time with the forecast made before the point was seen.
    """

    def step(s: Column, p: Column) -> Column:
        error = p["y"] - s["f"]
        return F.struct(
            (s["a"] * p["y"] + (1 - s["a"]) * s["f"]).alias("f"),
            s["e"].alias("e"),
            s["m"].alias("m"),
            s["a"].alias("a"),
            (s["sse"] + error * error).alias("sse"),
        )

    start = F.struct(*[F.col("STATE")[c].alias(c) for c in ("f", "e", "m", "a")], F.lit(0.0).alias("sse"))
    run = scan(F.col("POINTS"), start, step, lambda s: s["f"])
    return blocks.select(group, "BLOCK", "ORD", "POINTS", run.alias("r")).select(
        group,
        "BLOCK",
        "ORD",
        F.struct(*[F.col("r.state")[c].alias(c) for c in ("f", "e", "m", "a")]).alias("STATE"),
        F.col("r.state.sse").alias("SSE"),
        F.size("POINTS").cast("bigint").alias("N"),
        F.element_at("POINTS", -1)["t"].alias("LAST"),
        F.zip_with("POINTS", F.flatten("r.out"), lambda p, f: F.struct(p["t"].alias("t"), f.alias("f"))).alias("FITTED"),
    )


def _entering(blocks: DataFrame, group: str, range_blocks: int) -> DataFrame:
    """``(group, BLOCK, ORD, STATE)``: every block's incoming state under a constant weight.

    Each block is reduced to two numbers first and each range of blocks to two more, so no row holds more than a
    range's blocks or a series' ranges. The level before the first point is that point, which
    makes the second forecast equal to the first value.
    """
    alpha = F.col("ALPHA")
    carry = F.aggregate("POINTS", F.lit(0.0), lambda c, p: alpha * p["y"] + (1 - alpha) * c)
    reduced = blocks.select(
        group,
        "ALPHA",
        F.floor(F.col("BLOCK") / range_blocks).alias("RANGE"),
        F.struct(
            "BLOCK",
            F.element_at("POINTS", 1)["y"].alias("first"),
            F.pow(1 - alpha, F.size("POINTS")).alias("a"),
            carry.alias("c"),
        ).alias("b"),
    )
    one = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("c"))
    composed = scan(
        F.col("bs"), one, lambda s, b: F.struct((b["a"] * s["a"]).alias("a"), (b["a"] * s["c"] + b["c"]).alias("c")), lambda s: s
    )
    ranges = (
        reduced.groupBy(group, "ALPHA", "RANGE").agg(F.array_sort(F.collect_list("b")).alias("bs")).withColumn("r", composed)
    )
    short = ranges.select(
        group,
        F.struct(
            "RANGE", F.element_at("bs", 1)["first"].alias("first"), F.size("bs").alias("n"),
            F.col("r.state.a").alias("a"), F.col("r.state.c").alias("c"),
        ).alias("x"),
    )
    per_group = short.groupBy(group).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    start = F.struct(F.element_at("xs", 1)["first"].alias("f"), F.lit(0).alias("n"))
    run = scan(
        F.col("xs"), start, lambda s, x: F.struct((x["a"] * s["f"] + x["c"]).alias("f"), (s["n"] + x["n"]).alias("n")), lambda s: s
    )
    levels = per_group.withColumn("r", run).select(
        group, F.inline(F.zip_with("xs", F.flatten("r.out"), lambda x, s: F.struct(x["RANGE"].alias("RANGE"), s["f"].alias("f"), s["n"].alias("n"))))
    )
    placed = ranges.join(levels, [group, "RANGE"])
    paired = F.zip_with("bs", F.flatten("r.out"), lambda b, s: F.struct(
        b["BLOCK"].alias("BLOCK"), (s["a"] * F.col("f") + s["c"]).alias("f")
    ))
    return placed.select(group, "ALPHA", "n", F.posexplode(paired).alias("pos", "x")).select(
        group,
        F.col("x.BLOCK").alias("BLOCK"),
        (F.col("n") + F.col("pos")).alias("ORD"),
        F.struct(
            F.col("x.f").alias("f"), F.lit(0.0).alias("e"), F.lit(0.0).alias("m"), F.col("ALPHA").alias("a")
        ).alias("STATE"),
    )


def _carried(blocks: DataFrame, group: str) -> DataFrame:
    """``_unfolded`` under the adaptive weight: one sorted pass, the state goes from block to block."""
    schema = T.StructType([
        blocks.schema[group],
        *T.StructType.fromDDL(
            "BLOCK bigint, ORD int, STATE struct<f:double,e:double,m:double,a:double>, SSE double, N bigint, LAST bigint,"
            " FITTED array<struct<t:bigint,f:double>>"
        ).fields,
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, order = None, 0
        f = e = m = a = 0.0
        for batch in batches:
            rows = []
            columns = (batch.column(c) for c in (group, "BLOCK", "ALPHA", "DELTA", "POINTS"))
            for key, block, alpha, delta, points in zip(*columns):
                times, values = (points.values.field(c).to_pylist() for c in ("t", "y"))
                if (key.as_py(),) != current:
                    current, order, f, e, m, a = (key.as_py(),), 0, values[0], 0.0, 0.0, alpha.as_py()
                delta, sse, fitted = delta.as_py(), 0.0, []
                for y in values:
                    fitted.append(f)
                    error = y - f
                    e = delta * error + (1 - delta) * e
                    m = delta * abs(error) + (1 - delta) * m
                    if m > 0:
                        a = abs(e / m)
                    sse += error * error
                    f = a * y + (1 - a) * f
                rows.append((current[0], block.as_py(), order, {"f": f, "e": e, "m": m, "a": a}, sse, len(values), times[-1],
                             [{"t": t, "f": x} for t, x in zip(times, fitted)]))
                order += 1
            kinds = [batch.schema.field(group).type, pa.int64(), pa.int32(), pa.struct([(c, pa.float64()) for c in "fema"]),
                     pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("t", pa.int64()), ("f", pa.float64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)

    # Sorting a task's blocks spills; only the block at hand is in the worker.
    ordered = blocks.select(group, F.col("BLOCK").cast("bigint"), "ALPHA", "DELTA", "POINTS").repartition(group)
    return ordered.sortWithinPartitions(group, "BLOCK").mapInArrow(run, schema)


def _run(blocks: DataFrame, settings: DataFrame, group: str, range_blocks: int) -> DataFrame:
    with_settings = blocks.join(settings, group)
    constant = with_settings.filter("ADAPTIVE_METHOD = 0")
    done = _unfolded(constant.join(_entering(constant, group, range_blocks), [group, "BLOCK"]), group)
    if not settings.filter("ADAPTIVE_METHOD > 0").isEmpty():
        done = done.unionByName(_carried(with_settings.filter("ADAPTIVE_METHOD > 0"), group))
    return snapshot(done, label="smoothing")


def ses_forecast(
    df: DataFrame,
    group: str,
    time: str,
    value: str,
    params: DataFrame,
    block_points: int = BLOCK_POINTS,
    range_blocks: int = RANGE_BLOCKS,
) -> tuple[DataFrame, DataFrame]:
    """Forecast every group that has parameter rows; ``(forecast, statistics)``.

    ``forecast`` is ``(group, time, value, PI1_LOWER, PI1_UPPER, PI2_LOWER,
    PI2_UPPER, PI1_LEVEL, PI2_LEVEL)``: the one-step forecasts of the observed
    points from the second on (if EXPOST_FLAG = 1, intervals NULL), then
    FORECAST_NUM future steps. ``statistics`` is ``(group, STAT_NAME, STAT_VALUE)``
    with the mean squared one-step error.
    """
    settings = group_settings(params, group)
    matched = df.join(settings.select(group), group, "left_semi")
    blocks = snapshot(_blocks(matched, group, time, value, block_points), label="blocks")
    run = _run(blocks, settings, group, range_blocks)

    totals = run.groupBy(group).agg(
        F.sum("SSE").alias("SSE"),
        F.sum("N").alias("N"),
        F.max("LAST").alias("LAST"),
        F.max_by("STATE", "BLOCK").alias("STATE"),
    )
    # The first point has no forecast of its own and adds no error.
    mse = F.try_divide(F.col("SSE"), F.col("N") - 1)
    finals = totals.join(settings, group).withColumn("MSE", mse)
    kind = df.schema[time].dataType

    horizon = F.col("h")
    spread = F.sqrt(F.col("MSE")) * F.sqrt(1 + (horizon - 1) * F.pow(F.col("STATE.a"), F.lit(2.0)))
    future = (
        finals.filter("FORECAST_NUM >= 1")
        .withColumn("h", F.explode(F.sequence(F.lit(1), F.col("FORECAST_NUM").cast("int"))))
        .select(
            group,
            (F.col("LAST") + horizon).cast(kind).alias(time),
            F.col("STATE.f").alias(value),
            *[
                (F.col("STATE.f") + sign * F.col(f"Z{i}") * spread).alias(f"PI{i}_{side}")
                for i in (1, 2)
                for side, sign in (("LOWER", -1), ("UPPER", 1))
            ],
            *[F.col(f"PREDICTION_CONFIDENCE_{i}").alias(f"PI{i}_LEVEL") for i in (1, 2)],
        )
    )
    shown = run.join(settings.filter("EXPOST_FLAG = 1"), group)
    known = F.when(F.col("ORD") == 0, F.slice("FITTED", F.lit(2), F.size("FITTED"))).otherwise(F.col("FITTED"))
    empty = F.lit(None).cast("double")
    past = shown.select(
        group, F.inline(known).alias("t", "f"), *[f"PREDICTION_CONFIDENCE_{i}" for i in (1, 2)]
    ).select(
        group,
        F.col("t").cast(kind).alias(time),
        F.col("f").alias(value),
        *[empty.alias(f"PI{i}_{side}") for i in (1, 2) for side in ("LOWER", "UPPER")],
        *[F.col(f"PREDICTION_CONFIDENCE_{i}").alias(f"PI{i}_LEVEL") for i in (1, 2)],
    )
    stats = finals.select(group, F.lit("MSE").alias("STAT_NAME"), F.col("MSE").alias("STAT_VALUE"))
    return past.unionByName(future), stats
