"""Order statistics and running totals that no single task has to hold.

``row_number() over (partition by stratum)`` puts a whole stratum into one task,
and strata are few. Both helpers here split a group into buckets of the sort
key, aggregate the buckets, and only then look at rows.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrove.sources.tables import bounded, counted_snapshot, matching

HASH_DIGITS = 4  # 65 536 buckets per group
ROWS_PER_BUCKET = 1_000_000


def shuffle_key(id_column: str | Column, seed: int) -> Column:
    """A reproducible pseudo-random key, the same in any engine with md5."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))


def exact_cuts(df: DataFrame, by: list[str], key: str, tie: str, quotas: list[str]) -> DataFrame:
    """The rows found at the quota ranks of every group, ordered by ``(key, tie)``.

    ``quotas`` are SQL expressions over the group size ``TOTAL``, not decreasing.
    Only the few hash buckets that contain a wanted rank are ever sorted. Returns
    ``(*by, QUOTAS, CUTS)`` where ``CUTS`` is an array of ``(rank, key, tie)``.
    """
    bucketed = df.withColumn("_bucket", F.substring(key, 1, HASH_DIGITS))
    counts = bucketed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most 16 ** HASH_DIGITS rows per group reach this window.
    group = Window.partitionBy(*by)
    upto = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        counts.withColumn("TOTAL", F.sum("_n").over(group))
        .withColumn("_start", F.sum("_n").over(upto) - F.col("_n"))
        .withColumn("QUOTAS", F.array(*[F.expr(q).cast("bigint") for q in quotas]))
        .withColumn("_wanted", F.filter(
            "QUOTAS", lambda r: (r > F.col("_start")) & (r <= F.col("_start") + F.col("_n"))
        ))
        .filter(F.size("_wanted") > 0)
        .select(*by, "_bucket", "_start", "_wanted", "QUOTAS")
    )
    edges = bounded(placed)
    keys = [*by, "_bucket"]
    inside = bucketed.join(edges, matching(bucketed, edges, keys)).select(
        *[bucketed[c] for c in (*keys, key, tie)], *[edges[c] for c in ("_start", "_wanted", "QUOTAS")]
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(key, tie)) + F.col("_start")
    return (
        inside.withColumn("rank", rank)
        .filter(F.array_contains("_wanted", F.col("rank")))
        .groupBy(*by)
        .agg(
            F.first("QUOTAS").alias("QUOTAS"),
            F.array_sort(F.collect_list(F.struct("rank", key, tie))).alias("CUTS"),
        )
    )


def distributed_rank(df: DataFrame, by: list[str], key: str, tie: str, digits: int = HASH_DIGITS) -> DataFrame:
    """``df`` with RANK (from 1, in the order of ``(key, tie)``) and TOTAL of its group.

    ``key`` is a hash text as ``shuffle_key`` makes it. Rows are counted per bucket of the key's first ``digits``; a bucket's
    rank begins after those before it, and only rows of one bucket are sorted together. A NULL group is a group; NULL
    keys come first, as in Spark's order.
    """
    bucketed = df.withColumn("_bucket", F.coalesce(F.substring(key, 1, digits), F.lit("")))
    keys = [*by, "_bucket"]
    counts = bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # At most 16 ** digits rows per group reach this window.
    group = Window.partitionBy(*by)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = bounded(counts.select(
        *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(group).alias("TOTAL")
    ))
    inside = Window.partitionBy(*keys).orderBy(key, tie)
    local = bucketed.withColumn("_local", F.row_number().over(inside))
    joined = local.join(starts, matching(local, starts, keys))
    return joined.select(*[local[c] for c in df.columns], (F.col("_start") + F.col("_local")).alias("RANK"), "TOTAL")


def positions(df: DataFrame, by: str, order: list[str | Column]) -> DataFrame:
    """``df`` with POSITION (from 1) in the order of ``(by, *order)`` within each value of ``by``.

    The rows are sorted by ranges of the whole order and stored; a range's positions begin after those of the
    ranges before it, so a value that half of all rows have is spread over as many tasks as it fills ranges.
    """
    sorted_rows = df.orderBy(by, *order).withColumn("_at", F.monotonically_increasing_id())
    stored, _ = counted_snapshot(sorted_rows, label="ordered")
    ranged = stored.withColumn("_range", F.shiftright("_at", 33))
    keys = [by, "_range"]
    counts = ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = bounded(counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy("_at")))
    joined = local.join(starts, matching(local, starts, keys))
    return joined.select(*[local[c] for c in df.columns], (F.col("_start") + F.col("_local")).cast("bigint").alias("POSITION"))


def running_totals(
    df: DataFrame,
    by: list[str],
    order: str,
    sums: list[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Sums over all rows of the group with a strictly larger ``order`` value.

    ``df`` has one row per ``(*by, order)``. Adds ``<sum>_before`` per column of
    ``sums``, ``<sum>_all`` for the group total, and ``position`` (1 = largest).
    NaN counts as the largest value and NULL as the smallest. The value range is cut
    at measured quantiles into pieces of about ``rows_per_bucket`` rows, so every
    window task holds about that many whatever the distribution; a small relation is
    one piece of the same plan.
    """
    stored, rows = counted_snapshot(df, label="running-totals")
    pieces = max(1, -(-rows // rows_per_bucket))
    shares = [i / pieces for i in range(1, pieces)]
    bounds = sorted(set(stored.approxQuantile(order, shares, 1 / (4 * pieces)))) if shares else []
    # Cutting needs numbers that compare; inside a piece Spark's own order applies.
    place = F.coalesce(F.when(F.isnan(order), float("inf")).otherwise(F.col(order)), F.lit(float("-inf")))
    cut = stored.withColumn("_one", F.lit(1).cast("bigint")).withColumn("_place", place)
    if bounds:
        splits = [float("-inf"), *bounds, float("inf")]
        cut = Bucketizer(splits=splits, inputCol="_place", outputCol="_piece").transform(cut)
    else:
        cut = cut.withColumn("_piece", F.lit(0.0))
    measures = [*sums, "_one"]

    keys = [*by, "_piece"]
    totals = cut.groupBy(*keys).agg(*[F.sum(m).alias(f"{m}_sum") for m in measures])
    # One row per group and piece, so the group windows stay short.
    group = Window.partitionBy(*by)
    above = group.orderBy(F.desc("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    for m in measures:
        totals = totals.withColumn(f"{m}_offset", F.coalesce(F.sum(f"{m}_sum").over(above), F.lit(0)))
        totals = totals.withColumn(f"{m}_all", F.sum(f"{m}_sum").over(group))
    totals = bounded(totals.select(*keys, *[f"{m}_{x}" for m in measures for x in ("offset", "all")]))

    local = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    local_sums = cut.select("*", *[
        F.coalesce(F.sum(m).over(local), F.lit(0)).alias(f"{m}_local") for m in measures
    ])
    joined = local_sums.join(totals, matching(local_sums, totals, keys))
    return joined.select(
        *[local_sums[c] for c in (*by, order, *sums)],
        *[(F.col(f"{m}_offset") + F.col(f"{m}_local")).alias(f"{m}_before") for m in sums],
        *[F.col(f"{m}_all") for m in sums],
        (F.col("_one_offset") + F.col("_one_local") + 1).alias("position"),
    )
