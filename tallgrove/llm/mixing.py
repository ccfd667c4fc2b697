"""Mixing sources to target weights: hash-random keys, ranges of keys, prefix sums, one cut per source.

Every document gets a random key from a hash of its id. Keys are dealt into ranges;
sizes are added up per (source, range) and the ranges' sums are prefixed in key order.
A source's budget then falls into one range, and only that range's documents are sorted
and prefixed one by one; all others are known to be taken or not from their range alone.
No document moves but those few, whatever share of the rows one source holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrove.llm.frames import stored, without

WORD = r"[^\x20\x09-\x0D]+"
KEY_HEX = 15
#: Ranges of keys in a source; a range of the largest source is what one task sorts.
RANGE_BITS = 12

OUTPUT = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def random_key(identity: Column, seed: int) -> Column:
    """60 random bits from the id; equal ids have equal keys."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, KEY_HEX), 16, 10).cast("long")


def shares(sizes: DataFrame, weights: Sequence[float], epochs: float, share: float) -> DataFrame:
    """Targets of (source, source_size) rows: by weight, none above ``epochs`` times its size.

    Weights repeat over the sources in code point order, null last. In the order of
    limit / weight the sources that meet their limit come first; the level of the others
    is what is left over by the weight that is left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    weighed = sizes.withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]),
            ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
        ),
    ).withColumn("limit", epochs * F.col("source_size"))
    levels = (
        weighed.withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("all", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("spent", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(after))
        .withColumn("level", (share * F.col("all") - F.col("spent")) / F.col("left"))
    )
    opened = F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("place"))
    first = F.min(opened).over(Window.partitionBy())
    level = F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(Window.partitionBy())
    return (
        levels.withColumn("first", first)
        .withColumn("common", level)
        .withColumn(
            "target",
            F.when(F.col("first").isNull() | (F.col("place") < F.col("first")), F.col("limit")).otherwise(
                F.col("common") * F.col("weight")
            ),
        )
        .select("source", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: int = 11,
    size: Column | None = None,
) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words the mix takes, repeats counted).

    A source is read whole as often as its budget (the target's whole words) allows, then in
    key order up to the exact budget; the document at the cut gives its first words only.
    A null source is a source of its own, a null text or one without words has size 0 and is
    never taken; an empty table gives no rows. Rows with one id share a key and are ordered by
    size; equal rows are alike, so it makes no difference which comes first. Input columns named like the output are
    replaced, other columns stay.
    """
    size = word_count(F.col("text")) if size is None else size
    rows = (
        docs.withColumn("_mix_size", size)
        .withColumn("_mix_key", random_key(F.col("doc_id"), seed))
        .withColumn("_mix_range", F.shiftright("_mix_key", 4 * KEY_HEX - RANGE_BITS).cast("int"))
    )
    rows = without(rows, *OUTPUT)
    ranges = stored(
        rows.groupBy("source", F.col("_mix_range").alias("range")).agg(F.sum("_mix_size").alias("words")), "mix-ranges"
    )
    targets = shares(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs, share)
    budgets = (
        targets.withColumn("budget", F.floor("target").cast("long"))
        .withColumn("whole", F.expr("if(source_size > 0, budget div source_size, 0L)"))
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "of")
    )
    in_order = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    prefixed = ranges.withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0).cast("long")))
    cut = prefixed.join(budgets, F.col("source").eqNullSafe(F.col("of"))).filter(
        (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest"))
    )
    plan = stored(
        budgets.join(
            cut.select(F.col("of").alias("cut_of"), "range", "before"), F.col("of").eqNullSafe(F.col("cut_of")), "left"
        ).select(
            F.col("of").alias("_mix_of"),
            F.col("source_size").alias("_mix_total"),
            F.col("target").alias("_mix_target"),
            F.col("whole").alias("_mix_whole"),
            F.col("rest").alias("_mix_rest"),
            F.coalesce(F.col("range"), F.lit(-1)).alias("_mix_cut"),
            F.coalesce(F.col("before"), F.lit(0).cast("long")).alias("_mix_before"),
        ),
        "mix-plan",
    )
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_mix_of")))
    sure = joined.filter("_mix_range <> _mix_cut").withColumn(
        "_mix_part", F.expr("if(_mix_range < _mix_cut, _mix_size, 0L)")
    )
    order = Window.partitionBy("_mix_of").orderBy("_mix_key", "doc_id", "_mix_size")
    earlier = F.coalesce(
        F.sum("_mix_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")
    )
    at_cut = (
        joined.filter("_mix_range = _mix_cut")
        .withColumn("_mix_earlier", F.col("_mix_before") + earlier)
        .withColumn("_mix_part", F.expr("greatest(0L, least(_mix_size, _mix_rest - _mix_earlier))"))
        .drop("_mix_earlier")
    )
    taken = sure.unionByName(at_cut)
    kept = [c for c in rows.columns if not c.startswith("_mix_")]
    return taken.select(
        *kept,
        F.col("_mix_size").alias("size"),
        F.col("_mix_total").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_whole") * F.col("_mix_size") + F.col("_mix_part")).alias("taken"),
    )
