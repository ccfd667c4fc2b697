"""Tree nodes as a relation: export from MLlib, pruning, rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.sources.model_rows import Header
from tallgrove.sources.tables import scratch_path, snapshot

# The slot of values the indexer has not seen; no category can be NULL.
UNSEEN = None

NODE_SCHEMA = (
    "TREE int, WEIGHT double, NODE int, FEATURE string, THRESHOLD double, CATEGORIES array<string>,"
    " LEFT int, RIGHT int, COUNTS array<double>, VALUE double, RAW_COUNT long, GAIN double"
)


def _feature_name(header: Header, index: Column) -> Column:
    names = F.array(*[F.lit(name) for name, _ in header.features])
    return F.when(index >= 0, F.element_at(names, index + 1))


def export_nodes(model, header: Header, spark: SparkSession, tree: int = 0) -> DataFrame:
    """The node rows of a fitted MLlib tree model, read from its saved form.

    Category indexes become category values, so rows can be scored without the
    indexer. ``tree`` numbers a single tree.
    """
    path = scratch_path(spark, "fitted")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "_meta", "WEIGHT")
        data = data.select("treeID", "nodeData.*").join(weights.select("treeID", "WEIGHT"), "treeID")
        numbered = data.withColumnRenamed("treeID", "TREE")
    else:
        numbered = data.withColumn("TREE", F.lit(tree)).withColumn("WEIGHT", F.lit(1.0))
    index = F.col("split.featureIndex")
    values = F.col("split.leftCategoriesOrThreshold")
    categories = F.lit(None).cast("array<string>")
    for i, (_, known) in enumerate(header.features):
        if known is not None:
            names = F.array(*[F.lit(v) for v in (*known, UNSEEN)])
            categories = F.when(
                index == i, F.transform(values, lambda v: F.element_at(names, v.cast("int") + 1))
            ).otherwise(categories)
    return numbered.select(
        "TREE",
        "WEIGHT",
        F.col("id").alias("NODE"),
        _feature_name(header, index).alias("FEATURE"),
        F.when((index >= 0) & (F.col("split.numCategories") < 0), F.element_at(values, 1)).alias("THRESHOLD"),
        categories.alias("CATEGORIES"),
        F.col("leftChild").alias("LEFT"),
        F.col("rightChild").alias("RIGHT"),
        F.col("impurityStats").alias("COUNTS"),
        F.col("prediction").alias("VALUE"),
        F.col("rawCount").alias("RAW_COUNT"),
        F.col("gain").alias("GAIN"),
    )


def prune(nodes: DataFrame, min_parent: float = 0, min_gain: float = 0.0) -> DataFrame:
    """Turn inner nodes with too few rows or too little gain into leaves.

    A node's best split does not depend on either limit, so one fit with the
    loosest limits contains the tree of every stricter setting. Nodes below a
    cut stay in the relation but cannot be reached.
    """
    cut = (F.col("RAW_COUNT") < min_parent) | (F.col("GAIN") < min_gain)
    return nodes.withColumn("LEFT", F.when(cut, -1).otherwise(F.col("LEFT"))).withColumn(
        "RIGHT", F.when(cut, -1).otherwise(F.col("RIGHT"))
    )


def tree_rules(nodes: DataFrame, labels: list[str] | tuple[str, ...]) -> DataFrame:
    """``(TREE, ROW_INDEX, RULES_CONTENT)``: the path of conditions to every leaf.

    Paths grow one level per step by a join of the frontier with its children;
    the number of steps is the depth of the trees.
    """
    condition = F.when(
        F.col("THRESHOLD").isNotNull(),
        F.concat(F.col("FEATURE"), F.lit(" <= "), F.col("THRESHOLD").cast("string")),
    ).otherwise(F.concat(F.col("FEATURE"), F.lit(" in {"), F.concat_ws(", ", F.transform("CATEGORIES", lambda c: F.coalesce(c, F.lit("any other")))), F.lit("}")))
    nodes = snapshot(nodes.select("TREE", "NODE", "LEFT", "RIGHT", "COUNTS", condition.alias("TEST")), label="rules")
    frontier = nodes.filter("NODE = 0").select("*", F.array().cast("array<string>").alias("PATH"))
    leaves = frontier.filter("LEFT < 0")
    frontier = frontier.filter("LEFT >= 0")
    while not frontier.isEmpty():
        steps = frontier.select(
            "TREE",
            F.inline(F.array(
                F.struct(F.col("LEFT").alias("NODE"), F.array_append("PATH", F.col("TEST")).alias("PATH")),
                F.struct(
                    F.col("RIGHT").alias("NODE"),
                    F.array_append("PATH", F.concat(F.lit("not "), F.col("TEST"))).alias("PATH"),
                ),
            )),
        )
        grown = snapshot(nodes.join(steps, ["TREE", "NODE"]), label="rules")  # no level computes those above again
        leaves = leaves.unionByName(grown.filter("LEFT < 0"))
        frontier = grown.filter("LEFT >= 0")
    names = F.array(*[F.lit(label) for label in labels])
    best = F.array_position("COUNTS", F.array_max("COUNTS")).cast("int")
    rule = F.concat(
        F.when(F.size("PATH") == 0, F.lit("all rows")).otherwise(F.concat_ws(" and ", "PATH")),
        F.lit(" => "),
        F.element_at(names, best),
    )
    return leaves.select("TREE", F.col("NODE").alias("ROW_INDEX"), rule.alias("RULES_CONTENT"))
