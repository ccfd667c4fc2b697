"""Class counts for trees whose splits are given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.operators.nodes import NODE_SCHEMA
from tallgrove.operators.scoring import Tree, walk_expression
from tallgrove.sources.model_rows import Header


def gini(counts: list[float]) -> float:
    total = sum(counts)
    return 1.0 - sum((c / total) ** 2 for c in counts) if total else 0.0


def count_leaves(df: DataFrame, header: Header, trees: list[Tree], label: str) -> DataFrame:
    """``(TREE, NODE, LABEL, ROWS)``: training rows per leaf and class in one pass.

    Rows are added up per task; the shuffle carries one row per leaf and class.
    """
    leaves = F.array(*[walk_expression(header, tree, lambda node: F.lit(node)) for tree in trees])
    return (
        df.filter(F.col(label).isNotNull())
        .select(F.col(label).cast("string").alias("LABEL"), F.posexplode(leaves).alias("TREE", "NODE"))
        .groupBy("TREE", "NODE", "LABEL")
        .agg(F.count(F.lit(1)).alias("ROWS"))
    )


def fill_counts(df: DataFrame, header: Header, trees: list[Tree], label: str) -> DataFrame:
    """Node rows for the given splits with counts, gain and leaf value from ``df``.

    ``VALUE`` is the class index with most rows, or for a boosted header the
    difference of the class shares (second minus first).
    """
    seen = {(r["TREE"], r["NODE"], r["LABEL"]): r["ROWS"] for r in count_leaves(df, header, trees, label).collect()}
    rows = []
    for t, tree in enumerate(trees):
        counts: dict[int, list[float]] = {}
        for number in reversed(tree.reachable()):  # children before parents
            node = tree.nodes[number]
            if tree.is_leaf(number):
                counts[number] = [float(seen.get((t, number, name), 0)) for name in header.labels]
            else:
                counts[number] = [a + b for a, b in zip(counts[node["LEFT"]], counts[node["RIGHT"]])]
        for number in tree.reachable():
            node, mine = tree.nodes[number], counts[number]
            total, gain = sum(mine), -1.0
            if not tree.is_leaf(number):
                left, right = counts[node["LEFT"]], counts[node["RIGHT"]]
                parts = sum(left) * gini(left) + sum(right) * gini(right)
                gain = gini(mine) - parts / total if total else 0.0
            value = float(mine.index(max(mine)))
            if header.kind == "boosted":
                value = round((mine[1] - mine[0]) / total, 6) if total else 0.0
            rows.append((
                t, tree.weight, number, node.get("FEATURE"), node.get("THRESHOLD"), node.get("CATEGORIES"),
                node.get("LEFT", -1), node.get("RIGHT", -1), mine, value, int(total), gain,
            ))
    return df.sparkSession.createDataFrame(rows, NODE_SCHEMA)
