"""A small forest with given splits, its leaf counts taken from the training split.

Training picks its own splits, which no other engine reproduces. With the splits
given, everything after them (counts, votes, confidence, areas, rules, registry
text) follows from the tables and can be checked by plain SQL.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.operators.leaf_counts import fill_counts
from tallgrove.operators.nodes import NODE_SCHEMA
from tallgrove.operators.sampling import TRAIN, stratified_partition
from tallgrove.operators.scoring import Model, Tree, load_model
from tallgrove.sources import features as ft
from tallgrove.sources.model_rows import Header, encode
from tallgrove.sources.tables import snapshot

SEED = 23
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FEATURES = (
    ("ServiceType", SEGMENTS),
    ("DataUsage_PCT", None),
    ("Revenue_Month", None),
    ("Revenue_Month_PM", None),
    ("CustomerLifetimeValue_USD", None),
)


def _number(feature: str, threshold: float, left: int, right: int) -> dict:
    return {"FEATURE": feature, "THRESHOLD": threshold, "LEFT": left, "RIGHT": right}


def _among(feature: str, values: list[str], left: int, right: int) -> dict:
    return {"FEATURE": feature, "CATEGORIES": values, "LEFT": left, "RIGHT": right}


def _tree(weight: float, inner: dict[int, dict], leaves: list[int]) -> Tree:
    nodes = {**inner, **{n: {"LEFT": -1, "RIGHT": -1} for n in leaves}}
    return Tree(weight, {n: {**node, "NODE": n} for n, node in nodes.items()})


def given_trees(later_weight: float = 1.0) -> list[Tree]:
    return [
        _tree(1.0, {
            0: _number("Revenue_Month", 100000.0, 1, 4),
            1: _number("DataUsage_PCT", 0.0, 2, 3),
            4: _number("CustomerLifetimeValue_USD", 1200000.0, 5, 6),
        }, [2, 3, 5, 6]),
        _tree(later_weight, {
            0: _number("CustomerLifetimeValue_USD", 900000.0, 1, 4),
            1: _number("Revenue_Month_PM", 50000.0, 2, 3),
            4: _number("Revenue_Month", 0.0, 5, 6),
        }, [2, 3, 5, 6]),
        _tree(later_weight, {
            0: _among("ServiceType", ["BUILDING", "MACHINERY"], 1, 4),
            1: _number("DataUsage_PCT", 1.0, 2, 3),
        }, [2, 3, 4]),
    ]


def header(kind: str) -> Header:
    return Header(kind, (ft.NEGATIVE, ft.POSITIVE), FEATURES)


@lru_cache(maxsize=32)
def feature_table(spark: SparkSession, directory: str) -> DataFrame:
    """The labelled view as a stored table: split, training and scoring all read it."""
    return snapshot(ft.churn_view(spark, directory), label="features")


@lru_cache(maxsize=32)
def wholesale_table(spark: SparkSession, directory: str) -> DataFrame:
    """Spend per buyer as a stored table."""
    return snapshot(ft.wholesale_view(spark, directory), label="wholesale")


@lru_cache(maxsize=32)
def tagged_view(spark: SparkSession, directory: str) -> DataFrame:
    """The labelled rows with their part: 60, 20 and 20 percent for train, test, validation."""
    return stratified_partition(
        feature_table(spark, directory), ft.ID, ft.LABEL, (0.6, 0.2, 0.2), SEED, check_ids=False, keep_columns=True
    )


def assignment(spark: SparkSession, directory: str) -> DataFrame:
    """``(id, part)`` alone."""
    return tagged_view(spark, directory).select(ft.ID, "PARTITION_TYPE")


def part_of_view(spark: SparkSession, directory: str, part: int) -> DataFrame:
    return tagged_view(spark, directory).filter(F.col("PARTITION_TYPE") == part).drop("PARTITION_TYPE")


def node_rows(spark: SparkSession, directory: str, kind: str = "forest", later_weight: float = 1.0) -> DataFrame:
    train = part_of_view(spark, directory, TRAIN)
    trees = given_trees(later_weight)
    return fill_counts(train, header(kind), trees[:1] if kind == "tree" else trees, ft.LABEL)


@lru_cache(maxsize=32)
def model_rows(spark: SparkSession, directory: str, kind: str = "forest", later_weight: float = 1.0) -> DataFrame:
    """The model's rows as a stored table."""
    return snapshot(encode(header(kind), node_rows(spark, directory, kind, later_weight)), label="model-rows")


@lru_cache(maxsize=32)
def model(spark: SparkSession, directory: str, kind: str = "forest", later_weight: float = 1.0) -> Model:
    return load_model(model_rows(spark, directory, kind, later_weight))


def forget() -> None:
    """Drop what is kept, so that the next query splits and counts again."""
    for kept in (feature_table, wholesale_table, tagged_view):
        kept.cache_clear()
    model_rows.cache_clear()
    model.cache_clear()


def probability(name: str = "CHURN_PROBABILITY"):
    """Probability of the positive class from SCORE and CONFIDENCE, rounded for ties."""
    confidence = F.col("CONFIDENCE")
    return F.round(F.when(F.col("SCORE") == ft.POSITIVE, confidence).otherwise(1 - confidence), 9).alias(name)


def three_class_rows(spark: SparkSession) -> DataFrame:
    """Model rows of two boosted stumps for each of three classes of customers."""
    segments = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    features = (("c_mktsegment", segments), ("c_acctbal", None), ("c_nationkey", None))
    header = Header("boosted", ("gold", "plain", "risk"), features)
    stumps = [  # class, weight, feature, threshold or categories, value to the left, value to the right
        (0, 1.0, "c_acctbal", 3000.0, -0.8, 0.9),
        (0, 0.3, "c_mktsegment", ["BUILDING", "MACHINERY"], 0.3, -0.2),
        (1, 1.0, "c_acctbal", 6000.0, 0.5, -0.6),
        (1, 0.3, "c_nationkey", 12.0, 0.25, -0.15),
        (2, 1.0, "c_acctbal", 0.0, 1.1, -0.7),
        (2, 0.3, "c_mktsegment", ["HOUSEHOLD"], 0.4, -0.1),
    ]
    nodes = []
    for tree, (of_class, weight, feature, cut, left, right) in enumerate(stumps):
        threshold, categories = (None, cut) if isinstance(cut, list) else (cut, None)
        nodes.append((tree, weight, 0, feature, threshold, categories, 1, 2, None, 0.0, None, None, of_class))
        for node, value in ((1, left), (2, right)):
            nodes.append((tree, weight, node, None, None, None, -1, -1, None, value, None, None, of_class))
    return encode(header, spark.createDataFrame(nodes, f"{NODE_SCHEMA}, CLASS int"))
