"""Forests with explicit bags, and their out-of-bag error.

Spark's forest keeps its bootstrap samples to itself. Here the number of times
a row is in the bag of tree t is a Poisson(1) draw, number t of the row's own
stream, so it can be recomputed anywhere; tree t is fitted with it as row weight.

A stream starts at two numbers of one digest of (seed, id). Draw t mixes them with the
tree's two factors, in whole numbers below 2**63, so SQL, columns and numpy agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallgrove.functions.params import Params
from tallgrove.operators.nodes import NODE_SCHEMA, export_nodes
from tallgrove.operators.scoring import Descent, Model, feature_value, trees_of
from tallgrove.operators.training import Prepared, TrainResult, finish, forest_estimator, tell_depth
from tallgrove.sources.tables import bounded

MAX_DRAWS = 12  # P(Poisson(1) > 12) is below 1e-10
# A prime below 2**31 and two of its primitive roots.
PRIME = 2**31 - 1
GENERATORS = (48271, 69621)
BATCH = 10_000  # rows whose draws for all trees are held at once
PARALLEL_FITS = 8  # a single fit waits for the driver between its many small jobs


def stream_start(id_column: str, seed: int) -> tuple[Column, Column]:
    """Where the row's draws start: two whole numbers below ``PRIME``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))
    first, second = (F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") % PRIME for at in (1, 9))
    return first, second


def tree_factors(tree: int) -> tuple[int, int]:
    return tuple(pow(g, tree + 1, PRIME) for g in GENERATORS)


def cumulative_draws() -> list[float]:
    """Distribution function of Poisson(1) at 0, 1, ..., MAX_DRAWS - 1."""
    out = []
    for k in range(MAX_DRAWS):
        out.append((out[-1] if out else 0.0) + math.exp(-1) / math.factorial(k))
    return out


def bag_weight(id_column: str, seed: int, tree: int) -> Column:
    """How often the row is in the bag of ``tree``: Poisson(1) by inverse CDF."""
    (first, second), (a, b) = stream_start(id_column, seed), tree_factors(tree)
    mixed = (first * F.lit(a).cast("bigint") + F.lit(b).cast("bigint")) % PRIME
    uniform = ((mixed * mixed + second) % PRIME).cast("double") / PRIME
    weight = F
    for k, bound in enumerate(cumulative_draws()):
        weight = weight.when(uniform < bound, float(k))
    return weight.otherwise(float(MAX_DRAWS))


def bag_weights(first: np.ndarray, second: np.ndarray, trees: int) -> np.ndarray:
    """``bag_weight`` of rows x trees, from the rows' stream starts."""
    a, b = (np.array(f, np.int64) for f in zip(*map(tree_factors, range(trees))))
    mixed = (np.asarray(first, np.int64)[:, None] * a + b) % PRIME
    uniform = ((mixed * mixed + np.asarray(second, np.int64)[:, None]) % PRIME) / PRIME
    return np.searchsorted(cumulative_draws(), uniform, side="right")


def bag_counts(df: DataFrame, id_column: str, seed: int, trees: int) -> DataFrame:
    """``(TREE_INDEX, N_OUTSIDE, N_DRAWN)``: rows outside each bag, and the rows it holds with repetition.

    Rows without an id are in no bag and are not counted.
    """
    first, second = stream_start(id_column, seed)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        outside, drawn = np.zeros(trees, np.int64), np.zeros(trees, np.int64)
        for rows in batches:
            for at in range(0, len(rows), BATCH):
                part = rows.iloc[at : at + BATCH]
                weights = bag_weights(part["a"].to_numpy(), part["b"].to_numpy(), trees)
                outside += (weights == 0).sum(axis=0)
                drawn += weights.sum(axis=0)
        yield pd.DataFrame({"TREE_INDEX": range(trees), "N_OUTSIDE": outside, "N_DRAWN": drawn})

    starts = df.filter(F.col(id_column).isNotNull()).select(first.alias("a"), second.alias("b"))
    counts = starts.mapInPandas(count, "TREE_INDEX int, N_OUTSIDE long, N_DRAWN long")
    return counts.groupBy("TREE_INDEX").agg(F.sum("N_OUTSIDE").alias("N_OUTSIDE"), F.sum("N_DRAWN").alias("N_DRAWN"))


def train_with_bags(prepared: Prepared, params: Params, max_depth: int) -> TrainResult:
    """Fit every tree on its own bag and report the error of rows outside the bags."""
    id_column = prepared.roles.id
    if id_column is None:
        raise ValueError("the out-of-bag error needs an id column (HAS_ID = 1)")
    spark = prepared.rows.sparkSession
    seed, trees = params.whole("SEED", 0), params.whole("TREES_NUM", 100)
    header = prepared.header("forest")

    def fit(t: int) -> tuple[np.ndarray, list[Row]]:
        rows = prepared.rows.withColumn("_w", bag_weight(id_column, seed, t)).filter("_w > 0")
        estimator = forest_estimator(
            prepared, params, max_depth, numTrees=1, bootstrap=False, seed=seed + t, weightCol="_w"
        )
        model = estimator.fit(rows)
        # A forest of one tree numbers it 0.
        nodes = export_nodes(model, header, spark).withColumn("TREE", F.lit(t)).withColumn("WEIGHT", F.lit(1.0))
        return model.featureImportances.toArray(), nodes.collect()  # the nodes of one tree

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        fitted = list(pool.map(fit, range(trees)))
    rows = [node for _, tree in fitted for node in tree]
    tell_depth([tree.depth for tree in trees_of(rows)], max_depth)
    columns = [field.split()[0] for field in NODE_SCHEMA.split(", ")]
    nodes = spark.createDataFrame([tuple(node[c] for c in columns) for node in rows], NODE_SCHEMA)
    mean = np.mean([i for i, _ in fitted], axis=0)
    mean = mean / mean.sum() if mean.sum() else mean
    importance = spark.createDataFrame(
        [(name, float(v)) for (name, _), v in zip(header.features, mean)], "COLUMN_NAME string, IMPORTANCE double"
    )
    result = finish(prepared, header, nodes, importance)
    labelled = prepared.source.filter(F.col(prepared.roles.label).isNotNull())
    result.oob = oob_error(labelled, result.model, id_column, prepared.roles.label, seed)
    return result


def oob_error(df: DataFrame, model: Model, id_column: str, label: str, seed: int) -> DataFrame:
    """``(TREE_INDEX, OOB_ERROR)``: error up to each tree among rows outside some bag.

    One pass descends all trees per batch and adds the batch's marks (right, wrong) up
    before anything is shuffled: a batch gives one row per tree. The draws of a row for all trees come
    from one digest. The curve, a row a tree, is computed at once, so that the trees can be released.
    """
    header, trees = model.header, model.trees
    shared = df.sparkSession.sparkContext.broadcast(Descent(header, trees, "hard"))
    first, second = stream_start(id_column, seed)
    inputs = df.select(
        *[feature_value(header, name).alias(name) for name, _ in header.features],
        F.col(label).cast("string").alias("_truth"), first.alias("_first"), second.alias("_second"),
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        descent = shared.value
        names = np.array(header.labels, dtype=object)
        for rows in batches:
            if rows.empty:
                continue
            x, truth = descent.matrix(rows), rows["_truth"].to_numpy()
            out = bag_weights(rows["_first"].to_numpy(), rows["_second"].to_numpy(), len(descent.roots)) == 0
            votes = np.zeros((len(x), len(names)))
            seen = np.zeros(len(x), dtype=bool)
            wrong, counted = [], []
            for t, root in enumerate(descent.roots):
                here = out[:, t]
                votes[here] += descent.payload[descent.leaves(x[here], root)]
                seen |= here
                wrong.append(int((seen & (names[votes.argmax(axis=1)] != truth)).sum()))
                counted.append(int(seen.sum()))
            yield pd.DataFrame({"TREE_INDEX": range(len(wrong)), "WRONG": wrong, "COUNTED": counted})

    marks = inputs.mapInPandas(count, "TREE_INDEX int, WRONG long, COUNTED long")
    curve = marks.groupBy("TREE_INDEX").agg(F.try_divide(F.sum("WRONG"), F.sum("COUNTED")).alias("OOB_ERROR"))
    done = bounded(curve, max_rows=len(trees))
    shared.destroy()
    return done
