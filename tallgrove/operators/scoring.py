"""Scoring rows with a model given as rows.

Scoring is a map: the model travels to the data. A model of a few dozen nodes
becomes a JVM expression; a larger one is broadcast and descended by a
vectorised pandas UDF inside a ``select``, so that filters on the id still reach
the scan. A model beyond the broadcast bound travels as several groups of trees;
their sums are columns of the same ``select`` and are added per row. Rows need no
key and none is moved, whatever the model's size.

A NULL in a number that the model lists is an error for every engine, whether or
not a tree looks at it, unless ``fill`` is given.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrove.operators.nodes import UNSEEN
from tallgrove.sources.model_rows import HEADER, Header, decode

EXPRESSION_NODES = 64  # Spark copies expressions when it moves filters, so only small models
BROADCAST_CHARS = 64_000_000  # text size of the trees that travel at once


@dataclass
class Tree:
    """One tree as parsed from its document: node number to node."""

    weight: float
    nodes: dict[int, dict]
    of_class: int = 0  # whose margin a boosted tree adds to; without classes there is one margin

    @classmethod
    def parse(cls, text: str) -> Tree:
        raw = json.loads(text)
        return cls(raw["WEIGHT"], {n["NODE"]: n for n in raw["NODES"]}, raw.get("CLASS", 0))

    @property
    def depth(self) -> int:
        level, here = 0, [0]
        while here := [c for n in here if not self.is_leaf(n) for c in (self.nodes[n]["LEFT"], self.nodes[n]["RIGHT"])]:
            level += 1
        return level

    def is_leaf(self, node: int) -> bool:
        return self.nodes[node].get("LEFT", -1) < 0

    def reachable(self) -> list[int]:
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            order.append(node)
            if not self.is_leaf(node):
                stack += [self.nodes[node]["RIGHT"], self.nodes[node]["LEFT"]]
        return order

    def pruned(self, min_parent: float, min_gain: float) -> Tree:
        def leaf(n: dict) -> bool:
            return n.get("RAW_COUNT", 0) < min_parent or n.get("GAIN", 0.0) < min_gain

        return Tree(self.weight, {
            k: {**n, "LEFT": -1, "RIGHT": -1} if leaf(n) else n for k, n in self.nodes.items()
        }, self.of_class)


@dataclass
class Model:
    """Header and trees; ``parts`` lists the trees in groups that may be broadcast."""

    header: Header
    parts: list[list[Tree]]
    _shared: dict = field(default_factory=dict, repr=False, compare=False)

    def shared(self, spark: SparkSession, part: int, vote: str):
        """The broadcast descent of one group of trees; sent once per application and vote."""
        key = (spark.sparkContext.applicationId, part, vote)
        if key not in self._shared:
            self._shared[key] = spark.sparkContext.broadcast(Descent(self.header, self.parts[part], vote))
        return self._shared[key]

    def release(self) -> None:
        """Take back what was broadcast; a later scoring sends it anew."""
        for sent in self._shared.values():
            sent.destroy()
        self._shared.clear()

    @property
    def trees(self) -> list[Tree]:
        return [tree for part in self.parts for tree in part]


def trees_of(rows: list) -> list[Tree]:
    """Trees from collected node rows, in the order of their numbers."""
    trees: dict[int, Tree] = {}
    for row in rows:
        node = {k: v for k, v in row.asDict(recursive=True).items() if v is not None}
        trees.setdefault(row["TREE"], Tree(row["WEIGHT"], {}, node.get("CLASS", 0))).nodes[row["NODE"]] = node
    return [trees[number] for number in sorted(trees)]


def load_model(rows: DataFrame, broadcast_chars: int = BROADCAST_CHARS) -> Model:
    """Parse model rows. The training driver held this model, so it fits here."""
    header, parts, size = None, [[]], 0
    for doc in sorted(decode(rows).collect(), key=lambda row: row["DOC"]):
        if doc["DOC"] == HEADER:
            header = Header.from_json(doc["TEXT"])
            continue
        if parts[-1] and size + len(doc["TEXT"]) > broadcast_chars:
            parts.append([])
            size = 0
        size += len(doc["TEXT"])
        parts[-1].append(Tree.parse(doc["TEXT"]))
    if header is None or not parts[0]:
        raise ValueError("the model rows hold no complete model")
    return Model(header, parts)


def _payload(header: Header, tree: Tree, node: dict, vote: str) -> list[float]:
    """What a leaf adds to the row's sum: votes per class, or a margin of its tree's class."""
    if header.kind == "boosted":
        return [tree.weight * node["VALUE"] if i == tree.of_class else 0.0 for i in range(slots(header))]
    counts = node["COUNTS"]
    if header.kind == "forest" and vote == "hard":
        winner = int(np.argmax(counts))  # the first of equals, i.e. the smallest label
        return [1.0 if i == winner else 0.0 for i in range(len(counts))]
    total = sum(counts)
    # Given splits may leave a leaf without training rows: it knows nothing.
    return [c / total if total else 1.0 / len(counts) for c in counts]


class Descent:
    """Trees as flat arrays; many rows walk down together, one level per step."""

    def __init__(self, header: Header, trees: list[Tree], vote: str):
        self.features = header.features
        index = {name: i for i, (name, _) in enumerate(header.features)}
        slots = max([len(c) + 1 for _, c in header.features if c is not None], default=1)
        feature, threshold, left, right, table, payload, subsets = [], [], [], [], [], [], []
        self.roots = []
        for tree in trees:
            place = {node: len(feature) + i for i, node in enumerate(tree.reachable())}
            self.roots.append(place[0])
            for number in place:
                node = tree.nodes[number]
                payload.append(_payload(header, tree, node, vote))
                if tree.is_leaf(number):
                    feature.append(-1)
                    threshold.append(0.0)
                    left.append(-1)
                    right.append(-1)
                    table.append(-1)
                    continue
                f = index[node["FEATURE"]]
                feature.append(f)
                left.append(place[node["LEFT"]])
                right.append(place[node["RIGHT"]])
                threshold.append(node.get("THRESHOLD", 0.0))
                known = header.features[f][1]
                if known is None:
                    table.append(-1)
                else:
                    table.append(len(subsets))
                    chosen = set(node["CATEGORIES"])
                    row = [v in chosen for v in (*known, UNSEEN)]
                    subsets.append(row + [False] * (slots - len(row)))
        self.feature = np.array(feature, dtype=np.int32)
        self.threshold = np.array(threshold)
        self.left = np.array(left, dtype=np.int32)
        self.right = np.array(right, dtype=np.int32)
        self.table = np.array(table, dtype=np.int32)
        self.subsets = np.array(subsets, dtype=bool).reshape(-1, slots)
        self.payload = np.array(payload, dtype=float)

    def matrix(self, rows: pd.DataFrame) -> np.ndarray:
        out = np.empty((len(rows), len(self.features)))
        for i, (name, known) in enumerate(self.features):
            if known is None:
                out[:, i] = rows[name]
            else:
                codes = pd.Categorical(rows[name], categories=list(known)).codes.astype(float)
                out[:, i] = np.where(codes < 0, len(known), codes)
        return out

    def leaves(self, x: np.ndarray, root: int) -> np.ndarray:
        node = np.full(len(x), root, dtype=np.int32)
        rows = np.arange(len(x))
        while True:
            rows = rows[self.feature[node[rows]] >= 0]
            if not len(rows):
                return node
            here = node[rows]
            value = x[rows, self.feature[here]]
            go_left = value <= self.threshold[here]
            subset = self.table[here] >= 0
            if subset.any():
                go_left[subset] = self.subsets[self.table[here[subset]], value[subset].astype(int)]
            node[rows] = np.where(go_left, self.left[here], self.right[here])

    def sums(self, rows: pd.DataFrame) -> np.ndarray:
        x = self.matrix(rows)
        total = np.zeros((len(x), self.payload.shape[1]))
        for root in self.roots:
            total += self.payload[self.leaves(x, root)]
        return total


def feature_struct(header: Header, fill: float | None = None, source: DataFrame | None = None) -> Column:
    """The model's inputs as one struct; a NULL number is an error unless filled."""
    if source is not None:
        missing = [name for name, _ in header.features if name not in source.columns]
        if missing:
            raise ValueError(f"missing feature columns: {', '.join(missing)}")
    return F.struct(*[feature_value(header, name, fill).alias(name) for name, _ in header.features])


def feature_value(header: Header, name: str, fill: float | None = None) -> Column:
    if dict(header.features)[name] is not None:
        return F.col(name).cast("string")
    value = F.col(name).cast("double")
    if fill is not None:
        return F.coalesce(value, F.lit(float(fill)))
    return F.coalesce(value, F.raise_error(F.lit(f"NULL in feature {name}")).cast("double"))


def walk_expression(header: Header, tree: Tree, leaf, fill: float | None = None, node: int = 0) -> Column:
    """The tree as nested conditions; ``leaf`` gives the column of a leaf's number."""
    here = tree.nodes[node]
    if tree.is_leaf(node):
        return leaf(node)
    name = here["FEATURE"]
    value = feature_value(header, name, fill)
    known = dict(header.features)[name]
    if known is None:
        go_left = value <= here["THRESHOLD"]
    else:
        go_left = F.coalesce(value.isin(*[c for c in here["CATEGORIES"] if c is not UNSEEN]), F.lit(False))
        if UNSEEN in here["CATEGORIES"]:
            go_left = go_left | value.isNull() | ~value.isin(*known)
    return F.when(go_left, walk_expression(header, tree, leaf, fill, here["LEFT"])).otherwise(
        walk_expression(header, tree, leaf, fill, here["RIGHT"])
    )


def _expression_sums(header: Header, trees: list[Tree], vote: str, fill: float | None) -> Column:
    """One plain sum of conditions per slot: no lambda, so Spark compiles all of it."""

    def slot(tree: Tree, i: int) -> Column:
        return walk_expression(
            header, tree, lambda node: F.lit(float(_payload(header, tree, tree.nodes[node], vote)[i])), fill
        )

    sums = F.struct(*[reduce(add, [slot(tree, i) for tree in trees]).alias(f"s{i}") for i in range(slots(header))])
    numbers = [name for name, known in header.features if known is None]
    if fill is not None or not numbers:
        return sums
    # The whole list is looked at, as the arrays do: which branch a row takes must not decide.
    absent = F.coalesce(*[F.when(F.col(n).cast("double").isNull(), F.lit(n)) for n in numbers])
    stop = F.raise_error(F.concat(F.lit("NULL in feature "), absent))
    return F.when(absent.isNull(), sums).otherwise(stop.cast(_sums_type(header)))


def _sums_type(header: Header) -> T.StructType:
    return T.StructType([T.StructField(f"s{i}", T.DoubleType()) for i in range(slots(header))])


def slots(header: Header) -> int:
    """Numbers a row's sum consists of: one margin for two classes, or a margin or share per class."""
    return 1 if header.kind == "boosted" and len(header.labels) == 2 else len(header.labels)


def descent_udf(shared, header: Header):
    """A pandas UDF from the feature struct to the row's sums ``s0, s1, ...``, by a broadcast descent."""
    names = [f"s{i}" for i in range(slots(header))]

    @F.pandas_udf(_sums_type(header))
    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        descent = shared.value
        for rows in batches:
            yield pd.DataFrame(descent.sums(rows), columns=names)

    return descend


def part_sums(df: DataFrame, model: Model, part: int, vote: str, fill: float | None, engine: str = "auto") -> Column:
    """The sums column of one group of trees."""
    header, trees = model.header, model.parts[part]
    if engine == "auto":
        size = sum(len(tree.reachable()) for tree in trees)
        engine = "expression" if size <= EXPRESSION_NODES and len(model.parts) == 1 else "arrays"
    inputs = feature_struct(header, fill, df)
    if engine == "expression":
        return _expression_sums(header, trees, vote, fill)
    return descent_udf(model.shared(df.sparkSession, part, vote), header)(inputs)


def probabilities(header: Header, sums: Column, trees: int) -> Column:
    """Class probabilities in label order from a row's sums; of more than two boosted classes, normalised ones.

    Where no class has a probability that a double can hold, all have the same.
    """
    if header.kind == "boosted" and slots(header) == 1:
        second = 1 / (1 + F.exp(-2 * sums["s0"]))
        return F.array(1 - second, second)
    if header.kind == "boosted":
        alone = [1 / (1 + F.exp(-2 * sums[f"s{i}"])) for i in range(slots(header))]
        total = reduce(add, alone)
        return F.array(*[F.when(total > 0, p / total).otherwise(1.0 / len(alone)) for p in alone])
    return F.array(*[sums[f"s{i}"] / F.lit(float(trees)) for i in range(slots(header))])


def _label_array(header: Header) -> Column:
    return F.array(*[F.lit(label) for label in header.labels])


def score_columns(header: Header, probs: Column) -> list[Column]:
    """SCORE and CONFIDENCE; of equal classes the smallest label wins."""
    best = F.array_position(probs, F.array_max(probs)).cast("int")
    return [F.element_at(_label_array(header), best).alias("SCORE"), F.array_max(probs).alias("CONFIDENCE")]


def row_probabilities(
    df: DataFrame,
    model: Model,
    keep: list[str],
    vote: str = "hard",
    fill: float | None = None,
    engine: str = "auto",
) -> DataFrame:
    """``(*keep, PROBS)`` of every row, in one ``select``."""
    parts = range(len(model.parts))
    sums = df.select(*keep, *[part_sums(df, model, p, vote, fill, engine).alias(f"_sums{p}") for p in parts])
    total = F.struct(*[
        reduce(add, [F.col(f"_sums{p}")[f"s{i}"] for p in parts]).alias(f"s{i}") for i in range(slots(model.header))
    ])
    return sums.select(*keep, total.alias("_total")).select(
        *keep, probabilities(model.header, F.col("_total"), len(model.trees)).alias("PROBS")
    )


def score(
    df: DataFrame,
    model: Model | DataFrame,
    id_column: str,
    verbose: bool = False,
    vote: str = "hard",
    fill: float | None = None,
    engine: str = "auto",
    text_confidence: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, *keep, SCORE, CONFIDENCE)``; with ``verbose`` one row per id and class.

    ``model`` is a loaded model or its rows. Columns the model does not use,
    the label included, are ignored. ``vote='hard'`` counts the trees of a
    forest, ``'soft'`` averages their class shares. Columns to ``keep``, such as
    the observed label, spare a join of scores and source afterwards.
    """
    if not isinstance(model, Model):
        model = load_model(model)
    probs = row_probabilities(df, model, [id_column, *keep], vote, fill, engine)
    if verbose:
        pairs = F.arrays_zip(_label_array(model.header).alias("SCORE"), F.col("PROBS").alias("CONFIDENCE"))
        scored = probs.select(id_column, *keep, F.inline(pairs))
    else:
        scored = probs.select(id_column, *keep, *score_columns(model.header, F.col("PROBS")))
    if text_confidence:
        scored = scored.withColumn("CONFIDENCE", F.col("CONFIDENCE").cast("string"))
    return scored
