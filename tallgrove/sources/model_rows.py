"""Models as rows: tree nodes as text, cut into pieces of bounded length.

A model is a header (kind, class labels, features) and one document per tree. Boosted trees of more than two
classes belong to one class each: its number stands in the document and in the key (class_2_tree_17).
Three row layouts exist, told apart by their columns:

* forest   ``ROW_INDEX, TREE_INDEX, MODEL_CONTENT`` (up to 5000 characters)
* boosted  ``ROW_INDEX, KEY, VALUE``                (up to 1000 characters)
* tree     ``ROW_INDEX, MODEL_CONTENT``             (up to 5000 characters)
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The longest piece per layout.
CONTENT_WIDTH = 5000
VALUE_WIDTH = 1000

HEADER = -1  # document number of the header; trees count from 0
NODE_FIELDS = [
    "NODE", "FEATURE", "THRESHOLD", "CATEGORIES", "LEFT", "RIGHT", "COUNTS", "VALUE", "RAW_COUNT", "GAIN",
]


@dataclass(frozen=True)
class Header:
    """What all trees of a model share. ``categories`` is None for a number."""

    kind: str  # forest | tree | boosted
    labels: tuple[str, ...]
    features: tuple[tuple[str, tuple[str, ...] | None], ...]

    def to_json(self) -> str:
        features = [{"name": n, "categories": list(c) if c is not None else None} for n, c in self.features]
        return json.dumps({"kind": self.kind, "labels": list(self.labels), "features": features})

    @classmethod
    def from_json(cls, text: str) -> Header:
        raw = json.loads(text)
        features = tuple(
            (f["name"], tuple(f["categories"]) if f["categories"] is not None else None) for f in raw["features"]
        )
        return cls(raw["kind"], tuple(raw["labels"]), features)


def chunk(df: DataFrame, keys: list[str], text: str, width: int) -> DataFrame:
    """``(*keys, PIECE, CONTENT)``: ``text`` cut into pieces of ``width`` characters."""
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / width).cast("int") - 1, F.lit(0))),
        lambda i: F.col(text).substr(i * width + 1, F.lit(width)),
    )
    return df.select(*keys, F.posexplode(pieces).alias("PIECE", "CONTENT"))


def unchunk(df: DataFrame, keys: list[str], order: str = "PIECE", content: str = "CONTENT") -> DataFrame:
    """``(*keys, TEXT)``: the pieces of each text in order, joined again; a text of NULL pieces only is NULL."""
    ordered = F.array_sort(F.collect_list(F.struct(order, content)))
    text = F.concat_ws("", F.transform(ordered, lambda s: s[content]))
    return df.groupBy(*keys).agg(F.when(F.count(content) > 0, text).alias("TEXT"))


def _tree_texts(nodes: DataFrame) -> DataFrame:
    """``(DOC, CLASS, TEXT)``; without a class the text has no such field."""
    node = F.struct(*NODE_FIELDS)
    if "CLASS" not in nodes.columns:
        nodes = nodes.withColumn("CLASS", F.lit(None).cast("int"))
    return (
        nodes.groupBy("TREE")
        .agg(
            F.max("WEIGHT").alias("WEIGHT"), F.max("CLASS").alias("CLASS"),
            F.array_sort(F.collect_list(node)).alias("NODES"),
        )
        .select(F.col("TREE").alias("DOC"), "CLASS", F.to_json(F.struct("WEIGHT", "CLASS", "NODES")).alias("TEXT"))
    )


def encode(header: Header, nodes: DataFrame) -> DataFrame:
    """Node rows ``(TREE, WEIGHT, *NODE_FIELDS[, CLASS])`` to model rows of the header's layout.

    The window that numbers the rows covers one model's text, nothing else.
    """
    spark = nodes.sparkSession
    head = spark.createDataFrame([(HEADER, None, header.to_json())], "DOC int, CLASS int, TEXT string")
    texts = head.unionByName(_tree_texts(nodes))
    # A single tree leaves room for the line break between header and tree.
    width = {"boosted": VALUE_WIDTH, "tree": CONTENT_WIDTH - 1}.get(header.kind, CONTENT_WIDTH)
    rows = chunk(texts, ["DOC", "CLASS"], "TEXT", width)
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("DOC", "PIECE")) - 1
    if header.kind == "forest":
        return rows.select(
            number.alias("ROW_INDEX"), F.col("DOC").alias("TREE_INDEX"), F.col("CONTENT").alias("MODEL_CONTENT")
        )
    if header.kind == "boosted":
        key = F.when(F.col("DOC") == HEADER, "header").otherwise(
            F.concat(F.coalesce(F.concat(F.lit("class_"), "CLASS", F.lit("_")), F.lit("")), F.lit("tree_"), "DOC")
        )
        return rows.select(number.alias("ROW_INDEX"), key.alias("KEY"), F.col("CONTENT").alias("VALUE"))
    # A single tree is one text: header and tree, separated by a line break.
    line = F.when((F.col("DOC") > HEADER) & (F.col("PIECE") == 0), F.lit("\n")).otherwise(F.lit(""))
    return rows.select(
        number.alias("ROW_INDEX"), F.concat(line, "CONTENT").alias("MODEL_CONTENT")
    )


def decode(rows: DataFrame) -> DataFrame:
    """Model rows of any layout to ``(DOC, TEXT)``."""
    if "KEY" in rows.columns and "VALUE" in rows.columns:
        doc = F.when(F.col("KEY") == "header", HEADER).otherwise(
            F.regexp_extract("KEY", "([0-9]+)$", 1).try_cast("int")
        )
        return unchunk(rows.withColumn("DOC", doc), ["DOC"], "ROW_INDEX", "VALUE")
    if "TREE_INDEX" in rows.columns:
        return unchunk(rows.withColumnRenamed("TREE_INDEX", "DOC"), ["DOC"], "ROW_INDEX", "MODEL_CONTENT")
    whole = unchunk(rows.withColumn("ALL", F.lit(0)), ["ALL"], "ROW_INDEX", "MODEL_CONTENT")
    return whole.select(F.posexplode(F.split("TEXT", "\n", 2)).alias("POS", "TEXT")).select(
        (F.col("POS") - 1).alias("DOC"), "TEXT"
    )
