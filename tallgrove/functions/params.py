"""Parameter tables: long-form rows with one value column filled per row."""

from __future__ import annotations

import ast
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "PARAM_NAME string, INT_VALUE int, DOUBLE_VALUE double, STRING_VALUE string"

# The parameter names a caller may use, by task.
NAMES = {
    "partition": [
        "PARTITION_METHOD", "RANDOM_SEED", "HAS_ID", "STRATIFIED_COLUMN",
        "TRAINING_PERCENT", "TESTING_PERCENT", "VALIDATION_PERCENT",
    ],
    "forest": [
        "TREES_NUM", "TRY_NUM", "SEED", "SPLIT_THRESHOLD", "CALCULATE_OOB", "NODE_SIZE",
        "HAS_ID", "DEPENDENT_VARIABLE", "CATEGORICAL_VARIABLE", "MAX_TREE_DEPTH", "INPUT_PARTITIONS",
    ],
    "boosted": [
        "FOLD_NUM", "CV_METRIC", "REF_METRIC", "MAX_TREE_DEPTH", "ITER_NUM", "LEARNING_RATE",
        "MIN_SPLIT_LOSS", "RANGE_ITER_NUM", "RANGE_LEARNING_RATE", "RANGE_MIN_SPLIT_LOSS",
        "ROW_SAMPLE_RATE", "SEED", "HAS_ID", "DEPENDENT_VARIABLE", "CATEGORICAL_VARIABLE", "INPUT_PARTITIONS",
    ],
    "tree": [
        "ALGORITHM", "MODEL_FORMAT", "MIN_RECORDS_OF_PARENT", "MIN_RECORDS_OF_LEAF", "SPLIT_THRESHOLD",
        "MIN_RECORDS_OF_PARENT_VALUES", "MIN_RECORDS_OF_LEAF_VALUES", "SPLIT_THRESHOLD_VALUES",
        "IS_OUTPUT_RULES", "IS_OUTPUT_CONFUSION_MATRIX", "CATEGORICAL_VARIABLE", "HAS_ID",
        "DEPENDENT_VARIABLE", "RESAMPLING_METHOD", "EVALUATION_METRIC", "PARAM_SEARCH_STRATEGY",
        "FOLD_NUM", "SEED", "MAX_TREE_DEPTH", "INPUT_PARTITIONS",
    ],
    "score": ["VERBOSE", "STATE_ID"],
    "state": ["ALGORITHM", "STATE_DESCRIPTION"],
    "confusion": ["BETA"],
    "auc": ["POSITIVE_LABEL"],
    "smoothing": [
        "ADAPTIVE_METHOD", "MEASURE_NAME", "ALPHA", "DELTA", "FORECAST_NUM", "EXPOST_FLAG",
        "PREDICTION_CONFIDENCE_1", "PREDICTION_CONFIDENCE_2",
    ],
}
# Accepted everywhere and without effect: Spark schedules and reports by itself.
INERT = ["THREAD_RATIO", "PROGRESS_INDICATOR_ID"]
# Accepted by their tasks and without effect: the one format, the one search strategy, a matrix and both
# metrics that every call reports, and the kind of a model that its rows tell themselves.
UNREAD = {
    "tree": ["MODEL_FORMAT", "PARAM_SEARCH_STRATEGY", "IS_OUTPUT_CONFUSION_MATRIX"],
    "boosted": ["REF_METRIC"],
    "state": ["ALGORITHM"],
}
KNOWN = frozenset(INERT).union(*NAMES.values())

# A parameter table has one row per name; anything longer is not one.
MAX_ROWS = 1000


class Params(dict):
    """Parameter name to value. Unknown names are an error, a later row wins."""

    def __setitem__(self, name: str, value) -> None:
        if name not in KNOWN:
            raise ValueError(f"unknown parameter {name}")
        super().__setitem__(name, value)

    @classmethod
    def of(cls, **values) -> Params:
        params = cls()
        for name, value in values.items():
            params[name] = value
        return params

    @classmethod
    def from_arrays(cls, names, ints=(), doubles=(), strings=()) -> Params:
        params = cls()
        for name, *slots in zip_longest(names, ints, doubles, strings):
            params[name] = next((v for v in slots if v is not None), None)
        return params

    @classmethod
    def from_df(cls, df: DataFrame) -> Params:
        rows = df.select("PARAM_NAME", "INT_VALUE", "DOUBLE_VALUE", "STRING_VALUE").limit(MAX_ROWS + 1).collect()
        if len(rows) > MAX_ROWS:
            raise ValueError(f"more than {MAX_ROWS} parameter rows")
        return cls.from_arrays(*zip(*rows)) if rows else cls()

    @classmethod
    def read(cls, source: Params | DataFrame | dict, task: str | None = None) -> Params:
        """Parameters from any form; with a ``task``, a name of another task is an error."""
        if isinstance(source, cls):
            params = source
        else:
            params = cls.of(**source) if isinstance(source, dict) else cls.from_df(source)
        foreign = sorted(set(params) - {*NAMES[task], *INERT}) if task else []
        if foreign:
            raise ValueError(f"no parameter of {task}: {', '.join(foreign)}")
        return params

    def number(self, name: str, default: float) -> float:
        value = self.get(name)
        return float(default if value is None else value)

    def whole(self, name: str, default: int) -> int:
        value = self.get(name)
        return int(default if value is None else value)

    def rows(self) -> list[tuple]:
        return [typed_row(name, value) for name, value in self.items()]

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), SCHEMA)


def typed_row(name: str, value) -> tuple:
    """Put a value into the column of its type."""
    if isinstance(value, int):
        return (name, int(value), None, None)
    if isinstance(value, float):
        return (name, None, value, None)
    return (name, None, None, value)


def parse_range(text: str, whole: bool = False) -> list:
    """``[low,n,high]``: n evenly spaced points, both ends included."""
    low, n, high = ast.literal_eval(text)
    n = int(n)
    if n < 1:
        raise ValueError(f"a range needs at least one point: {text}")
    points = [low + (high - low) * i / (n - 1) for i in range(n)] if n > 1 else [low]
    return [round(p) for p in points] if whole else [round(float(p), 12) for p in points]


def parse_values(text: str) -> list:
    """``{a,b,c}``: the listed values in order."""
    if not (text.startswith("{") and text.endswith("}")):
        raise ValueError(f"expected {{a,b,...}}: {text}")
    return [ast.literal_eval(item.strip()) for item in text[1:-1].split(",")]


def unnest(df: DataFrame, keep: list[str], names: str, ints: str, doubles: str, strings: str) -> DataFrame:
    """Zip four array columns of every row into parameter rows."""
    return df.select(*keep, F.inline(F.arrays_zip(
        F.col(names).alias("PARAM_NAME"), F.col(ints).alias("INT_VALUE"),
        F.col(doubles).alias("DOUBLE_VALUE"), F.col(strings).alias("STRING_VALUE"),
    )))


def pivot_params(params: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Per-group parameter rows as one row per group, a double column per name.

    Text parameters come out as NULL.
    """
    value = F.coalesce(F.col("DOUBLE_VALUE"), F.col("INT_VALUE").cast("double"))
    return params.groupBy(key).agg(*[
        F.max(F.when(F.col("PARAM_NAME") == name, value)).alias(name) for name in names
    ])
