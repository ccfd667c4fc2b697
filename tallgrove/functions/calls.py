"""Splitting and evaluation as calls with a parameter table.

Inputs are read by position: the first column is the id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallgrove.functions.params import Params
from tallgrove.operators import evaluation as ev
from tallgrove.operators.sampling import stratified_partition

STRATIFIED = 1


def partition(df: DataFrame, params: Params | DataFrame | dict, check_ids: bool = True) -> DataFrame:
    """``(id, PARTITION_TYPE)`` as asked by PARTITION_METHOD, STRATIFIED_COLUMN and the percents."""
    params = Params.read(params, "partition")
    if params.whole("HAS_ID", 1) != 1:
        raise ValueError("a split needs an id column (HAS_ID = 1)")
    stratify = None
    if params.whole("PARTITION_METHOD", 0) == STRATIFIED:
        stratify = params.get("STRATIFIED_COLUMN")
        if stratify not in df.columns:
            raise ValueError(f"no column {stratify}")
    shares = tuple(
        params.number(f"{name}_PERCENT", default)
        for name, default in (("TRAINING", 0.8), ("TESTING", 0.1), ("VALIDATION", 0.1))
    )
    return stratified_partition(df, df.columns[0], stratify, shares, params.whole("RANDOM_SEED", 0), check_ids)


def confusion_matrix(df: DataFrame, params: Params | DataFrame | dict) -> tuple[DataFrame, DataFrame]:
    """Matrix and class statistics of ``(id, original label, predicted label)``."""
    _, actual, predicted = df.columns[:3]
    matrix = ev.confusion_matrix(df, actual, predicted)
    return matrix, ev.class_stats(matrix, Params.read(params, "confusion").number("BETA", 1.0))


def auc(df: DataFrame, params: Params | DataFrame | dict) -> tuple[DataFrame, DataFrame]:
    """Area and ROC points of ``(id, original label, probability of the positive label)``."""
    _, actual, prob = df.columns[:3]
    positive = Params.read(params, "auc").get("POSITIVE_LABEL")
    if positive is None:
        raise ValueError("POSITIVE_LABEL is missing")
    return ev.auc(df, actual, prob, positive), ev.roc_curve(df, actual, prob, positive)
