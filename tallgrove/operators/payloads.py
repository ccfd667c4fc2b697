"""Classifying binary payloads with named models kept as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrove.functions.columns import bytes_to_hex, hex_to_bytes

MAX_MODEL_VALUES = 16_000_000  # numbers in one payload model; it is broadcast

BATCH = 1024  # payloads that a model sees at once

# Answers of the availability check.
AVAILABLE = ("0", "OK")
UNAVAILABLE = ("1", "model is registered but not available")
UNKNOWN = ("2", "model is not registered")


@F.pandas_udf(T.BinaryType())
def float_bytes(values: pd.Series) -> pd.Series:
    """An array of numbers as little-endian 32-bit floats."""
    sizes = values.str.len()
    if len(values) and sizes.notna().all() and sizes.min() == sizes.max():
        data = np.ascontiguousarray(np.stack(values.to_numpy()), dtype="<f4")
        width = 4 * data.shape[1]
        return pd.Series([row.tobytes() for row in data] if width else [b""] * len(data), dtype=object)
    return values.map(lambda v: np.asarray(v, dtype="<f4").tobytes(), na_action="ignore")


def hex_payloads(df: DataFrame, id_column: str, values: str) -> DataFrame:
    """``(NR, IMAGE)``: payloads as hexadecimal text."""
    return df.select(
        F.col(id_column).cast("string").alias("NR"), bytes_to_hex(float_bytes(values)).alias("IMAGE")
    )


def decode_payloads(df: DataFrame, hex_column: str = "IMAGE") -> DataFrame:
    return df.withColumn(hex_column, hex_to_bytes(F.col(hex_column)))


def centroid_model(df: DataFrame, label: str, values: str, name: str) -> DataFrame:
    """``(MODEL_NAME, LABEL, POSITION, VALUE)``: the mean vector of every class.

    Positions are averaged side by side, so a class of any size is summed map-side.
    """
    return (
        df.select(F.col(label).cast("string").alias("LABEL"), F.posexplode(values).alias("POSITION", "VALUE"))
        .groupBy("LABEL", "POSITION")
        .agg(F.avg(F.col("VALUE").cast("double")).alias("VALUE"))
        .select(F.lit(name).alias("MODEL_NAME"), "LABEL", "POSITION", "VALUE")
    )


def check_models(requested: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``(MODEL_NAME, Code, Longtext)`` for every requested name."""
    def answer(i: int):
        return (
            F.when(F.col("_listed").isNull(), UNKNOWN[i]).when(F.col("AVAILABLE"), AVAILABLE[i]).otherwise(UNAVAILABLE[i])
        )

    listed = catalogue.withColumn("_listed", F.lit(True))
    return requested.join(listed, "MODEL_NAME", "left").select(
        "MODEL_NAME", answer(0).alias("Code"), answer(1).alias("Longtext")
    )


def nearest_mean(model: pa.Table) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """Label and squared distance of the nearest class mean; ties go to the smaller label."""
    model = model.sort_by("LABEL")
    labels = np.array(model.column("LABEL").to_pylist(), dtype=object)
    centres = np.array(model.column("VALUES").to_pylist(), dtype=float)

    def predict(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(payloads), dtype="<f4").reshape(len(payloads), -1).astype(float)
        best, found = np.full(len(data), np.inf), np.zeros(len(data), dtype=int)
        for i, centre in enumerate(centres):
            distance = ((data - centre) ** 2).sum(axis=1)
            closer = distance < best
            best[closer], found[closer] = distance[closer], i
        return labels[found], best

    return predict


#: By the name in a catalogue row: from a model (a row a class) to a function of payloads.
LOADERS: dict[str, Callable[[pa.Table], Callable]] = {"nearest_mean": nearest_mean}


def class_rows(model: DataFrame) -> pa.Table:
    """``(LABEL, VALUES)``: a row a class, its values in the order of their positions; the size is checked first."""
    if model.select("LABEL").limit(MAX_MODEL_VALUES + 1).count() > MAX_MODEL_VALUES:
        raise ValueError(f"a payload model may have {MAX_MODEL_VALUES} values at most")
    ordered = F.array_sort(F.collect_list(F.struct("POSITION", "VALUE")))
    rows = model.groupBy("LABEL").agg(F.transform(ordered, lambda x: x["VALUE"]).alias("VALUES")).toArrow()
    if rows.num_rows == 0:
        raise ValueError("the payload model has no rows")
    if len(set(map(len, rows.column("VALUES").to_pylist()))) > 1:
        raise ValueError("the classes of the payload model differ in their number of values")
    return rows


def _predictor(spark, models: list[tuple[str, pa.Table]]):
    """A column function of payloads to ``LABEL_i, SCORE_i`` of the models (loader, rows).

    A Python worker loads the models at its first batch and keeps them; all see the same batches.
    """
    shared = spark.sparkContext.broadcast([rows for _, rows in models])
    loaders = [loader for loader, _ in models]

    def load() -> Callable:
        predictors = [LOADERS[loader](rows) for loader, rows in zip(loaders, shared.value, strict=True)]

        def batch(payloads: np.ndarray) -> dict[str, np.ndarray]:
            out = {}
            given = np.array([p is not None for p in payloads], bool)
            for i, predict in enumerate(predictors):
                label, score = np.full(len(payloads), None, object), np.full(len(payloads), np.nan)
                if given.any():
                    label[given], score[given] = predict(list(payloads[given]))
                out[f"LABEL_{i}"], out[f"SCORE_{i}"] = label, score
            return out

        return batch

    fields = [f"LABEL_{i} string, SCORE_{i} double" for i in range(len(models))]
    return predict_batch_udf(load, return_type=T.StructType.fromDDL(", ".join(fields)), batch_size=BATCH)


def classify_payloads(df: DataFrame, id_column: str, payload: str, model: DataFrame) -> DataFrame:
    """``(id, LABEL, SCORE)``: the class with the nearest mean and the squared distance.

    ``payload`` is binary; a null payload has neither. The model rows are counted before they are broadcast.
    """
    predict = _predictor(df.sparkSession, [("nearest_mean", class_rows(model))])
    found = df.select(id_column, payload, predict(payload).alias("r"))
    score = F.when(F.col(payload).isNotNull(), F.col("r.SCORE_0"))
    return found.select(id_column, F.col("r.LABEL_0").alias("LABEL"), score.alias("SCORE"))


def classify_by_catalogue(
    df: DataFrame, id_column: str, payload: str, catalogue: DataFrame, models: DataFrame, names: Iterable[str]
) -> DataFrame:
    """``(id, MODEL_NAME, LABEL, SCORE)``: every payload by each named model, from one read of the payloads.

    ``catalogue`` is ``(MODEL_NAME, LOADER, AVAILABLE)``, ``models`` holds the rows of all models
    ``(MODEL_NAME, LABEL, POSITION, VALUE)``. A name that is not listed once, not available or of an unknown loader is an error.
    """
    names = list(dict.fromkeys(names))
    listed = catalogue.filter(F.col("MODEL_NAME").isin(names)).select("MODEL_NAME", "LOADER", "AVAILABLE").limit(2 * len(names) + 1)
    entries = {name: [] for name in names}
    for row in listed.collect():
        entries[row["MODEL_NAME"]].append(row)
    loaded = []
    for name in names:
        if len(entries[name]) != 1:
            raise ValueError(f"{name}: {UNKNOWN[1] if not entries[name] else 'model is registered more than once'}")
        entry = entries[name][0]
        if not entry["AVAILABLE"]:
            raise ValueError(f"{name}: {UNAVAILABLE[1]}")
        if entry["LOADER"] not in LOADERS:
            raise ValueError(f"{name}: no loader {entry['LOADER']}")
        loaded.append((entry["LOADER"], class_rows(models.filter(F.col("MODEL_NAME") == name))))
    found = df.select(F.col(id_column), F.col(payload).alias("_payload"), _predictor(df.sparkSession, loaded)(payload).alias("_r"))

    def answer(i: int, name: str):
        score = F.when(F.col("_payload").isNotNull(), F.col(f"_r.SCORE_{i}"))
        return F.struct(F.lit(name).alias("MODEL_NAME"), F.col(f"_r.LABEL_{i}").alias("LABEL"), score.alias("SCORE"))

    answers = F.explode(F.array(*[answer(i, name) for i, name in enumerate(names)]))
    return found.select(id_column, answers.alias("_a")).select(id_column, "_a.*")
