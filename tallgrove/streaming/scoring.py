"""Scoring rows of a stream as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pyspark.sql import functions as F

from tallgrove.operators.scoring import Model, load_model, score
from tallgrove.sources.registry import Registry


def read_feature_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of Parquet feature rows as a stream; the schema is given, not inferred."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_stream(stream: DataFrame, model: Model, id_column: str, **options) -> DataFrame:
    """The batch scorer over a stream. Each row is scored alone: no state, no watermark."""
    return score(stream, model, id_column, **options)


def write_scores(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append scores to Parquet exactly once; stops when the present input is used up."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_latest_scores(
    stream: DataFrame, registry: Registry, name: str, id_column: str, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """Score each micro-batch by the greatest version of ``name`` that the registry holds when the batch begins.

    Scores carry MODEL_VERSION and MODEL_TYPE. A batch is written to the folder of its number, which a repeated batch
    writes anew as a whole: each row is there once, with the scores of one model. A model stays loaded
    until there is a later one. A batch that finds no version fails the stream, which can be
    started again from its checkpoint. Stops when the present input is used up.
    """
    loaded: dict[tuple[float, str], Model] = {}

    def write(batch: DataFrame, number: int) -> None:
        at = registry.latest(name)
        if at is None:
            raise ValueError(f"no version of {name}")
        if at not in loaded:
            for old in loaded.values():
                old.release()
            loaded.clear()
            loaded[at] = load_model(registry.load(name, *at))
        scored = score(batch, loaded[at], id_column, **options)
        scored.withColumn("MODEL_VERSION", F.lit(at[0])).withColumn("MODEL_TYPE", F.lit(at[1])).write.mode(
            "overwrite"
        ).parquet(f"{path.rstrip('/')}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """All scores written by batch, with the batch's number."""
    return spark.read.parquet(path)
