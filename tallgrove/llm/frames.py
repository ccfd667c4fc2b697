"""Small relation helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrove.session import ship
from tallgrove.sources.tables import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: What a Python worker is handed at once; texts differ in length, so bytes count.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000


def ready(spark: SparkSession) -> SparkSession:
    """Ship the package to the Python workers, and bound the batches that these are handed."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return ship(spark)


def stored(df: DataFrame, label: str, **options: str | int) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage ends there. options: of the writer."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Shuffle files of a query go when it has ended, not when the driver happens to collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, label: str, **options: str | int) -> DataFrame:
    """``stored``; the shuffle files of the write are deleted with its end. (One who runs ``df`` again makes them anew.)"""
    conf = df.sparkSession.conf
    before = conf.get(FREED, None)
    conf.set(FREED, "true")
    try:
        return stored(df, label, **options)
    finally:
        conf.set(FREED, before) if before is not None else conf.unset(FREED)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the input columns that an operator's output columns replace."""
    return df.drop(*names)


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns of these names renamed, and the function that gives their names back."""
    taken = {n.lower() for n in names}
    away = {c: f"_own_{c}" for c in df.columns if c.lower() in taken}
    return df.withColumnsRenamed(away), lambda out: out.withColumnsRenamed({b: a for a, b in away.items()})


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def schema_with(df: DataFrame, **columns: str) -> T.StructType:
    """The schema of ``df`` and further columns, given by name and type."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, T.StructType.fromDDL(f'c {k}')['c'].dataType) for n, k in columns.items())])
