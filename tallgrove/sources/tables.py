"""Reading, writing, naming and sizing relations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A relation is handed to the driver (and from there to every executor) only
# when it is known to have at most so many rows and bytes.
LOCAL_ROW_LIMIT = 100_000
LOCAL_BYTE_LIMIT = 32_000_000


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def register(df: DataFrame, name: str) -> DataFrame:
    """Give a lazy relation a name; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def drop(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def empty_like(df: DataFrame) -> DataFrame:
    """A relation with the schema of ``df`` and no rows; ``df`` is not read."""
    return df.sparkSession.createDataFrame([], df.schema)


def append(df: DataFrame, path: str) -> DataFrame:
    """Add rows to the table at ``path`` and return the whole table."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def refill(df: DataFrame, path: str) -> DataFrame:
    """Replace the rows of the table at ``path``; ``df`` must not read from it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its machine.
    Paths lie under the application's id, so a finished run can be cleared as one.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallgrove-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/tallgrove/{context.applicationId}/{label}-{uuid.uuid4().hex}"


def snapshot(df: DataFrame, path: str | None = None, label: str = "snapshot") -> DataFrame:
    """Write ``df`` once and read it back, so later uses do not recompute it."""
    path = path or scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted_snapshot(df: DataFrame, label: str = "snapshot") -> tuple[DataFrame, int]:
    """``snapshot`` and its number of rows, which the file footers know."""
    stored = snapshot(df, label=label)
    return stored, stored.count()


def bounded(df: DataFrame, max_rows: int = LOCAL_ROW_LIMIT) -> DataFrame:
    """``df`` as a driver-side relation if it is small, else as a written table.

    A driver-side relation has an exact size, so Spark's own size rule decides
    whether a join with it is broadcast; the written table is joined by shuffle.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows or head.nbytes > LOCAL_BYTE_LIMIT:
        return snapshot(df, label="bounded")
    return df.sparkSession.createDataFrame(head, df.schema)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int = 8) -> DataFrame:
    """Save a catalog table hash-bucketed (and sorted) by ``key``.

    Joins and aggregations on ``key`` over the table need no shuffle.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def hash_partitioned(df: DataFrame, key: str, partitions: int = 8) -> DataFrame:
    return df.repartition(partitions, key)


def partition_stats(df: DataFrame) -> DataFrame:
    """Rows per physical partition, counted where the rows are."""
    return (
        df.groupBy(F.spark_partition_id().alias("PART_ID"))
        .agg(F.count(F.lit(1)).alias("RECORD_COUNT"))
    )


def bucket_stats(table: DataFrame, key: str, buckets: int) -> DataFrame:
    """``(BUCKET_ID, FILES, RECORD_COUNT, STRAYED)`` of a table that ``write_bucketed`` saved, by its files' names.

    Counts are added up file by file where they are read, so a few numbers a task are shuffled. STRAYED counts
    rows whose key's hash is another bucket; it is 0 unless files were moved or renamed.
    """
    name = F.col("_metadata.file_name")
    bucket = F.regexp_extract(name, r"_(\d+)(?:\.c\d+)?\.", 1).cast("int")
    hashed = F.pmod(F.hash(key), F.lit(buckets))
    return table.groupBy(bucket.alias("BUCKET_ID")).agg(
        F.countDistinct(name).alias("FILES"),
        F.count(F.lit(1)).alias("RECORD_COUNT"),
        F.count_if(hashed != bucket).alias("STRAYED"),
    )


def matching(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality over ``keys``; stays an equi-join for Spark."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition
