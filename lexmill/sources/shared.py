"""Tables written to the folder that driver and executors share, so that what reads them many times computes them once."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; a session on one machine that sets none gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _kept(writer: DataFrameWriter, spark: SparkSession, name: str) -> DataFrame:
    """What ``writer`` writes to the shared folder, read back by a table that has its row count and no name afterwards.

    Spark takes a table's file size for its size in memory, and joins what looks small by sending it whole through the
    driver. Repetitive rows take a few bytes each in files, so sizes are told by row counts, which
    ``spark.sql.cbo.planStats.enabled`` (set here for the session) makes the plans use.
    """
    spark.conf.set("spark.sql.cbo.planStats.enabled", "true")
    path = shared_folder(spark, name)
    table = f"lexmill_{re.sub('[^0-9a-z]', '_', name)}_{path[-32:]}"
    writer.option("compression", "zstd").option("path", path).saveAsTable(table, format="parquet")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return kept.select("*")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back: a lost executor recomputes nothing before it."""
    return _kept(df.write, df.sparkSession, name)


def bucketed(df: DataFrame, name: str, by: str, *order: str) -> DataFrame:
    """``df``, written to the shared folder in buckets of ``by``, each sorted by it and ``order``, and read back.

    Windows, groups and joins on ``by`` and further columns read the buckets as they are. For joins Spark asks for a
    partitioning by all their columns unless ``spark.sql.requireAllClusterKeysForCoPartition`` is false, which this sets
    for the session: rows of one ``by`` then stay together, as windows over them need anyway. A bucket is one file, and
    that it is sorted is used only with ``spark.sql.legacy.bucketedTableScan.outputOrdering``, which this sets as well:
    every window and join in that order would sort it again, and all sorts of a task hold memory at once.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)
    return _kept(df.repartition(n, by).write.bucketBy(n, by).sortBy(by, *order), spark, name)
