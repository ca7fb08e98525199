"""New pages as a stream: whole files parsed by the same stateless step as the batch reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.html import parse_nodes


def stream_html(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_key, html) of files as they arrive in ``folder``."""
    files = spark.readStream.option("wholetext", True).text(folder)
    return files.select(F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.html?)?$", 1).alias("doc_key"), F.col("value").alias("html"))


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the nodes of new files to ``out`` until all that is there has been read."""
    nodes = parse_nodes(stream_html(spark, folder), "doc_key", "html")
    return nodes.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
