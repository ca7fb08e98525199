"""Sinks: pages, maps, trees, chunks and reports, written by Spark to a new folder each (nothing is overwritten)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders that pages are dealt to by a hash of their key, whatever their number.
BUCKETS = 64


def write_pages(pages: DataFrame, path: str, version: int, by: str = "doc_key", buckets: int = BUCKETS) -> None:
    """(by, html) as a version below ``path``; fails if that version is there. Earlier versions are the backups."""
    dealt = pages.select(by, "html", F.pmod(F.xxhash64(by), F.lit(buckets)).alias("bucket"))
    dealt.repartition("bucket").write.mode("errorifexists").partitionBy("bucket").parquet(f"{path}/version={version}")


def read_pages(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(by, html) of a version of ``write_pages``, the latest unless told otherwise."""
    rows = spark.read.parquet(path)
    chosen = F.lit(version) if version is not None else F.lit(rows.agg(F.max("version")).first()[0])
    return rows.where(F.col("version") == chosen).drop("bucket", "version")


def map_json(anchors: DataFrame, key: str = "key") -> DataFrame:
    """(code, json) with each code's map; keys are sorted."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col("anchor").alias("v"))))
    return anchors.groupBy("code").agg(F.to_json(F.map_from_entries(entries)).alias("json"))


def write_maps(maps: DataFrame, path: str) -> None:
    """``map_json`` rows as JSON lines."""
    maps.select("code", "json").write.mode("errorifexists").json(path)


def write_files(rows: DataFrame, path: str) -> None:
    """One file a row (name, html) below ``path``, written by the tasks; for a few files that other tools read."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        store.create_dir(base, recursive=True)
        for b in batches:
            for name, html in zip(b.column(0), b.column(1), strict=True):
                with store.open_output_stream(f"{base}/{name.as_py()}") as out:
                    out.write((html.as_py() or "").encode())
        yield pa.RecordBatch.from_pydict({"done": pa.array([True])})

    rows.select("name", "html").mapInArrow(put, "done boolean").count()


def write_lines(rows: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """JSON lines, with explicit nulls unless told otherwise."""
    rows.write.mode("errorifexists").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def write_changes(changes: DataFrame, path: str) -> bool:
    """CSV with a header, only where there are changes."""
    if changes.isEmpty():
        return False
    changes.write.mode("errorifexists").option("header", True).csv(path)
    return True


def write_report(lines: DataFrame, path: str) -> None:
    lines.select("line").write.mode("errorifexists").text(path)


def with_head(html: Column, insert: str) -> Column:
    """``insert`` after the first ``<head>``, else after the first ``<body>``, else in front."""
    def after(tag: str) -> Column:
        at = F.instr(html, tag) + len(tag)
        return F.concat(F.substring(html, F.lit(1), at - 1), F.lit(insert), F.substring(html, at, F.length(html)))

    return F.when(F.instr(html, "<head>") > 0, after("<head>")).when(F.instr(html, "<body>") > 0, after("<body>")).otherwise(F.concat(F.lit(insert), html))
