"""Registries and maps kept as JSON files, as tables: acts, anchors, phrases, overrides, deprecated ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def acts(spark: SparkSession, path: str) -> DataFrame:
    """(code, doc_id, title) of a registry file; keys that begin with an underscore are metadata."""
    kind = "map<string,string>"
    each = _file(spark, path).select(F.explode(F.from_json("value", kind)).alias("code", "act")).where(~F.col("code").startswith("_"))
    act = F.from_json("act", "struct<doc_id:string,title:string>")
    return each.select("code", act.doc_id.alias("doc_id"), act.title.alias("title"))


def act_remap(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(old_id, new_id) kept under the registry's metadata key ``key``."""
    inner = F.from_json(F.get_json_object("value", f"$.{key}"), "map<string,string>")
    return _file(spark, path).select(F.explode(inner).alias("old_id", "new_id"))


def anchor_maps(spark: SparkSession, path: str, prefix: str = "article_map_") -> DataFrame:
    """(code, key, anchor) of map files ``<prefix><code>.json`` at a path or glob, or of the folders ``sinks.write_maps`` writes."""
    if "*" not in path and not path.endswith(".json"):
        rows = spark.read.schema("code string, json string").json(path)
        return rows.select("code", F.explode(F.from_json("json", "map<string,string>")).alias("key", "anchor"))
    code = F.regexp_extract("_metadata.file_path", rf"{prefix}(.+)\.json$", 1)
    return _file(spark, path).select(code.alias("code"), F.explode(F.from_json("value", "map<string,string>")).alias("key", "anchor"))


def phrases(spark: SparkSession, path: str, least: int = 16) -> DataFrame:
    """(phrase, doc_id, size) of at least ``least`` characters, longest first."""
    each = _file(spark, path).select(F.explode(F.from_json("value", "map<string,string>")).alias("phrase", "doc_id")).withColumn("size", F.length("phrase"))
    return each.where(F.col("size") >= least).orderBy(F.desc("size"), "phrase")


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a manual override file."""
    kind = "struct<overrides:array<struct<id:string,code:string,find_phrase:string,anchor_phrase:string,doc_id:string,anchor:string,context_marker:string>>>"
    return _file(spark, path).select(F.explode(F.from_json("value", kind).overrides).alias("o")).select("o.*")


def raw_hrefs(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(doc_key, ord, href) by pattern over the raw text, without a tree."""
    return pages.select(F.col(key).cast("string").alias("doc_key"), F.posexplode(F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]*)"'), 1)).alias("ord", "href"))


def code_of(links: DataFrame, registry: DataFrame, doc: str = "target_doc") -> DataFrame:
    """``links`` with the code of the act that ``doc`` names, null where it is no act of the registry."""
    return links.join(registry.select(F.col("doc_id").alias(doc), "code"), doc, "left")


def source_name(codes: DataFrame, alias: DataFrame) -> DataFrame:
    """The file name of each code: its alias (code, alias) or itself."""
    return codes.join(alias.dropDuplicates(["code"]), "code", "left").withColumn("source_name", F.coalesce("alias", "code")).drop("alias")
