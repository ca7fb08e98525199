"""Filter interaction audit: what every filter removes in every order of the filters.

The orders make a trie. Its states are sets of filters already applied, in whatever order: a state that another order has
reached is not computed again. The walk is depth first; the survivors of a state are persisted while the states below it
are made from them, so at most one DataFrame a level is held, and every edge (state, next filter) counts what the filter
takes from them. Counts are written to the shared folder, one small table a state, and never pass through the driver.

Defined results: null and empty texts have no words (only A, and E for the later ones, fail); a row without doc_id is no
later copy and has no labels; equal rows are counted each. A document is good or toxic if one of its labels says so. A
null part is the empty string. An empty table gives no rows. Extra columns play no part, whatever their names.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, shared_folder

WORD = r"[^\x20\x09-\x0D]+"


def examined(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A, B, C, D, E, good, toxic, n) of documents; a filter's column says that it fails. Whole texts are read once.

    A: under 100 words; B: under 80 % different words; C: over 10 % capitals; D: holds a sign; E: a smaller doc_id has the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = F.regexp_extract_all("t", F.lit(WORD), 0)
    capitals = F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    rows = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("t")).withColumn("w", own)
    rows = rows.select(
        "doc_id", "part", F.unhex(F.sha2("t", 256)).alias("sha"), (F.size("w") < 100).alias("A"), (100 * F.size(F.array_distinct("w")) < 80 * F.size("w")).alias("B"),
        (100 * capitals.cast("long") > 10 * F.length("t").cast("long")).alias("C"), F.col("t").rlike(r"[#$%&*|]").alias("D"),
    )
    rows = cut(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "examined")
    # A document is the first with its text if (text, doc_id) is the text's least: a join on both, so copies don't meet in one task.
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    joined = rows.join(first, ["sha", "doc_id"], "left").join(said, "doc_id", "left")
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return joined.select("part", "A", "B", "C", "D", later.alias("E"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")


def removals(rows: DataFrame, filters: Mapping[str, Column], tallies: Mapping[str, Column], part: str = "part", n: str = "n") -> DataFrame:
    """(part, state, filter, survivors, removed, each of ``tallies`` among the removed) of every edge of the trie.

    ``filters`` names a condition each that fails a row (true or false), a row stands for ``n`` documents. ``state`` are
    the names applied before, in order, joined. Parts without survivors have no row. One job a state, 2**k - 1 of them.
    """
    spark, names = rows.sparkSession, list(filters)
    folder, seen = shared_folder(spark, "edges"), set()
    count = lambda condition: F.sum(F.when(condition, F.col(n)).otherwise(0))

    def visit(state: tuple[str, ...], survivors: DataFrame) -> None:
        seen.add(state)
        ahead = [f for f in names if f not in state]
        if not ahead:
            return
        survivors = survivors.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            edge = lambda f: F.struct(F.lit(f).alias("filter"), count(filters[f]).alias("removed"), *(count(filters[f] & c).alias(t) for t, c in tallies.items()))
            counts = survivors.groupBy(part).agg(F.sum(n).alias("survivors"), F.array(*map(edge, ahead)).alias("edges"))
            counts.select(F.col(part).alias("part"), F.lit("".join(state)).alias("state"), "survivors", F.explode("edges").alias("e")).select("part", "state", "survivors", "e.*").write.parquet(f"{folder}/at-{''.join(state)}")
            for f in ahead:
                below = tuple(x for x in names if x in state or x == f)
                if below not in seen:
                    visit(below, survivors.where(~filters[f]))
        finally:
            survivors.unpersist()

    visit((), rows)
    kind = f"part string, state string, survivors long, filter string, removed long, {', '.join(f'{t} long' for t in tallies)}"
    return spark.read.schema(kind).parquet(f"{folder}/at-*")


def orders_audit(edges: DataFrame, names: list[str], tallies: list[str]) -> DataFrame:
    """One row a part, order and step of ``removals``: kept, removed, redundant, unique_fails, the tallies, shapley.

    ``redundant`` fail the filter but went earlier, ``unique_fails`` fail no other one, ``shapley`` sums what the filter removes over all orders.
    """
    key = lambda state, f: f"{''.join(state)}>{f}"
    steps = [
        {"filter_order": "".join(order), "step": k + 1, "filter": f, "at": key([x for x in names if x in order[:k]], f), "first": key([], f), "last": key([x for x in names if x != f], f)}
        for order in itertools.permutations(names) for k, f in enumerate(order)
    ]
    # A part's edges are k * 2**(k-1) at most.
    value = F.struct("survivors", "removed", *tallies)
    by_part = edges.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("state", F.lit(">"), "filter"), value))).alias("edges"))
    planned = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,filter:string,at:string,first:string,last:string>>")
    rows = by_part.select("part", "edges", F.explode(planned).alias("s")).select("part", "edges", "s.*")
    of = lambda where, what: F.coalesce(F.try_element_at("edges", F.col(where))[what], F.lit(0)).cast("long")
    removed = of("at", "removed")
    rows = rows.select("part", "filter_order", "step", "filter", (of("at", "survivors") - removed).alias("kept"), removed.alias("removed"), (of("first", "removed") - removed).alias("redundant"), of("last", "removed").alias("unique_fails"), *(of("at", t).alias(t) for t in tallies))
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E of ``examined`` over all 120 orders, by language."""
    rows, names = cut(examined(documents, labels), "audited"), list("ABCDE")
    tallies = {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}
    return orders_audit(removals(rows, {f: F.col(f) for f in names}, tallies), names, list(tallies))
