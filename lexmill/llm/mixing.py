"""Mixing sources to target weights: budgets of tokens, met by hash thresholds that histograms find.

A source's size is the sum of its documents' words. Sources in order of code points (null last) get the ``WEIGHTS`` in
turn and share the sum of all sizes; no target exceeds ``REPEATS`` times its source, the excess is shared again by weight.
A target is so many whole copies of the source and a rest. The rest goes to the documents with the least hashes: sums by
source and hash bucket give the bucket in which the budget ends, only the documents of that bucket are summed by finer
buckets, down to single hashes. So budgets are nested (a larger one takes what a smaller one takes and more), nothing is
sorted but buckets, and every rerun takes the same documents. All of it is DataFrame functions.

Defined results: a null text has no words; documents without words are returned and take none; null is a source of its
own, the last; a source without words has the target 0. Rows that are equal in id, source and text are told apart by
count, so any number of equal rows is split by a budget like others; null and repeated ids are no special case. An empty
table gives no rows. Extra columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Weights of the sources in their order, repeating, and how often a document may be taken at most.
WEIGHTS, REPEATS = (5, 2, 1), 3
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a hash (15 hexadecimal digits), and bits of the buckets of one histogram.
BITS, STEP = 60, 15
#: Parts that the rows of one source are dealt over when they meet its threshold; equal rows that are dealt as one.
SALTS, CHUNK = 64, 4096


def sized(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, h, n): ``n`` equal documents of ``size`` words with the hash ``h``; written to the shared folder."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    rows = documents.select("doc_id", "source", size.alias("size"), F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long").alias("h"))
    return cut(rows.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("n")), "sized")


def _same(column: str, left: DataFrame, right: DataFrame) -> Column:
    return left[column].eqNullSafe(right[column])


def weighed(items: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight). Sources are ranked by ranges: each range is counted, its own rows are numbered."""
    order = F.col("source").asc_nulls_last()
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    placed = cut(sizes.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "sources")
    counts = placed.groupBy("range").agg(F.count("*").alias("here"))  # one row a range
    before = counts.select("range", (F.sum("here").over(Window.orderBy("range")) - F.col("here")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(order)) + F.col("before") - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    return placed.join(before, "range").select("source", "source_size", weight.cast("long").alias("weight"))


def targets(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``sources`` with target: what a weight is worth rises until no uncapped source is above its cap; each round is one aggregate."""
    worth, capped = F.lit(0.0), -1
    level = 0.0
    while True:
        over = F.col("weight") * worth > repeats * F.col("source_size")
        row = sources.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(over, repeats * F.col("source_size")).otherwise(0)).alias("held"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("free"), F.count_if(over).alias("n"),
        ).first()
        if row["n"] == capped or not row["free"]:
            return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), F.lit(float(repeats)) * F.col("source_size")))
        capped, level = row["n"], (row["all"] - row["held"]) / row["free"]
        worth = F.lit(level)


def thresholds(items: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, edge, left): hashes below ``edge`` fit the budget (source, budget); ``left`` is what the hash ``edge`` itself may take.

    Budgets are below the source's size. Sums go down from the first ``STEP`` bits to all of them, each time within the one bucket where a budget ends.
    """
    pool, shift = items.select("source", "h", (F.col("size") * F.col("n")).alias("words")), BITS
    while shift:
        shift -= STEP
        sums = pool.withColumn("bucket", F.shiftright("h", shift)).groupBy("source", "bucket").agg(F.sum("words").alias("words"))
        running = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")))
        own = budgets.select(F.col("source").alias("of"), "budget")
        met = running.join(own, running["source"].eqNullSafe(own["of"])).where("upto - words <= budget and budget < upto")
        edges = cut(met.select("source", "bucket", (F.col("budget") - F.col("upto") + F.col("words")).alias("budget")), "edges")
        if shift:
            at = edges.select(F.col("source").alias("of"), F.col("bucket").alias("edge"))
            pool = cut(pool.join(at, pool["source"].eqNullSafe(at["of"]) & (F.shiftright(pool["h"], shift) == at["edge"]), "left_semi"), "bucket")
        budgets = edges
    return budgets.select("source", F.col("bucket").alias("edge"), F.col("budget").alias("left"))


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every document: the words that the mix takes of it, repeats counted."""
    items = sized(documents)
    sources = cut(targets(weighed(items, weights), repeats), "targets")
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    planned = sources.select("source", "source_size", "target", copies.alias("copies"))
    budgets = planned.select("source", (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget")).where("budget > 0")
    edges = thresholds(items, budgets)
    planned = planned.join(edges.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    # The rows of a source are dealt over SALTS parts, and equal rows in chunks, before they meet what holds for the source.
    chunks = items.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(CHUNK)))).withColumn("salt", F.pmod(F.xxhash64("h", "from"), F.lit(SALTS)))
    planned = planned.withColumnRenamed("source", "of").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    met = chunks.join(planned, chunks["source"].eqNullSafe(planned["of"]) & (chunks["salt"] == planned["part"]))
    more = F.when(F.col("h") < F.col("edge"), F.col("n")).when((F.col("h") == F.col("edge")) & (F.col("size") > 0), F.least("n", F.floor(F.col("left") / F.col("size") + 0.5))).otherwise(0)
    each = met.withColumn("more", more).withColumn("k", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + CHUNK, "n") - 1)))
    taken = F.col("size") * (F.col("copies") + F.when(F.col("k") < F.col("more"), 1).otherwise(0))
    return each.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
