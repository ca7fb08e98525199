"""Line dedup by distinct-site spread: lines that many sites share are boilerplate and are removed.

One aggregation by line hash counts its occurrences and builds a HyperLogLog sketch of its sites; both are built before
the shuffle, so a line that a third of all rows have reaches the shuffle as one row a task. Lines whose estimate is
clearly above the threshold are boilerplate, those clearly below are not, and those within the sketch's error get exact
distinct counts. Lines of a document that are boilerplate are found by a join on the line hash and are handed to their
row by a join on a 128-bit hash of all its columns; Spark broadcasts either small side if it is small.

A line's key is its text without blanks, tabs and carriage returns at the ends; blank lines are never removed.
Defined results: null texts stay null; null sites count as one site; empty tables give empty results; every row
stays, perhaps with an empty text; repeated rows count once for each site, like other lines of that site; null and
repeated ids play no part; columns of the input that are named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, row_keys

#: Sites from which a line is boilerplate.
MIN_SITES = 10
LG_K = 11
BLANK = " \t\r"


def _key(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def line_spread(documents: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """line (hash) of every line that at least ``min_sites`` distinct sites have."""
    where = F.coalesce(F.col(site), F.lit("")) if dict(documents.dtypes)[site] == "string" else F.coalesce(F.col(site).cast("string"), F.lit(""))
    lines = documents.select(where.alias("site"), F.explode(F.split("text", "\n")).alias("line")).select("site", _key(F.col("line")).alias("line")).where("line <> ''")
    lines = cut(lines.select("site", F.xxhash64("line").alias("line")), "lines")
    counted = lines.groupBy("line").agg(F.count("*").alias("n"), F.hll_sketch_agg("site", LG_K).alias("sketch")).where(F.col("n") >= min_sites)
    estimates = cut(counted.select("line", F.hll_sketch_estimate("sketch").alias("sites")), "spread")
    error = 3 * 1.04 / (2**LG_K) ** 0.5
    low, high = min_sites * (1 - error), min_sites * (1 + error)
    sure = estimates.where(F.col("sites") > high).select("line")
    near = estimates.where((F.col("sites") >= low - 1) & (F.col("sites") <= high)).select("line")
    # Distinct pairs first, unless the few lines can be broadcast: the optimizer then puts the join first by itself.
    exact = lines.distinct().join(near, "line", "left_semi").groupBy("line").agg(F.count("*").alias("sites"))
    return sure.union(exact.where(F.col("sites") >= min_sites).select("line"))


def remove_lines(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """``documents`` with the lines whose hash is in ``lines`` removed from text; adds n_lines and n_removed."""
    documents = documents.drop("n_lines", "n_removed")
    split = F.split("text", "\n")
    rows = documents.select(F.struct("*").alias("row"), "text", *row_keys(documents))
    parts = rows.select("key", "key2", F.explode(F.array_distinct(F.transform(split, lambda x: F.xxhash64(_key(x))))).alias("line"))
    hits = cut(parts.join(lines, "line", "left_semi").groupBy("key", "key2").agg(F.collect_set("line").alias("gone")), "boilerplate-of-rows")  # a row's own lines
    joined = rows.join(hits, ["key", "key2"], "left")
    kept = F.filter(split, lambda x: (_key(x) == "") | ~F.array_contains("gone", F.xxhash64(_key(x))))
    left = joined.select("row", "text", "gone", F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"), F.when(F.col("gone").isNotNull(), kept).alias("kept"))
    hit = F.col("kept").isNotNull()
    new = F.when(hit, F.array_join("kept", "\n")).otherwise(F.col("text")).alias("text")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("long")
    n_removed = F.when(hit, F.col("n_lines") - F.size("kept")).otherwise(0).cast("long")
    return left.select(*(new if c == "text" else F.col("row").getField(c).alias(c) for c in documents.columns), n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def line_dedup(documents: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """All documents without cross-site boilerplate lines; adds n_lines and n_removed."""
    return remove_lines(documents, cut(line_spread(documents, min_sites), "boilerplate"))


def strip_boilerplate(documents: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The columns of ``documents``, boilerplate lines removed and n_chars counted anew."""
    kept = documents.select(F.struct("*").alias("__row"), "text", "source")  # no column name can clash with n_lines or n_removed
    done = line_dedup(kept, min_sites)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(documents.dtypes).get("n_chars", "int"))}
    return done.select(*(new[n].alias(n) if n in new else F.col("__row").getField(n).alias(n) for n in documents.columns))
