"""SimHash near-duplicates: 64-bit fingerprints, and exact comparison of them in tiles.

Comparing every fingerprint with every other is quadratic, so tiles are cut inside buckets that lose no link: of
``radius + 1`` parts of two fingerprints that differ in ``radius`` bits at least one is equal, so every part keys a
bucket. In each bucket, whatever its size, distinct fingerprints are ordered by population count and cut into tiles of
about ``TILE``; a pair of tiles is a group of its own, so a large bucket is spread over tasks, and pairs of tiles whose
population counts differ beyond the radius are never made. In a group numpy takes the exclusive-or of neighbours at
growing distances in that order and counts the bits; a row leaves when its neighbour's population count is beyond the
radius. Links that close a ring are left out, so a group gives fewer links than it has fingerprints.

Defined results: null, empty and wordless texts have fingerprint zero and are linked like any other; a null
doc_id is kept with its fingerprint's component (null if no row of it has an id); an empty table gives no rows;
repeated rows are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_pass, cut, row_keys
from .components import connected_components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
TILE = 2048
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15


def fingerprint(text: str | None, k: int = 3, seed: int = 42) -> int:
    """Bit i is 1 if over half of the XXH64 of the ``k``-word shingles (repeats included) have it set."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(UPPER)
    ws = WORD.findall(raw)
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= k:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[: len(ws) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), ">u8", len(ws) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), CHUNK):
        part = h[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(documents: DataFrame, k: int = 3, seed: int = 42, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and fp (the fingerprint as a signed long) of every whole text."""
    df = documents.select(*keep, F.col("text").alias("__text"))
    kind = ", ".join(f"`{n}` {t}" for n, t in df.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [signed(fingerprint(t.as_py(), k, seed)) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp, pa.int64())], [*keep, "fp"])

    return arrow_pass(df, run, f"{kind}, fp long")


def near_links(fp: np.ndarray, ones: np.ndarray, ends: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of groups laid end to end, each ordered by population count (``ones``), less those that close a ring.

    ``ends`` is where a row's group ends. Rows of different ``side`` are compared; side 0 is compared with itself too
    where the whole group has it.
    """
    label, out = np.arange(len(fp)), []
    active, d = np.arange(len(fp)), 0
    while len(active):
        d += 1
        active = active[active + d < ends[active]]
        active = active[ones[active + d] - ones[active] <= radius]  # in order: what is beyond now stays beyond
        other = active + d
        meet = (side[active] != side[other]) | (side[active] == 2)
        i, j = active[meet], other[meet]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= radius
        i, j = i[near], j[near]
        new = label[i] != label[j]
        if not new.any():
            continue
        top: dict[int, int] = {}  # of the labels that meet in this step

        def find(x: int, top: dict[int, int] = top) -> int:
            while top.get(x, x) != x:
                x = top[x]
            return x

        for x, y in zip(i[new].tolist(), j[new].tolist(), strict=True):
            u, v = find(int(label[x])), find(int(label[y]))
            if u != v:
                top[max(u, v)] = min(u, v)
                out.append((x, y))
        olds = np.array(sorted(top))
        moved = np.isin(label, olds)
        label[moved] = np.array([find(int(x)) for x in olds])[np.searchsorted(olds, label[moved])]
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return fp[pairs[:, 0]], fp[pairs[:, 1]]


def near_fingerprints(distinct: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """Links (a, b) of distinct fingerprints (column fp) that span all pairs within ``radius`` bits."""
    parts = radius + 1
    if not 0 < parts <= 16:
        raise ValueError("0 <= radius < 16 is needed")
    bounds = [64 * i // parts for i in range(parts + 1)]
    masks = [signed(((1 << (b - a)) - 1) << a) for a, b in zip(bounds, bounds[1:], strict=False)]
    keyed = distinct.select("fp", F.bit_count("fp").alias("ones"), F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("part", "key"))
    # A bucket's sizes by population count, at most 65 rows; running sums place each population count in tiles.
    bucket = Window.partitionBy("part", "key")
    sizes = keyed.groupBy("part", "key", "ones").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(bucket)).where("total > 1")
    start = F.sum("n").over(bucket.orderBy("ones")) - F.col("n")
    levels = sizes.withColumn("first", F.floor(start / tile).cast("int")).withColumn("shares", F.ceil(F.col("n") / tile).cast("int"))
    reach = F.collect_list(F.struct("first", "shares")).over(bucket.orderBy("ones").rangeBetween(-radius, radius))
    tiles = F.array_distinct(F.flatten(F.transform(reach, lambda x: F.sequence(x["first"], x["first"] + x["shares"] - 1))))
    levels = levels.select("part", "key", "ones", "first", "shares", tiles.alias("tiles"))
    dealt = keyed.join(levels, ["part", "key", "ones"]).withColumn("me", F.col("first") + F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int"))
    spread = dealt.select("fp", "ones", "part", "key", "me", F.explode("tiles").alias("other"))
    side = F.when(F.col("me") == F.col("other"), 2).otherwise((F.col("me") > F.col("other")).cast("int"))
    groups = spread.select("part", "key", F.least("me", "other").alias("p"), F.greatest("me", "other").alias("q"), "fp", "ones", side.alias("side"))
    ordered = groups.repartition("part", "key", "p", "q").sortWithinPartitions("part", "key", "p", "q", "ones")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None  # the rows of the last group so far: two tiles at most

        def links(rows: list[np.ndarray], edges: np.ndarray) -> pa.RecordBatch:
            ends = np.repeat(edges[1:], np.diff(edges))
            a, b = near_links(rows[4].view(np.uint64), rows[5], ends, rows[6], radius)
            return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in range(7)]
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            edges = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in rows[:4]])) + 1
            at = int(edges[-1]) if len(edges) else 0
            if at:
                yield links([x[:at] for x in rows], np.concatenate(([0], edges)))
            rest = [x[at:] for x in rows]
        if rest is not None and len(rest[0]):
            yield links(rest, np.array([0, len(rest[0])]))

    return arrow_pass(ordered, run, "a long, b long").distinct()


def _named(prints: DataFrame, radius: int) -> DataFrame:
    """fp, least (smallest doc_id of the fingerprint), component (a fingerprint) of every distinct fingerprint."""
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    parts = connected_components(near_fingerprints(distinct, radius))
    # Fingerprints without links are their own component.
    return distinct.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))


def simhash_components(documents: DataFrame, k: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (smallest doc_id reachable) for every row."""
    prints = cut(fingerprints(documents, k, seed), "fingerprints")
    named = _named(prints, radius)
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    member = named.select("fp", "component").join(smallest, "component").select("fp", "component_id")
    return prints.join(member, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, k: int = 3, radius: int = 2) -> DataFrame:
    """One row of each group stays: one with the smallest doc_id (null ids last), of those the one with the least key.

    A row's key is a 128-bit hash of all its columns, so repeated and null ids stay apart; of equal rows one stays.
    Keys of what goes, by far the fewer, are joined to the rows, so texts stay where they are while those keys can be
    broadcast, and move once otherwise.
    """
    rows = documents.select(F.struct("*").alias("row"), "doc_id", "text", *row_keys(documents))
    prints = cut(fingerprints(rows, k, keep=("doc_id", "key", "key2")), "fingerprints")
    named = _named(prints, radius).select("fp", "component")
    own = prints.groupBy("fp", "doc_id", "key", "key2").agg(F.count("*").alias("n")).join(named, "fp")
    first = own.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "key2", "n")).alias("first"))
    stay = F.col("first.key").isNotNull() & (F.col("first.key") == F.col("key")) & (F.col("first.key2") == F.col("key2"))
    judged = cut(own.join(first, "component").select("key", "key2", "n", stay.alias("stay")).where("not stay or n > 1"), "judged")
    once = judged.where("stay").select("key", "key2")
    keyed = rows.select("row", "key", "key2")
    kept = keyed.join(judged.select("key", "key2"), ["key", "key2"], "left_anti")
    return kept.unionByName(keyed.join(once, ["key", "key2"], "left_semi").dropDuplicates(["key", "key2"])).select("row.*")
