"""Substring dedup: paragraphs by MinHash banding, exact verification, and removal by connected components.

Paragraphs of a text are its lines of at least ``LENGTH`` words (the whole text if no line has so many), and, as a
repeated passage may stand anywhere in a longer line, ``LENGTH`` words from every anchor on: of every ``WINDOW``
neighbouring 5-word shingles the one with the least hash is an anchor, so any passage of ``LENGTH + WINDOW - 1`` words
(51) gives the same paragraph in every document that has it. Lines get bands of ``ROWS`` MinHash values, tuned for recall at
the threshold. Windows that repeat three words in themselves (a few hundredths) get bands as well. All others get runs of words
instead, which miss nothing at 0.8 and collide with little that isn't similar: of such a window's 16 shingles a similar
paragraph lacks one at most (three, if it is a text of under 20 words), what it has stands in one piece, so two windows share
their first or last 19 words (``runs``), and a line has the window's words 3 to 16 (``core``). Only lines that repeat three
words can have the pieces in another order; they are given all orders (``spliced``). Below 0.8 all windows get bands. Equal paragraphs (by 128 bits of hash) are one; distinct ones that collide in a band are joined in tiles, each
pair is verified by the exact Jaccard similarity of the shingle sets, and components of verified links are classes.
What the smallest doc_id of a class has stays and the rest is to be removed.

Defined results: a text with fewer words than a shingle is one shingle of them all; null and wordless texts have no
paragraph. Rows with null ids are left alone. Repeated rows count as one document. Repeats inside one document count
only if asked for (``inside``): junk that repeats a word is full of them. An empty table gives no rows; extra columns
play no part, one named like an added one is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .common import arrow_pass, cut, drop, mix, permutations, powers_of, shingle_hashes, words, words_by_line, written
from .components import connected_components

THRESHOLD, SHINGLE = 0.8, 5
LENGTH, WINDOW = 20, 32
#: The words of ``words`` in the text as written.
WORD = re.compile(r"[A-Za-z0-9_\x80-\U0010ffff]+")
#: Wanted chance that a pair at the threshold collides in a band (lines, windows), and rows of a band.
RECALL, RECALL_WINDOW, ROWS = 0.98, 0.95, 2
#: Words of a run and of a core, where a core begins in its window, and how many shingles a paragraph similar to a window may have.
RUN, CORE, CORE_AT, FEWEST, MOST = LENGTH - 1, 14, 3, 13, 20
#: Distinct paragraphs of a bucket that meet in one tile.
TILE = 512


def bands_for(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _sliding(x: np.ndarray, window: int, least: bool) -> np.ndarray:
    """Minima (or maxima) of all runs of ``window`` values, by runs of doubled length."""
    best = np.minimum if least else np.maximum
    size = 1
    while 2 * size <= window:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - (window - size)], x[window - size :]) if window > size else x


def anchors(h: np.ndarray, last: int, window: int = WINDOW) -> np.ndarray:
    """Places up to ``last`` that hold the least shingle hash of some run of ``window`` places; of a repeated shingle's run the first."""
    h = h[: last + 1]
    window = min(window, len(h))
    least = _sliding(h, window, True)
    pad = np.zeros(window - 1, h.dtype)
    chosen = h == _sliding(np.concatenate((pad, least, pad)), window, False)
    chosen[1:] &= h[1:] != h[:-1]
    return np.flatnonzero(chosen)


def places_of(n: int, h: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts and sizes (in words) of the paragraphs of a text of ``n`` words with shingles ``h`` and line starts ``lines``; how many are no windows."""
    edges = np.concatenate(([0], lines, [n]))
    starts, sizes = edges[:-1], np.diff(edges)
    long = sizes >= LENGTH
    starts, sizes = (starts[long], sizes[long]) if long.any() else (np.array([0]), np.array([n]))
    if n <= LENGTH:
        return starts, sizes, len(starts)
    at = anchors(h, n - LENGTH)
    at = at[~np.isin(at, starts[sizes == LENGTH])]
    return np.concatenate((starts, at)), np.concatenate((sizes, np.full(len(at), LENGTH))), len(starts)


def repeats(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal values, each with the next one, that are up to ``most`` apart."""
    order = np.argsort(x, kind="stable")
    sorted_ = x[order]
    same = np.flatnonzero(sorted_[1:] == sorted_[:-1])
    first, second = order[same], order[same + 1]
    near = second - first <= most
    return first[near], second[near]


def repeating(first: np.ndarray, second: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Whether the windows at ``at`` of ``n`` words have the same three words twice, by the places of repeats."""
    near = second - first <= LENGTH - 3
    if not near.any():
        return np.zeros(len(at), bool)
    marks = np.zeros(n, np.int64)  # each repeat spoils the windows that begin from second - 17 to first
    np.add.at(marks, np.maximum(second[near] - (LENGTH - 3), 0), 1)
    np.add.at(marks, first[near] + 1, -1)
    return np.cumsum(marks)[at] > 0


def spliced(ws: list[int]) -> set[tuple[int, ...]]:
    """All runs of ``CORE`` words, no three of them twice, whose shingles are among those of ``ws``, but for one at most."""
    k = SHINGLE - 1
    nodes = {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}
    there = {tuple(ws[i : i + SHINGLE]) for i in range(len(ws) - k)}
    after: dict[tuple[int, ...], list[tuple[int, ...]]] = {}
    for v in nodes:
        after.setdefault(v[:-1], []).append(v)
    out, open_ = set(), [(v, 1) for v in nodes if v[:3] != v[1:4]]
    while open_:
        path, spare = open_.pop()
        if len(path) == CORE:
            out.add(path)
            continue
        had = {path[i : i + 3] for i in range(len(path) - 2)}
        for v in after.get(path[-k + 1 :], []):
            left = spare - ((*path[-k:], v[-1]) not in there)
            if left >= 0 and (*path[-2:], v[-1]) not in had:
                open_.append(((*path, v[-1]), left))
    return out


class _Ragged:
    """Keys of rows, gathered as (row, key), mixed and handed over as a list column."""

    def __init__(self) -> None:
        self.rows, self.keys = [], []

    def add(self, rows: np.ndarray, keys: np.ndarray) -> None:
        """``keys`` has a row of keys for each of ``rows``, or one key."""
        self.rows.append(np.repeat(rows, keys.size // max(1, len(rows))))
        self.keys.append(keys.ravel())

    def column(self, n: int) -> pa.Array:
        if not self.rows:
            return pa.array([[]] * n, pa.list_(pa.int64()))
        rows = np.concatenate(self.rows)
        flat = mix(np.concatenate(self.keys)[np.argsort(rows, kind="stable")]).view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n)))), pa.int32()), pa.array(flat))


def paragraphs(documents: DataFrame, bands: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, start (word), size (words), h and h2 (128 bits of a hash of its words) of every paragraph, and its keys.

    keys: bands and runs; core: of a window, met by cores of lines. A line of a window's size has the keys of the window too.
    """
    count = bands or bands_for()
    few = min(count, bands_for(recall=RECALL_WINDOW))
    a, b = permutations(count * ROWS, seed=3)
    kind = dict(documents.dtypes)["doc_id"]
    up = [np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, sizes, hashes, middles, total = [], [], [], [], [], 0
            keys, cores = _Ragged(), _Ragged()
            for k, text in enumerate(batch.column(1)):
                ws, lines = words_by_line(text.as_py())
                if len(ws) == 0:
                    continue
                h = shingle_hashes(ws, SHINGLE)
                at, size, n = places_of(len(ws), h, lines)
                shingles = np.maximum(size - SHINGLE + 1, 1)
                windows = np.arange(n, len(at))
                threes = repeats(shingle_hashes(ws, 3), MOST + SHINGLE - 4)
                odd = windows[repeating(*threes, at[n:], len(ws))] if threshold >= THRESHOLD else windows
                y = h * a[:, None] + b[:, None]
                y ^= y >> np.uint64(29)
                edges = np.stack((at[:n], at[:n] + shingles[:n]), axis=1).ravel()
                of_lines = np.minimum.reduceat(np.concatenate((y, y[:, -1:]), axis=1), edges, axis=1)[:, ::2]
                keys.add(np.arange(total, total + n), of_lines.T.reshape(-1, count, ROWS).sum(axis=2, dtype=np.uint64) + np.arange(count, dtype=np.uint64))
                if len(odd):
                    of_odd = y[: few * ROWS, at[odd][:, None] + np.arange(LENGTH - SHINGLE + 1)].min(axis=2)
                    keys.add(odd + total, of_odd.T.reshape(-1, few, ROWS).sum(axis=2, dtype=np.uint64) + np.arange(few, dtype=np.uint64))
                # Polynomials over the words by differences of running sums, as for the words themselves.
                pair, first = [], None
                for base in up:
                    powers, back = powers_of(int(base), len(ws))
                    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(ws * powers, dtype=np.uint64)))
                    of_runs = lambda x, m, sums=sums, back=back: (sums[x + m] - sums[x]) * back[x] + np.uint64(m)
                    first = first or of_runs
                    pair.append((sums[at + size] - sums[at]) * back[at] + size.astype(np.uint64))
                both = np.concatenate((np.flatnonzero(size[:n] == LENGTH), windows))
                keys.add(both + total, np.stack((first(at[both], RUN), first(at[both] + 1, RUN)), axis=1))
                middle = np.zeros(len(at), np.uint64)
                middle[n:] = first(at[n:] + CORE_AT, CORE)
                # Lines of few shingles, by size, or, where shingles repeat, by count: of 21 in a line of 20 different ones two are equal.
                few_words = size[:n] <= MOST + SHINGLE - 1
                again = len(repeats(h, MOST)[0]) > 0
                for i in np.flatnonzero((size[:n] >= FEWEST + SHINGLE - 1) & (few_words | again)):
                    p, m, words_n = int(at[i]), int(shingles[i]), int(size[i])
                    distinct = len(np.unique(h[p : p + m])) if again else m
                    if not FEWEST <= distinct <= MOST:
                        continue
                    found = first(np.arange(p, p + words_n - CORE + 1), CORE)
                    if distinct > FEWEST + 2 and (not few_words[i] or ((threes[0] >= p) & (threes[1] <= p + words_n - 3)).any()):
                        more = np.array(list(spliced(ws[p : p + words_n].tolist())), np.uint64).reshape(-1, CORE)
                        found = np.unique(np.concatenate((found, (more * powers_of(int(up[0]), CORE)[0]).sum(axis=1, dtype=np.uint64) + np.uint64(CORE))))
                    cores.add(np.full(len(found), i + total), found)
                ids.append(np.full(len(at), k)), starts.append(at), sizes.append(size), hashes.append(np.stack(pair, axis=1))
                middles.append(pa.array(mix(middle).view(np.int64), mask=np.arange(len(at)) < n))
                total += len(at)
            if not ids:
                continue
            both = mix(np.concatenate(hashes)).view(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0).take(pa.array(np.concatenate(ids))),
                    "start": pa.array(np.concatenate(starts), pa.int32()),
                    "size": pa.array(np.concatenate(sizes), pa.int32()),
                    "h": pa.array(np.ascontiguousarray(both[:, 0])),
                    "h2": pa.array(np.ascontiguousarray(both[:, 1])),
                    "keys": keys.column(total),
                    "core": pa.concat_arrays(middles),
                    "cores": cores.column(total),
                }
            )

    return arrow_pass(documents.where("doc_id is not null").select("doc_id", "text"), run, f"doc_id {kind}, start int, size int, h long, h2 long, keys array<long>, core long, cores array<long>")


def _alike(x: frozenset[str], y: frozenset[str], threshold: float) -> bool:
    """Whether the Jaccard similarity is ``threshold`` or more; sizes that cannot reach it are not intersected."""
    a, b = len(x), len(y)
    if min(a, b) < threshold * max(a, b):
        return False
    n = len(x & y)
    return n >= threshold * (a + b - n)


def _similar(groups: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between similar distinct paragraphs (rep, t) of a tile pair (key, p, q): a spanning forest of them.

    Rows come sorted by group; a group holds two tiles at most, so what is kept in memory is bounded.
    """
    names = ["key", "p", "q", "side", "rep", "t"]
    ordered = groups.select(*names).repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def shingles(text: str) -> frozenset[str]:
        ws = text.split(" ")
        return frozenset(" ".join(ws[i : i + SHINGLE]) for i in range(max(1, len(ws) - SHINGLE + 1)))

    def links(rows: list[tuple[int, int, str]], same: bool) -> Iterator[tuple[int, int]]:
        # A paragraph is compared with the first of each class so far, then with the others of those classes that it isn't linked to.
        sets, classes = [shingles(t) for _, _, t in rows], []
        for i, x in enumerate(sets):
            joined, rest = [], []
            for members in classes:
                hit = next((j for j in members if (same or rows[i][0] != rows[j][0]) and _alike(x, sets[j], threshold)), None)
                if hit is None:
                    rest.append(members)
                else:
                    joined += members
                    yield rows[hit][1], rows[i][1]
            classes = [*rest, [*joined, i]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for b in batches:
            out: list[tuple[int, int]] = []
            for key, p, q, side, rep, t in zip(*(b.column(i).to_pylist() for i in range(len(names))), strict=True):
                if (key, p, q) != group:
                    out += links(rows, group is None or group[1] == group[2])
                    group, rows = (key, p, q), []
                rows.append((side, rep, t))
            yield _pairs(out)
        yield _pairs(list(links(rows, group is None or group[1] == group[2])))

    return arrow_pass(ordered, run, "a long, b long")


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})


def _tiles(hits: DataFrame, tile: int = TILE) -> DataFrame:
    """(key, rep) of buckets of two or more as tile pairs (key, p, q, side, rep): no group is larger than two tiles or so."""
    sizes = hits.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    dealt = hits.join(sizes, "key").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return spread.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).cast("int").alias("side"), "rep")


def _texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """pid and words (joined by blanks) of the wanted paragraphs (pid, doc_id, start, size)."""
    places = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("pid", "start", "size")).alias("places"))  # a document's own paragraphs
    rows = documents.select("doc_id", "text").join(places, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pids, texts = [], []
            for text, own in zip(b.column(1), b.column(2), strict=True):
                ws = words(text.as_py())
                for p in own.as_py():
                    pids.append(p["pid"]), texts.append(" ".join(ws[p["start"] : p["start"] + p["size"]]))
            yield pa.RecordBatch.from_pydict({"pid": pa.array(pids, pa.int64()), "t": pa.array(texts, pa.string())})

    return arrow_pass(rows, run, "pid long, t string")


def repeated_paragraphs(documents: DataFrame, threshold: float = THRESHOLD, inside: bool = False) -> DataFrame:
    """doc_id, start, size (in words), class_id (smallest doc_id of the class), kept of every repeated paragraph.

    Only classes that span at least two documents are returned; with ``inside`` also those of one document that repeat
    in it, and then only the first place of the smallest document is kept. Rows of a repeated document repeat.
    """
    spark = documents.sparkSession
    whole, whole_at = written(paragraphs(documents, threshold=threshold), "paragraphs")
    # Equal paragraphs are one row: what is banded and compared are distinct ones, so copies cost no comparison.
    place = F.struct("doc_id", "start", "size")
    distinct = whole.groupBy("h", "h2").agg(F.min(place).alias("at"), F.max(place).alias("end"), F.max_by(F.struct("keys", "core", "cores"), F.size("keys")).alias("by"))
    banded, banded_at = written(distinct.select("h", "h2", "at.*", F.col("end.doc_id").alias("last"), (F.col("at") < F.col("end")).alias("again"), "by.*").withColumn("pid", F.monotonically_increasing_id()), "distinct")
    paras, paras_at = written(whole.drop("keys", "core", "cores"), "places")
    drop(spark, whole_at)
    keyed = banded.select("pid", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # Cores of windows are only of use where a line has them, and are few then: no need to count all of them.
    lines, windows = banded.select("pid", F.explode("cores").alias("key")), banded.where("core is not null").select("pid", F.col("core").alias("key"))
    met, met_at = written(windows.join(lines.select("key").distinct(), "key", "left_semi").select("pid", "key"), "cores")
    by_core = met.unionByName(lines.join(met.select("key").distinct(), "key", "left_semi").select("pid", "key"))
    hits, hits_at = written(keyed.join(shared, "key").select("pid", "key").unionByName(by_core).distinct(), "colliding")
    drop(spark, met_at)
    distinct = cut(banded.drop("keys", "core", "cores"), "unbanded")  # the keys are most of its bytes and have been used
    drop(spark, banded_at)
    places = distinct.select("pid", "doc_id", "start", "size").join(hits.select("pid").distinct(), "pid")
    texts, texts_at = written(_texts(documents, places), "paragraph-texts")
    near = _similar(_tiles(hits.withColumnRenamed("pid", "rep")).join(texts.select(F.col("pid").alias("rep"), "t"), "rep"), threshold)
    links, links_at = written(near, "paragraph-links")
    drop(spark, texts_at)
    drop(spark, hits_at)
    linked = cut(connected_components(links), "paragraph-components")
    drop(spark, links_at)
    own = distinct.select("h", "h2", place.alias("at"), "last", "again", "pid")
    members = own.join(linked, F.col("pid") == F.col("node"))
    spans = members.groupBy("component").agg(F.min("at").alias("first"), F.max("last").alias("final"))
    spans = spans if inside else spans.where("first.doc_id < final")
    joined = members.join(spans, "component").select("h", "h2", "first")
    alone = own.where("again" if inside else "at.doc_id < last").join(linked, F.col("pid") == F.col("node"), "left_anti").select("h", "h2", F.col("at").alias("first"))
    classes = cut(joined.unionByName(alone), "classes")
    stays = place == F.col("first") if inside else F.col("doc_id") == F.col("first.doc_id")
    return paras.join(classes, ["h", "h2"]).select("doc_id", "start", "size", F.col("first.doc_id").alias("class_id"), stays.alias("kept"))


def remove_repeats(documents: DataFrame, repeats: DataFrame) -> DataFrame:
    """``documents`` without the paragraphs of ``repeats`` that are not kept; adds n_cut (words removed)."""
    documents = documents.drop("n_cut")
    gone = repeats.where("not kept").groupBy("doc_id").agg(F.collect_set(F.struct("start", "size")).alias("gone"))  # a document's own
    joined = documents.select(F.struct("*").alias("row"), "doc_id", "text").join(gone, "doc_id", "left").select("row", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for text, own in zip(b.column(1), b.column(2), strict=True):
                t, spans = text.as_py(), own.as_py()
                new, n = without_words(t, [(s["start"], s["start"] + s["size"]) for s in spans]) if t is not None and spans else (t, 0)
                texts.append(new), counts.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], ["row", "text", "n_cut"])

    done = arrow_pass(joined, run, StructType([joined.schema["row"], StructField("text", StringType()), StructField("n_cut", IntegerType())]))
    return done.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in documents.columns), "n_cut")


def without_words(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """``text`` without the words of the (start, end) spans and what stands between them; words removed."""
    places = [m.span() for m in WORD.finditer(text)]  # lower-casing joins and splits no words: what it adds is no separator
    out, at, n, end = [], 0, 0, 0
    for a, b in sorted(spans):
        a, b = max(a, end), min(b, len(places))
        if a < b:
            out.append(text[at : places[a][0]])
            at, n, end = places[b - 1][1], n + b - a, b
    return "".join([*out, text[at:]]), n
