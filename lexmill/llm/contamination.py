"""Benchmark decontamination: which documents contain which test items.

Size-partitioned MinHash containment search. Items are partitioned by the size of their set of 5-word shingles
(powers of two). For each size U the documents' shingle sequences are seen as windows of 2 U shingles at every
U-th place, so an occurrence of an item lies whole in a window at most a few times its size: the Jaccard
similarity of item and window then stays above a bound that doesn't depend on the document's length, and the
bands (of one row) are tuned to it. Where an item's parts stand far apart, a band's least shingle still is the least of
the window that holds it about as often, so what windows cut is found as well. Minima of blocks of U shingles give
those of the windows, and blocks of a size those of the next. A window that collides with an item in a band is a
candidate; candidates are verified by exact containment of the item's shingles (compared as words) in those of the
whole document. An item of fewer than ``k`` words is one shingle of them all; the runs of so many words of every
document are looked up in a table of such items.

Items are the stated query set. They are sent to the tasks in blocks of about ``BLOCK_BYTES`` text (a block may hold one
longer item), as text with hashes and band values of some five times that size; each block is one pass over the
documents, without a shuffle. Rows come one for each document and item.

Defined results: wordless items and documents match nothing; null ids are returned as null; repeated rows match each
by itself, repeated items as often as they stand there; empty tables match nothing; extra columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass, permutations, shingle_hashes, word_hashes, words

THRESHOLD, SHINGLE = 0.8, 5
#: Wanted chance that a contained item meets its window in a band.
RECALL = 0.999
BLOCK_BYTES = 16 << 20
#: Shingles of a document whose hashes are permuted at a time.
CHUNK = 1 << 13
#: Bits of the bitmap that is asked before a size's key table.
LOW = 1 << 20
#: Items whose shingles a task keeps.
KEPT = 4096


def bands_for(threshold: float, recall: float) -> int:
    """Bands of one row: an item of U/2 to U shingles in a window of 2 U has a similarity of at least j."""
    j = threshold * 0.5 / (2 + 0.5 * (1 - threshold))
    return math.ceil(math.log(1 - recall) / math.log(1 - j))


def shingle_set(ws: list[str], k: int) -> set[str]:
    """The runs of ``k`` words; none if there are fewer."""
    return {" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)}


class Items:
    """A block of the benchmark (item_id, text, how often it stands there): by size the band values with their items."""

    def __init__(self, rows: list[tuple[int | None, str | None, int]], k: int, threshold: float) -> None:
        self.k, self.threshold = k, threshold
        self.a, self.b = permutations(bands_for(threshold, RECALL))
        by_size: dict[int, list] = {}
        short: dict[int, list] = {}
        self.items: list[tuple[int | None, str, int]] = []
        self.seen: dict[int, frozenset[str]] = {}
        for item_id, text, times in rows:
            if len(ws := word_hashes(text)):
                h = np.unique(shingle_hashes(ws, k))
                if len(ws) < k:
                    short.setdefault(len(ws), []).append((h[0], len(self.items)))
                else:
                    by_size.setdefault(1 << math.ceil(math.log2(len(h))), []).append((self.minima(h, [0])[0], len(self.items)))
                self.items.append((item_id, text, times))
        #: By size: the sorted keys, whose they are, and a bitmap of their low bits.
        self.tables = {}
        for size, found in sorted(by_size.items()):
            keys = self.keys(np.stack([v for v, _ in found])).ravel()
            self.tables[size] = self.table(keys, np.repeat(np.array([i for _, i in found]), len(self.a)))
        #: By number of words: hashes of whole short items.
        self.short = {n: self.table(np.array([h for h, _ in found], np.uint64), np.array([i for _, i in found])) for n, found in short.items()}

    @staticmethod
    def table(keys: np.ndarray, whose: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        low = np.zeros(LOW, bool)
        low[keys & np.uint64(LOW - 1)] = True
        return keys[order], whose[order], low

    @staticmethod
    def look_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray], found: set[int]) -> None:
        values, whose, low = table
        keys = keys[low[keys & np.uint64(LOW - 1)]]
        for a, b in zip(np.searchsorted(values, keys, "left").tolist(), np.searchsorted(values, keys, "right").tolist(), strict=True):
            found.update(whose[a:b].tolist())

    def shingles(self, i: int) -> frozenset[str]:
        """The shingles of an item; the last ones asked for are kept."""
        if i not in self.seen:
            if len(self.seen) >= KEPT:
                self.seen.clear()
            ws = words(self.items[i][1])
            self.seen[i] = frozenset(shingle_set(ws, min(self.k, len(ws))))
        return self.seen[i]

    def minima(self, h: np.ndarray, starts: list[int] | np.ndarray) -> np.ndarray:
        """Least permuted values (runs, bands) of the runs of ``h`` that begin at ``starts``."""
        x = h[:, None] * self.a + self.b
        x ^= x >> np.uint64(29)
        return np.minimum.reduceat(x, starts, axis=0)

    def keys(self, least: np.ndarray) -> np.ndarray:
        """A band's values are never equal to another's: its offset is added after an odd product."""
        return (least * np.uint64(0x9E3779B97F4A7C15)) ^ self.b

    def candidates(self, ws: np.ndarray) -> set[int]:
        """Items that collide with a window of the text of word hashes ``ws``."""
        found: set[int] = set()
        for n, table in self.short.items():
            if len(ws) >= n:
                self.look_up(shingle_hashes(ws, n), table, found)
        if len(ws) < self.k or not self.tables:
            return found
        h = shingle_hashes(ws, self.k)
        base, most = min(self.tables), max(self.tables)
        for at in range(0, len(h), CHUNK):
            piece = h[at : at + CHUNK + 2 * most]
            least, size = self.minima(piece, np.arange(0, len(piece), base)), base
            for want, table in self.tables.items():
                while size < want:
                    if len(least) % 2:
                        least = np.concatenate((least, least[-1:]))
                    least, size = np.minimum(least[::2], least[1::2]), 2 * size
                self.look_up(self.keys(np.minimum(least, np.concatenate((least[1:], least[-1:])))).ravel(), table, found)
        return found


def contained(items: Items, text: str | None) -> Iterator[tuple[int, int, int]]:
    """(place, shared shingles, shingles of the item) of the items of a block that ``text`` contains."""
    own: dict[int, set[str]] = {}
    ws = None
    for i in sorted(items.candidates(word_hashes(text))):
        wanted = items.shingles(i)
        k = min(items.k, next(iter(wanted)).count(" ") + 1)
        if k not in own:
            ws = words(text) if ws is None else ws
            own[k] = shingle_set(ws, k)
        if (shared := len(wanted & own[k])) >= items.threshold * len(wanted):
            yield i, shared, len(wanted)


def find_items(documents: DataFrame, rows: list[tuple[int | None, str | None, int]], threshold: float, k: int) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) for one block of items."""
    held = documents.sparkSession.sparkContext.broadcast(Items(rows, k, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0), b.column(1), strict=True):
                for i, shared, size in contained(items, text.as_py()):
                    item_id, _, times = items.items[i]
                    out += [(doc_id.as_py(), item_id, shared, size, shared / size)] * times
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [b.schema.types[0], pa.int64(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "shared", "item_shingles", "containment"])

    return arrow_pass(documents.select("doc_id", "text"), run, f"doc_id {dict(documents.dtypes)['doc_id']}, item_id long, shared int, item_shingles int, containment double")


def without_items(documents: DataFrame, rows: list[tuple[int | None, str | None, int]], threshold: float, k: int) -> DataFrame:
    """The rows of ``documents`` that contain none of one block of items; ids play no part."""
    held = documents.sparkSession.sparkContext.broadcast(Items(rows, k, threshold))
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        for b in batches:
            yield b.filter(pa.array([next(contained(items, t.as_py()), None) is None for t in b.column(at)], pa.bool_()))

    return arrow_pass(documents, run, documents.schema)


def blocks_of(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str | None, int]]]:
    """The items in blocks; one block at least, which may be empty."""
    items = benchmark.groupBy(F.col("item_id").cast("long").alias("item_id"), "text").agg(F.count("*").alias("times"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    for n in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).collect()  # a block's bytes at most, on average
        yield [tuple(r) for r in rows]


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every (doc_id, item_id) whose containment is at least ``threshold``, with shared, item_shingles, containment."""
    out = None
    for rows in blocks_of(benchmark, block_bytes):
        found = find_items(documents, rows, threshold, k)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that contain no benchmark item. Each is judged by its own text, whatever rows share its doc_id."""
    for rows in blocks_of(benchmark, block_bytes):
        documents = without_items(documents, rows, threshold, k)
    return documents
