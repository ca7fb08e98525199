"""What the operators share: the shared folder, lineage cuts, Arrow passes, words and shingle hashes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch handed to Python. Long texts make a batch of few rows.
BATCH_BYTES = 1 << 20
#: Bytes that a task gathers before it writes a row group of an intermediate table.
ROW_GROUP = 32 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share.

    Where the session sets none, a session on one machine (tests) gets a folder of its own; a cluster must set it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Write ``df`` to the shared folder (zstd at ``level``) and read it back: a lost executor recomputes nothing before it."""
    return written(df, name, level)[0]


def written(df: DataFrame, name: str, level: int = 3) -> tuple[DataFrame, str]:
    """``cut`` with the path, for ``drop`` once all that reads it is written as well."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of our own that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def bound_batches(spark: SparkSession) -> None:
    """Set ``BATCH_BYTES`` for Arrow batches, the one session setting that the operators need; a smaller one of the user's stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(name)).rstrip("bB")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def arrow_pass(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over batches that are bounded in bytes, so very long texts don't gather in one."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def row_keys(df: DataFrame) -> tuple[Column, Column]:
    """key and key2: a 128-bit hash of all columns of a row, so that repeated and null ids stay apart; equal rows have equal ones."""
    names = [F.col(f"`{c}`") for c in df.columns]
    own = [*names, *(c.isNull() for c in names)]  # a null leaves the hash as it is
    return F.xxhash64(*own).alias("key"), F.xxhash64(F.lit("second"), *own).alias("key2")


def batch(**columns: pa.Array | list | np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


#: Maps ASCII other than letters, digits and the underscore to blanks.
SEPARATORS = bytes(c if c >= 128 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1


def words(text: str | None) -> list[str]:
    """Lower-cased runs of ASCII letters, digits, underscores and any characters beyond ASCII."""
    return [w.decode("utf-8", "surrogatepass") for w in _plain(text).split()]


def _plain(text: str | None) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(SEPARATORS) if text else b""


def powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` powers of the odd ``base`` modulo 2**64, and those of its inverse."""
    up, down = _powers(base, 1 << max(16, (n - 1).bit_length()))
    return up[:n], down[:n]


@functools.lru_cache(maxsize=16)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    up = np.full(n, base, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each of ``words(text)``, without a Python object for each.

    Bytes are coefficients of a polynomial whose running sums give every word's own by a difference. Long texts are
    taken in pieces that end between words, so memory beyond the text stays bounded (but for words that are longer).
    """
    return hashed_words(_plain(text))[0]


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``raw``, whose separators are blanks, and the places where they begin."""
    out, places, at = [], [], 0
    while at < len(raw):
        end = at + PIECE
        if end >= len(raw) or (end := raw.find(b" ", end)) < 0:
            end = len(raw)
        b = np.frombuffer(raw, np.uint8, end - at, at)
        up, down = powers_of(BASE, len(b))
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(b * up[: len(b)], out=sums[1:])
        inside = np.zeros(len(b) + 2, np.int8)
        inside[1:-1] = b != 32
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        places.append(starts + at)
        at = end
    return (np.concatenate(out), np.concatenate(places)) if out else (np.empty(0, np.uint64), np.empty(0, np.int64))


def words_by_line(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes(text)`` and how many words precede each line but the first."""
    low = text.lower().encode("utf-8", "surrogatepass") if text else b""
    hashes, places = hashed_words(low.translate(SEPARATORS))
    return hashes, np.searchsorted(places, np.flatnonzero(np.frombuffer(low, np.uint8) == 10))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(word_hashes: np.ndarray, k: int = 5) -> np.ndarray:
    """64-bit hash of each run of ``k`` words; fewer words make one shingle of all; none make none."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(k, n)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i : n - k + 1 + i]
    return mix(h)


def permutations(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``count`` hash permutations of 64-bit values."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, count, dtype=np.uint64)
