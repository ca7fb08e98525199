"""Byte-level BPE with a local rank file: encode whole texts, decode ids to the raw bytes.

``pattern`` splits a text into pieces that are merged separately. Long texts are first cut at safe boundaries:
in front of a space or line feed that follows a visible character. No alternative of the pattern reads across
such a place (white space only ever begins a piece there, and a look-ahead at the end of the left part sees no
white space), so ids are the same as for the uncut text. A text without such a place stays whole.

Defined results: a null text counts as empty, and has no ids. Decoding gives bytes, which need not be UTF-8 for
arbitrary ids; ids outside the vocabulary raise.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import arrow_pass

#: Rank file and pattern used where none are given. The file must be at this path on every executor.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters up to which a text is encoded in one call.
PART = 1 << 16
SAFE = re.compile(r"(?<=[!-~À-ɏ])(?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, read once in each Python worker."""
    with open(ranks, "rb") as f:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def parts(text: str, most: int = PART) -> Iterator[str]:
    """``text`` cut at the first safe boundary after every ``most`` characters."""
    at = 0
    while len(text) - at > most:
        if not (m := SAFE.search(text, at + most)):
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def encode(enc: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PART:
        return enc.encode_ordinary(text)
    return [i for part in parts(text) for i in enc.encode_ordinary(part)]


def encode_texts(df: DataFrame, text: str = "text", out: str = "ids", ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Add ``out``: array<int> of the ids of column ``text`` (null: empty), in place of a column of that name."""
    df = df.drop(out)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for b in batches:
            ids = [np.array(encode(enc, t.as_py() or ""), np.int32) for t in b.column(names.index(text))]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [*names, out])

    return arrow_pass(df, run, StructType([*df.schema.fields, StructField(out, ArrayType(IntegerType()))]))


def decode_ids(df: DataFrame, ids: str = "ids", out: str = "bytes", ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Add ``out``: the raw bytes of column ``ids``; null ids give null. A column of that name is replaced."""
    df = df.drop(out)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for b in batches:
            lists = b.column(names.index(ids))
            raw = [enc.decode_bytes(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else None for x in lists]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())], [*names, out])

    return arrow_pass(df, run, StructType([*df.schema.fields, StructField(out, BinaryType())]))


def bpe_digests(documents: DataFrame, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (little-endian unsigned 32-bit ids) and decoded_sha256 of every whole text; with ``keep_ids`` also ids.

    Null texts are empty ones; null and repeated ids and repeated rows are rows like others; other columns play no part.
    """
    coded = decode_ids(encode_texts(documents.select("doc_id", "text")).drop("text"))
    names = coded.columns

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [x.values.to_numpy(zero_copy_only=False).astype("<u4") for x in b.column(names.index("ids"))]
            raw = [x.as_py() for x in b.column(names.index("bytes"))]
            kept = {"ids": b.column(names.index("ids"))} if keep_ids else {}
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": b.column(names.index("doc_id")),
                    "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                    **kept,
                }
            )

    return arrow_pass(coded, digests, f"doc_id {dict(documents.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string{', ids array<int>' if keep_ids else ''}")
