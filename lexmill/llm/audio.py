"""Telephony audio: mu-law and A-law by lookup tables, IMA ADPCM blocks by numpy across blocks, resampled PCM.

``store_telephony`` packs sample bytes into WAV; ``add_pcm`` decodes them into 16-bit PCM resampled to the wanted rate.
Both are columns of one table, which is written to the shared folder and read back before anything is measured. PCM is
kept in lifted form (``lift``): lossless, and what interpolation added costs next to nothing on disk. Work is row by row
inside Arrow batches: no shuffle, and memory is bounded by ``CHUNK_BYTES`` of stored samples at a time (one longer
medium is decoded in pieces of whole blocks).

Defined results: null or empty media give null PCM and zero measurements; bytes that are no WAV of a known codec
give codec null; ADPCM step indices beyond 88 are read as 88; a trailing part of a block is ignored by the
decoder but kept in the samples, so storage is always lossless; columns of the input that are named like the added
ones are replaced; repeated rows and null ids are rows like others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .common import arrow_pass, cut

#: WAV format tags (fixed values of RIFF WAVE).
FORMATS = {"alaw": 6, "mulaw": 7, "ima_adpcm": 17}
NAMES = {v: k for k, v in FORMATS.items()}
#: Bytes of an ADPCM block: a 4-byte header, then two samples a byte.
BLOCK = 144
CHUNK_BYTES = 1 << 20
#: zstd level of the table of media and PCM: smaller by some thirtieth than at 6.
LEVEL = 12
#: Index adjustment by the low three bits of an ADPCM code (fixed values of IMA ADPCM).
INDEX_STEP = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def _adpcm_steps() -> np.ndarray:
    """The 89 step sizes of IMA ADPCM (fixed values)."""
    return np.array(
        [
            7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
            130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166,
            1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845,
            8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
        ],
        np.int32,
    )


STEPS = _adpcm_steps()


def mulaw_table() -> np.ndarray:
    """16-bit sample of each mu-law byte (G.711)."""
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((code & 0x0F) << 3) + 0x84 << ((code >> 4) & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """16-bit sample of each A-law byte (G.711)."""
    code = np.arange(256, dtype=np.int32) ^ 0x55
    low, segment = (code & 0x0F) << 4, (code >> 4) & 7
    size = np.where(segment == 0, low + 8, (low + 0x108) << np.maximum(segment - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


TABLES = {"mulaw": mulaw_table(), "alaw": alaw_table()}


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """Decode blocks (n, size) of uint8 in step: one numpy pass per sample position covers all blocks."""
    n, size = blocks.shape
    head = np.ascontiguousarray(blocks[:, :4])
    value = head[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(head[:, 2], 88).astype(np.int32)
    out = np.empty((2 * (size - 4) + 1, n), np.int16)
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for t in range(2 * (size - 4)):
        code = (codes[t >> 1] >> (4 * (t & 1))) & 15
        step = STEPS[index]
        low = (code & 7).astype(np.int32)
        diff = (step >> 3) + step * (low >> 2) + (step >> 1) * ((low >> 1) & 1) + (step >> 2) * (low & 1)
        value = np.clip(np.where(code & 8, value - diff, value + diff), -32768, 32767)
        index = np.clip(index + INDEX_STEP[low], 0, 88)
        out[t + 1] = value
    return np.ascontiguousarray(out.T)


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Samples at the new instants, rounded to the nearest (halves up). Equal rates change nothing.

    Raising the rate interpolates linearly; lowering it takes the mean of the samples each new one stands for, which is
    the low-pass.
    """
    if rate == to or len(pcm) == 0:
        return pcm
    x = pcm.astype(np.int64)
    count = max(1, len(x) * to // rate)
    at = np.arange(count, dtype=np.int64) * rate
    if to > rate:
        i, part = at // to, at % to
        return ((x[i] * (to - part) + x[np.minimum(i + 1, len(x) - 1)] * part + to // 2) // to).astype(np.int16)
    edge = np.append(at // to, len(x))
    size = np.diff(edge)
    sums = np.concatenate(([0], np.cumsum(x)))
    return ((2 * (sums[edge[1:]] - sums[edge[:-1]]) + size) // (2 * size)).astype(np.int16)


def lift(pcm: np.ndarray) -> bytes:
    """PCM as its even samples, then what odd ones differ from the mean of their neighbours: the first step of a lifting scheme."""
    even, odd = pcm[::2], pcm[1::2]
    return even.astype("<i2").tobytes() + (odd - _between(even, len(odd))).astype("<i2").tobytes()


def unlift(data: bytes) -> np.ndarray:
    """The PCM of ``lift``."""
    both = np.frombuffer(data, "<i2").astype(np.int16)
    even = both[: (len(both) + 1) // 2]
    out = np.empty(len(both), np.int16)
    out[::2], out[1::2] = even, both[len(even) :] + _between(even, len(both) - len(even))
    return out


def _between(even: np.ndarray, n: int) -> np.ndarray:
    after = np.append(even[1:], even[-1:])
    return ((even[:n].astype(np.int32) + after[:n] + 1) >> 1).astype(np.int16)


def wav(codec: str, samples: bytes, rate: int = 8000) -> bytes:
    align, per = (BLOCK, 2 * (BLOCK - 4) + 1) if codec == "ima_adpcm" else (1, 0)
    bits, extra = (4, struct.pack("<HH", 2, per)) if per else (8, struct.pack("<H", 0))
    fmt = struct.pack("<HHIIHH", FORMATS[codec], 1, rate, rate * align // per if per else rate, align, bits) + extra
    count = len(samples) // align * per if per else len(samples)
    body = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, count) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * (len(samples) & 1)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def unwav(data: bytes) -> tuple[str | None, int, bytes]:
    """Codec, rate and sample bytes; codec None if it is no WAV of a known codec."""
    codec, rate, at = None, 0, 12
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        return None, 0, b""
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", data, at + 8)
            codec = NAMES.get(tag)
        elif name == b"data":
            return codec, rate, data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    return None, rate, b""


def store_telephony(df: DataFrame, payload: str, codec: str, out: str = "media") -> DataFrame:
    """Add ``out``: the bytes of column ``payload`` as WAV of the codec named in column ``codec``; null stays null."""
    df = df.drop(out)
    kind = StructType([*df.schema.fields, StructField(out, BinaryType())])
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, codecs = b.column(names.index(payload)), b.column(names.index(codec))
            media = [wav(c.as_py(), p.as_py()) if p.is_valid and c.is_valid and c.as_py() in FORMATS else None for p, c in zip(data, codecs, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(media, pa.binary())], [*names, out])

    return arrow_pass(df, run, kind)


def _measures(pcm: np.ndarray) -> tuple[int, float, int]:
    x = pcm.astype(np.int32)
    return int(np.abs(x).max(initial=0)), float(np.sqrt(np.mean(x.astype(np.float64) ** 2))) if len(x) else 0.0, int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))


def _decoded(stored: list[tuple[str | None, int, bytes]]) -> list[np.ndarray | None]:
    """PCM of each medium; the ADPCM blocks of all of them are decoded together."""
    out: list[np.ndarray | None] = [TABLES[c][np.frombuffer(s, np.uint8)] if c in TABLES else None for c, _, s in stored]
    own = [i for i, (c, _, s) in enumerate(stored) if c == "ima_adpcm"]
    if own:
        counts = [len(stored[i][2]) // BLOCK for i in own]
        blocks = np.frombuffer(b"".join(stored[i][2][: n * BLOCK] for i, n in zip(own, counts, strict=True)), np.uint8).reshape(-1, BLOCK)
        pcm = [decode_adpcm(blocks[k : k + CHUNK_BYTES // BLOCK]) for k in range(0, len(blocks), CHUNK_BYTES // BLOCK)]
        flat = np.concatenate(pcm).reshape(-1) if pcm else np.empty(0, np.int16)
        ends = np.cumsum(np.array(counts) * (2 * (BLOCK - 4) + 1))
        for i, part in zip(own, np.split(flat, ends[:-1]), strict=True):
            out[i] = part
    return out


def add_pcm(df: DataFrame, media: str = "media", rate: int = 16000, out: str = "pcm") -> DataFrame:
    """Add ``out``: 16-bit PCM of the WAV bytes in column ``media`` at ``rate``, lifted; null where there is none."""
    df = df.drop(out)
    names = df.columns
    kind = StructType([*df.schema.fields, StructField(out, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made: list[bytes | None] = []
            size, group = 0, []
            cells = b.column(names.index(media))
            for k, cell in enumerate(cells):
                group.append(unwav(cell.as_py() or b""))
                size += len(group[-1][2])
                if size >= CHUNK_BYTES or k == len(cells) - 1:
                    made += [lift(resample(pcm, at, rate)) if pcm is not None and len(pcm) else None for (_, at, _), pcm in zip(group, _decoded(group), strict=True)]
                    size, group = 0, []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.binary())], [*names, out])

    return arrow_pass(df, run, kind)


#: Added by ``measure``.
MEASURES = [("codec", StringType()), ("samples", BinaryType()), ("pcm_length", LongType()), ("pcm_crc32", LongType()), ("peak", IntegerType()), ("rms", DoubleType()), ("crossings", LongType())]


def measure(df: DataFrame, media: str = "media", pcm: str = "pcm") -> DataFrame:
    """Add codec and samples (the bytes in the WAV), and length, CRC-32, peak, rms and zero crossings of the PCM."""
    df = df.drop(*(n for n, _ in MEASURES))
    names = df.columns
    kind = StructType([*df.schema.fields, *(StructField(n, t) for n, t in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for cell, kept in zip(b.column(names.index(media)), b.column(names.index(pcm)), strict=True):
                codec, _, samples = unwav(cell.as_py() or b"")
                x = unlift(kept.as_py() or b"").astype("<i2", copy=False)
                rows.append((codec, samples, len(x), zlib.crc32(x.tobytes()), *_measures(x)))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in MEASURES]
            kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True))], [*names, *(n for n, _ in MEASURES)])

    return arrow_pass(df, run, kind)


def telephony_digests(documents: DataFrame, pad: int = 576, rate: int = 16000) -> DataFrame:
    """Each text as UTF-8, padded with bytes 255 to a positive multiple of ``pad``, stored, read back and measured.

    The codec follows from the payload alone (its length in units of ``pad``, modulo 3), so equal texts give equal
    values. Media and PCM at ``rate`` are written to the shared folder, where they stay; what is returned comes from the
    bytes read back. Columns: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.
    Null texts count as empty. Other columns of the input are left out.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    base = documents.select("doc_id", text.alias("raw")).withColumn("n_bytes", F.length("raw").cast("long"))
    units = F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / pad)).cast("int")
    base = base.select(
        "doc_id",
        "n_bytes",
        F.element_at(F.array(*(F.lit(c) for c in FORMATS)), units % 3 + 1).alias("as_codec"),
        F.concat("raw", F.unhex(F.repeat(F.lit("FF"), (units * pad - F.col("n_bytes")).cast("int")))).alias("payload"),
    )
    read = measure(cut(add_pcm(store_telephony(base, "payload", "as_codec").drop("payload", "as_codec"), rate=rate), "telephony", LEVEL)).drop("pcm")
    names = read.columns

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(names)}
            samples, media = ([x.as_py() for x in col[c]] for c in ("samples", "media"))
            feature = [f"{c};pcm={n};crc={k:08x};peak={p};rms={r:.3f};crossings={z}" for c, n, k, p, r, z in zip(*(col[c].to_pylist() for c in ("codec", "pcm_length", "pcm_crc32", "peak", "rms", "crossings")), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": col["doc_id"],
                    "n_bytes": col["n_bytes"],
                    "payload_bytes": pa.array([len(s) for s in samples], pa.int64()),
                    "payload_sha256": pa.array([hashlib.sha256(s).hexdigest() for s in samples], pa.string()),
                    "tail_crc32": pa.array([zlib.crc32(s[-32:]) for s in samples], pa.int64()),
                    "media_bytes": pa.array([len(m) for m in media], pa.int64()),
                    "media_sha256": pa.array([hashlib.sha256(m).hexdigest() for m in media], pa.string()),
                    "feature": pa.array(feature, pa.string()),
                }
            )

    kind = dict(documents.dtypes)["doc_id"]
    return arrow_pass(read, digests, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
