"""WARC archives, index first: write records and their index, then read selected records by byte ranges.

``write_warc`` packs each partition's rows into archive files in a shared folder, one gzip member a record, and
returns the index: file, offset, length, url, digest, kind and referred record. An archive's name is new for each
attempt of a task and only files of finished tasks are in the index (it is written out at once), so a lost
executor leaves unused files at most. Pages in many small partitions are gathered in fewer tasks, so that they don't make
as many small archives. ``read_warc`` sorts the selected index rows by file and offset, coalesces neighbouring ranges and
parses the records, in batches bounded by their unpacked bytes.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest id is a response and the
others revisit it. Only ids and digests are grouped, after partial aggregation, so a payload that a third of all
pages share costs no more than any other.

Defined results: every row is one record; a null payload counts as empty; a null url is written as an empty one; rows
with null ids can neither be referred to nor be revisits; repeated ids are told apart by their payloads, and with equal
payloads both are responses (neither is smaller); an empty table writes no archive and returns no rows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH_BYTES, arrow_pass, cut, shared_folder

#: Ranges this close together are fetched by one read, up to so many bytes.
GAP, READ = 64 << 10, 8 << 20
#: An archive is closed when it has so many bytes.
ARCHIVE = 256 << 20
#: Tasks that write: so many a core, and so many at least where few cores are there yet.
TASKS, LEAST_TASKS = 4, 32
INDEX = "id long, file string, offset long, length long, url string, digest string, record_type string, refers_to long, payload_bytes long"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder URI (file:, hdfs:, s3: and whatever pyarrow reaches)."""
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri.removeprefix("file:")))


def writers(spark: SparkSession) -> int:
    """How many tasks write at most."""
    return max(TASKS * spark.sparkContext.defaultParallelism, LEAST_TASKS)


def revisits(rows: DataFrame, least: int = 0) -> DataFrame:
    """(id, sha, n, refers_to) of the rows that revisit another, once each; ``rows`` has id, sha and n (digest and bytes of the payload)."""
    keyed = rows.where(F.col("n") >= least).select("id", "sha", "n")
    first = keyed.groupBy("sha", "n").agg(F.min("id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1")
    return keyed.join(first.drop("copies"), ["sha", "n"]).where("id > refers_to").distinct()


def _record(id_: int | None, url: str, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if id_ is None else id_}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def gzip_member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_warc(pages: DataFrame, folder: str, id_: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Write every row as a record below ``folder`` (a URI that all executors reach) and return the index."""
    rows = pages.select(F.col(id_).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("n", F.length("payload"))
    most = writers(pages.sparkSession)
    again = cut(revisits(rows, least).coalesce(most), "revisits")
    dealt = rows.join(again, ["id", "sha", "n"], "left").select("id", "url", "payload", "refers_to").coalesce(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        out, name, at = None, "", 0
        try:
            for b in batches:
                index = []
                for i, u, p, r in zip(*(b.column(b.schema.get_field_index(n)) for n in ("id", "url", "payload", "refers_to")), strict=True):
                    if out is None or at > ARCHIVE:
                        if out is not None:
                            out.close()
                        store.create_dir(base, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    body, where = p.as_py(), r.as_py()
                    record, digest = _record(i.as_py(), u.as_py() or "", body, where)
                    member = gzip_member(record)
                    out.write(member)
                    index.append((i.as_py(), name, at, len(member), u.as_py(), digest, "response" if where is None else "revisit", where, len(body)))
                    at += len(member)
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                names = [x.split()[0] for x in INDEX.split(", ")]
                columns = list(zip(*index, strict=True)) if index else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)
        finally:
            if out is not None:
                out.close()

    return cut(arrow_pass(dealt, run, INDEX), "warc-index")


def parse_record(record: bytes) -> dict:
    """Fields of one record; of a revisit the payload is empty and its length comes from the archived HTTP head."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda x: int(x[len("<urn:page:") : -1]) if x and x != "<urn:page:>" else None
    return {
        "id": number(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields.get("WARC-Refers-To", "")),
        "stored_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
        "payload_bytes": length,
    }


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) as (start, end, members): neighbours within ``gap`` share a read up to ``most`` bytes."""
    start, end, inside = 0, 0, []
    for at, n in ranges:
        if inside and (at - end > gap or at + n - start > most):
            yield start, end, inside
            inside = []
        if not inside:
            start = at
        end = at + n
        inside.append((at, n))
    if inside:
        yield start, end, inside


def parsed(file: pa.NativeFile, ranges: list[tuple[int, int]], most: int = BATCH_BYTES) -> Iterator[list[dict]]:
    """Records at the sorted (offset, length) of an archive, in lists that are closed at ``most`` unpacked bytes."""
    for start, stop, members in coalesced(ranges):
        raw, found, held = file.read_at(stop - start, start), [], 0
        for at, n in members:
            record = zlib.decompress(raw[at - start : at - start + n], 31)
            found.append(parse_record(record))
            held += len(record)
            if held >= most:
                yield found
                found, held = [], 0
        if found:
            yield found


def _over_records(index: DataFrame, folder: str, made: Callable[[list[dict]], pa.RecordBatch], schema: str, partitions: int | None = None) -> DataFrame:
    """``made`` of the parsed records of the index rows given, in the pass that reads them.

    Rows are dealt by ranges of (file, offset), so one large archive is read by several tasks.
    """
    chosen = index.select("file", "offset", "length")
    n = partitions or index.sparkSession.sparkContext.defaultParallelism * 2
    ordered = chosen.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for b in batches:
            files, offsets, lengths = (b.column(i).to_pylist() for i in range(3))
            k = 0
            while k < len(files):
                end = k
                while end < len(files) and files[end] == files[k]:
                    end += 1
                with store.open_input_file(f"{base}/{files[k]}") as f:
                    for found in parsed(f, list(zip(offsets[k:end], lengths[k:end], strict=True))):
                        yield made(found)
                k = end

    return arrow_pass(ordered, run, schema)


def read_warc(index: DataFrame, folder: str, partitions: int | None = None) -> DataFrame:
    """Records of the index rows given (select any): id, url, record_type, refers_to, stored_digest, payload, payload_bytes."""
    kind = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("stored_digest", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64())])
    made = lambda found: pa.RecordBatch.from_pylist(found, schema=kind)
    return _over_records(index, folder, made, "id long, url string, record_type string, refers_to long, stored_digest string, payload binary, payload_bytes long", partitions)


def warc_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages, read all records back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's digest and length are computed from the bytes read back; a revisit's are those it was archived with.
    Digests are taken in the pass that reads, so payloads don't go through the JVM once more.
    """
    folder = shared_folder(pages.sparkSession, "warc")

    def digests(found: list[dict]) -> pa.RecordBatch:
        payloads = [r["payload"] for r in found]
        return pa.RecordBatch.from_pydict(
            {
                "page_id": pa.array([r["id"] for r in found], pa.int64()),
                "payload_bytes": pa.array([r["payload_bytes"] if p is None else len(p) for p, r in zip(payloads, found, strict=True)], pa.int64()),
                "payload_digest": pa.array([r["stored_digest"] if p is None else digest_of(p) for p, r in zip(payloads, found, strict=True)], pa.string()),
                "record_type": pa.array([r["record_type"] for r in found], pa.string()),
                "refers_to": pa.array([r["refers_to"] for r in found], pa.int64()),
            }
        )

    return _over_records(write_warc(pages, folder, least=least), folder, digests, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
