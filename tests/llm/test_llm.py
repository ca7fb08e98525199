"""The ten operators and the pipeline against brute force, round trips and held-out accuracy."""

import base64
import collections
import datetime as dt
import fractions
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import audio, bpe, contamination, langid, linededup, paradedup, pii, simhash, toxicity, warc
from lexmill.llm.common import shared_folder
from lexmill.llm.components import connected_components

SMALL = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, score double, n_lines int, fp string"
PROSE = " ".join(f"word{i * 7919 % 401}" for i in range(400))


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and clashing names."""
    rows = [
        (1, PROSE, "en", "s1", 1, 0.5, 1, "a"), (1, PROSE, "en", "s1", 1, 0.5, 1, "a"), (2, PROSE + " end", "en", "s2", 1, None, None, None), (3, None, None, None, None, None, None, None),
        (4, "", "en", "s1", 0, 0.0, 0, ""), (5, " \n\t ", "de", None, 1, 0.0, 0, ""), (None, "no id here", "fr", "s3", 1, 0.0, 0, ""), (6, PROSE * 40, "en", "s4", 1, 0.0, 0, ""), (7, "12345 !!", None, "s5", 1, 0.0, 0, ""),
    ]
    return spark.createDataFrame(rows, KIND).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


def groups(links, nodes):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {n: find(n) for n in nodes}


def brute_pcm(codec, samples):
    """One sample after the other, from the recommendations' own words."""
    out = []
    if codec == "mulaw":
        for c in samples:
            c = ~c & 255
            size = ((2 * (c & 15) + 33) << (c >> 4 & 7)) - 33
            out.append(4 * (-size if c & 128 else size))
    elif codec == "alaw":
        for c in samples:
            c ^= 0x55
            segment = c >> 4 & 7
            size = 2 * (c & 15) + 1 if segment == 0 else (2 * (c & 15) + 33) << (segment - 1)
            out.append(8 * (size if c & 128 else -size))
    else:
        for at in range(0, len(samples) // audio.BLOCK * audio.BLOCK, audio.BLOCK):
            block = samples[at : at + audio.BLOCK]
            value, index = struct.unpack_from("<h", block)[0], min(block[2], 88)
            out.append(value)
            for byte in block[4:]:
                for code in (byte & 15, byte >> 4):
                    step = int(audio.STEPS[index])
                    diff = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
                    value = max(-32768, min(32767, value - diff if code & 8 else value + diff))
                    index = max(0, min(88, index + [-1, -1, -1, -1, 2, 4, 6, 8][code & 7]))
                    out.append(value)
    return out


def brute_resampled(x, rate, to):
    n = max(1, len(x) * to // rate)
    if to < rate:
        edge = [k * rate // to for k in range(n)] + [len(x)]
        return [math.floor(fractions.Fraction(sum(x[a:b]), b - a) + fractions.Fraction(1, 2)) for a, b in zip(edge, edge[1:])]
    at = [fractions.Fraction(k * rate, to) for k in range(n)]
    return [math.floor(x[int(t)] * (1 - t % 1) + x[min(int(t) + 1, len(x) - 1)] * (t % 1) + fractions.Fraction(1, 2)) for t in at]


def test_audio(spark, edge):
    assert audio.TABLES["mulaw"][[0xFF, 0x7F, 0x00, 0x80]].tolist() == [0, 0, -32124, 32124]
    assert audio.TABLES["alaw"][[0xD5, 0x55, 0x2A]].tolist() == [8, -8, -32256]
    rng = np.random.default_rng(3)
    for codec in audio.FORMATS:
        samples = rng.integers(0, 256, 3 * audio.BLOCK + 5, dtype=np.uint8).tobytes()
        stored = audio.unwav(audio.wav(codec, samples))
        assert stored == (codec, 8000, samples)
        plain = brute_pcm(codec, samples)
        assert audio._decoded([stored])[0].tolist() == plain
        for to in (16000, 8000, 11025, 6000, 44100):
            new = audio.resample(np.array(plain, np.int16), 8000, to)
            assert new.tolist() == (plain if to == 8000 else brute_resampled(plain, 8000, to))
            assert audio.unlift(audio.lift(new)).tolist() == new.tolist()
    assert all(audio.unlift(audio.lift(x)).tolist() == x.tolist() for x in (np.array(v, np.int16) for v in ([], [7], [-32768, 32767], [32767, -32768, -32768])))
    assert audio.unwav(b"RIFFxxxxWAVE") == (None, 0, b"") and audio.unwav(b"") == (None, 0, b"")
    names = list(audio.FORMATS)
    clash = edge.select("*", *(F.lit("x").alias(n) for n in ("media", "codec", "samples", "pcm", "payload")))
    for table in (edge, clash):
        got = audio.telephony_digests(table).collect()
        assert len(got) == edge.count()
        text = {(r["doc_id"], r["text"]) for r in edge.collect()}
        for r in got:
            want = []
            for t in (t for i, t in text if i == r["doc_id"]):
                raw = (t or "").encode()
                size = max(576, -(-len(raw) // 576) * 576)
                p = raw.ljust(size, b"\xff")
                codec = names[size // 576 % 3]
                media, x = audio.wav(codec, p), np.array(brute_pcm(codec, p), np.int64) if len(p) < 50_000 else None
                feature = r["feature"]
                if x is not None:
                    y = np.array(brute_resampled(x.tolist(), 8000, 16000), np.int64)
                    crossings = sum((a < 0) != (b < 0) for a, b in zip(y.tolist(), y.tolist()[1:]))
                    feature = f"{codec};pcm={len(y)};crc={zlib.crc32(y.astype('<i2').tobytes()):08x};peak={np.abs(y).max()};rms={np.sqrt(np.mean(y.astype(float) ** 2)):.3f};crossings={crossings}"
                want.append((len(raw), size, hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            assert tuple(r)[1:] in want
    odd = spark.createDataFrame([(None,), (b"",), (b"no wav",), (audio.wav("mulaw", b""),)], "media binary")
    rows = audio.measure(audio.add_pcm(odd)).collect()
    assert [(r["codec"], r["pcm"], r["pcm_length"], r["peak"]) for r in rows] == [(None, None, 0, 0)] * 3 + [("mulaw", None, 0, 0)]
    assert audio.telephony_digests(edge.limit(0)).count() == 0


def brute_contained(docs, items, k=5, least=0.8):
    word = re.compile(r"[a-z0-9_\x80-\U0010ffff]+")

    def shingles(ws, n):
        return {" ".join(ws[i : i + n]) for i in range(len(ws) - n + 1)}

    own = [(i, word.findall((t or "").lower())) for i, t in docs]
    own = [(i, {n: shingles(ws, n) for n in range(1, k + 1)}) for i, ws in own]
    wanted = [(i, ws := word.findall((t or "").lower()), min(k, len(ws))) for i, t in items]
    return sorted((d, i) for d, s in own for i, ws, n in wanted if ws and len((w := shingles(ws, n)) & s[n]) >= least * len(w))


def test_decontamination(spark, edge, docs):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    pairs = lambda df, it: [(r["doc_id"], r["item_id"]) for r in contamination.contaminated(df, it).collect()]
    want = brute_contained(docs.select("doc_id", "text").collect(), items.collect())
    assert sorted(pairs(docs, items)) == want and want
    own = spark.createDataFrame([(1, " ".join(PROSE.split()[50:80])), (2, None), (3, ""), (None, "no id here")], "item_id long, text string")
    found = pairs(edge, own)
    assert sorted(i for d, i in found if i == 1) == [1] * 4 and (None, None) in found
    # Items of one to four words inside long texts, repeated items, and parts of an item that stand far apart.
    ws = PROSE.split()
    far = " ".join(ws[:200] + [f"q{i}" for i in range(3000)] + ws[200:])
    texts = spark.createDataFrame([(1, PROSE * 30), (2, far), (3, ws[9]), (4, "nothing of it")], "doc_id long, text string")
    short = [(n, " ".join(ws[40 : 40 + n])) for n in range(1, 6)] + [(9, " ".join(ws[180:220])), (9, " ".join(ws[180:220])), (10, ws[9].upper() + "!"), (11, "nothing"), (12, "absent here")]
    items = spark.createDataFrame(short, "item_id long, text string")
    assert sorted(pairs(texts, items)) == brute_contained(texts.collect(), short) and (2, 9) in pairs(texts, items)
    assert pairs(edge, own.limit(0)) == [] and pairs(edge.limit(0), own) == []
    assert {r["doc_id"] for r in contamination.decontaminate(edge, own).collect()} == {3, 4, 5, 7}


def test_rows_are_judged_by_themselves(spark):
    """Null and repeated ids: a clean row stays whatever rows share its doc_id; of copies one stays."""
    own = lambda s: " ".join(f"{s}{i * i % 1009}" for i in range(80))
    item = " ".join(PROSE.split()[50:80])
    rows = [(None, own("a"), "x"), (None, f"{own('b')} {item}", "x"), (None, own("c"), None), (7, own("d"), "x"), (7, f"{item} {own('e')}", "x"), (8, own("f"), "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    items = spark.createDataFrame([(1, item), (2, own("z")[:150])], "item_id long, text string")
    clean = {r for r in rows if item not in r[1]}
    assert {tuple(r) for r in contamination.decontaminate(table, items).collect()} == clean
    assert {tuple(r) for r in contamination.decontaminate(table, items, block_bytes=100).collect()} == clean
    more = [*rows, (None, own("c"), "other"), (None, own("a"), "x"), (9, own("f"), "x"), (7, own("d"), "x"), (None, own("f"), "x")]
    kept = [tuple(r) for r in simhash.keep_one(spark.createDataFrame(more, table.schema)).collect()]
    assert sorted(t for _, t, _ in kept) == sorted(t for _, t, _ in rows) and {i for i, t, _ in kept if t == own("f")} == {8}


def test_toxicity(spark):
    bad = ["you are a stupid worthless idiot number {}", "hey YOU!!! 1d1ot loser {} pathetic", "trash you moron {} hate you"]
    good = ["the weather in town {} was fine today", "a report on item {} of the list", "we met at {} and had tea"]
    rows = [(i, (bad if i % 3 == 0 else good)[i // 3 % 3].format(i), int(i % 3 == 0)) for i in range(360)]
    documents = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, None), (900, "", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (900, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(documents, labels).collect()}
    assert len(got) == 362 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (i in set(held)) for i, _, _ in rows)
    assert np.mean([got[i]["predicted"] == y for i, _, y in rows if i in set(held)]) > 0.9
    none = toxicity.toxicity(documents, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}


def test_toxic_words_of_few_rows(spark):
    """A language with less than a tenth of the toxic rows is learned; copies of one text are one."""
    rows = [(f"common insult number {i}", 1) for i in range(200)] + [(f"seltenwort und die {i}", 1) for i in range(6)] + [("copied phrase", 1)] * 60 + [(f"plain text of {i} und die", 0) for i in range(400)]
    now, less_clean, less_toxic = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert {"common", "insult", "number", "seltenwort"} == now & {"common", "insult", "number", "seltenwort", "copied", "phrase", "die", "und"}
    assert less_toxic <= now <= less_clean and "die" not in toxicity.FIXED
    some = [(f"seltenwort hier {i}", 1) for i in range(5)] + [(f"plain {i}", 0) for i in range(99)]
    now, _, less_toxic = toxicity.learn_lexicon(spark.createDataFrame(some, "text string, toxic int"))
    assert "seltenwort" in now and "seltenwort" not in less_toxic


def test_held_out_toxicity(spark):
    """On rows that nothing was learned from: scores order them as a plain count over the sample's words nearly does, or better."""
    d = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.toxicity(documents, labels).where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    rank = got.score.rank()
    auc = (rank[got.toxic == 1].sum() - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * len(clean))
    assert toxic.predicted.mean() >= 0.8 and clean.predicted.mean() <= 0.01 and auc >= 0.9, (toxic.predicted.mean(), clean.predicted.mean(), auc)


def brute_lines(rows, least=10):
    sites = collections.defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if key := line.strip(" \t\r"):
                sites[key].add(source or "")
    gone = {k for k, s in sites.items() if len(s) >= least}
    cut = lambda t: None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" \t\r") not in gone)
    return [(i, cut(t)) for i, t, _ in rows]


def test_lines(spark, edge, docs):
    rows = [(100 * n + s, f"shared by {n}\nown {n} {s}\n\n", f"s{s}") for n in (8, 9, 10, 11, 12) for s in range(n)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for threshold in ("10485760", "-1"):  # the small sides broadcast, and joined
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = {r["doc_id"]: r["text"] for r in linededup.line_dedup(table).collect()}
        assert got == dict(brute_lines(rows))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    odd = spark.createDataFrame([(None, "shared by 12\nkept", "s1", 7, "x"), (None, None, None, None, None), (5, "", "s2", 1, "y"), (5, "shared by 12", "s3", 1, "y")], "doc_id long, text string, source string, n_lines int, key string")
    both = table.select("*", F.lit(0).alias("n_lines"), F.lit("z").alias("key")).unionByName(odd)
    done = linededup.line_dedup(both).where("key <> 'z' or key is null")
    assert sorted(map(str, done.select("doc_id", "text", "n_lines", "n_removed", "key").collect())) == sorted(
        map(str, spark.createDataFrame([(None, "kept", 2, 1, "x"), (None, None, 0, 0, None), (5, "", 1, 0, "y"), (5, "", 1, 1, "y")], "doc_id long, text string, n_lines long, n_removed long, key string").collect())
    )
    stripped = linededup.strip_boilerplate(edge)
    assert stripped.columns == edge.columns and stripped.count() == edge.count()
    assert linededup.line_dedup(edge.limit(0).select("doc_id", "text", "source")).count() == 0


def test_bpe(spark, edge):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", "a", "don't <|endoftext|>", "é　  x\n\n y", ("word  \n\n 12345 été\t! " * 9000), "x" * 3000 + "퟿ 漢字" * 50]
    for t in texts:
        assert bpe.encode(bpe.encoding(bpe.RANKS, bpe.PATTERN), t) == plain.encode_ordinary(t)
    rows = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.bpe_digests(edge).collect()}
    want = {(r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in edge.collect() if (ids := plain.encode_ordinary(r["text"] or "")) is not None}
    assert rows == want


def test_warc(spark):
    rows = [(3, "u", "<p>x</p>"), (1, None, "<p>x</p>"), (2, "u v", None), (5, "u", ""), (4, "é", "<p>é</p>"), (7, "u", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, digest string")
    got = {r["page_id"]: r for r in warc.warc_round_trip(pages).collect()}
    for i, _, html in rows:
        raw = (html or "").encode()
        first = min(j for j, _, h in rows if (h or "") == (html or ""))
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("response", None) if first == i else ("revisit", first))
    assert warc.warc_round_trip(pages.limit(0)).count() == 0
    # Repeated and null ids: one record a row, no payload lost.
    rows = [(1, "A"), (2, "A"), (2, "B"), (3, "C"), (3, "C"), (0, "C"), (-1, "D"), (3, "D"), (None, "A"), (None, None)]
    folder = shared_folder(spark, "warc-test")
    table = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    read = warc.read_warc(warc.write_warc(table, folder), folder).collect()
    assert len(read) == len(rows) and {r["payload"].decode() for r in read if r["payload"] is not None} == {"A", "B", "C", "D", ""}
    got = sorted((r["id"] if r["id"] is not None else 99, r["record_type"], r["refers_to"]) for r in read)
    key = lambda i, h: min(j for j, g in rows if g == h and j is not None) if h else None
    want = sorted((99 if i is None else i, *(("response", None) if i is None or i == key(i, h) else ("revisit", key(i, h)))) for i, h in rows)
    assert got == want
    assert list(warc.coalesced([(0, 10), (12, 5), (1000, 5)], gap=10)) == [(0, 17, [(0, 10), (12, 5)]), (1000, 1005, [(1000, 5)])]


def test_warc_bounds(spark):
    # Pages that shrink a thousandfold: one read holds them all, a batch holds no more than its bound and one record.
    page, n = b"a" * 300_000, 40
    members = [warc.gzip_member(warc._record(i, "u", page, None)[0]) for i in range(n)]
    ends = np.cumsum([len(m) for m in members]).tolist()
    lists = list(warc.parsed(pa.BufferReader(b"".join(members)), list(zip([0, *ends[:-1]], map(len, members), strict=True)), 1 << 20))
    assert [r["id"] for x in lists for r in x] == list(range(n)) and all(r["payload"] == page for x in lists for r in x)
    assert len(lists) > 1 and max(sum(len(r["payload"]) for r in x) for x in lists) <= (1 << 20) + len(page)
    # Many small partitions are written by few tasks; nothing is lost, also where copies cross partitions.
    pages = spark.range(3000).selectExpr("id AS page_id", "'u' AS url", "CAST(id % 1000 AS STRING) AS html").repartition(200)
    index = warc.write_warc(pages, shared_folder(spark, "warc-test"))
    assert index.count() == 3000 and index.where("record_type = 'revisit' AND refers_to = id % 1000").count() == 2000
    assert index.select("file").distinct().count() <= warc.writers(spark)
    # Digests are taken by the pass that reads.
    plan = warc.warc_round_trip(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def brute_fingerprint(text):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not ws:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + 3]), 42) for i in range(max(1, len(ws) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, edge, docs):
    for table in (docs, edge.where("doc_id is not null").dropDuplicates(["doc_id"])):
        fp = {r["doc_id"]: brute_fingerprint(r["text"]) for r in table.collect()}
        links = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2]
        want = groups(links, fp)
        got = {r["doc_id"]: r for r in simhash.simhash_components(table).collect()}
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(r["fingerprint"] == f"{fp[i]:016x}" for i, r in got.items())
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 3, dtype=np.int64)
    near = {int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 60, (60, 2))}
    near |= {int(x) for x in base} | {int(x) for x in rng.integers(-(2**63), 2**63, 300, dtype=np.int64)} | {0, -1, 1, -(2**63)}
    table = spark.createDataFrame([(x,) for x in near], "fp long")
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    for radius, tile in ((2, 16), (2, 2048), (2, 1), (0, 8), (5, 40)):  # one way of comparison at every size
        links = [(r["a"], r["b"]) for r in simhash.near_fingerprints(table, radius, tile=tile).collect()]
        want = groups([(a, b) for a in near for b in near if a < b and bits(a, b) <= radius], near)
        assert groups(links, near) == want and all(bits(a, b) <= radius for a, b in links)
    assert simhash.near_fingerprints(table.limit(0)).count() == 0 and simhash.simhash_components(edge.limit(0)).count() == 0
    kept = simhash.keep_one(edge).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None)[:1] == [1] and sum(r["doc_id"] is None for r in kept) == 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (7, None), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 200: 200, 201: 200}


def test_pseudonyms(spark):
    key = b"k"
    for domain in (1, 2, 10, 97, 1000):
        image = [pii.permuted(x, domain, key, "t") for x in range(domain)]
        assert sorted(image) == list(range(domain)) and [pii.permuted(y, domain, key, "t", back=True) for y in image] == list(range(domain))
    text = "card 4111 1111 1111 1111 on 2024-02-29, again 4111-1111-1111-1111; bad 4111 1111 1111 1112, 2024-02-31"
    new, found = pii.pseudonymized(text, key)
    assert [f[0] for f in found] == ["card", "date", "card"]
    cards = [re.sub(r"\D", "", f[3]) for f in found if f[0] == "card"]
    assert cards[0] == cards[1] != "4111111111111111" and pii.luhn(cards[0][:-1]) == int(cards[0][-1])
    dt.date.fromisoformat(found[1][3])
    assert "4111 1111 1111 1112" in new and "2024-02-31" in new and len(new) == len(text)
    table = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, None, None), (3, "", None), (None, text * 999, "y")], "doc_id long, text string, findings string")
    done = pii.pseudonymize(table, key)
    rows = {r["doc_id"]: r for r in done.collect()}
    assert rows[1]["text"] == new and rows[2]["text"] is None and rows[3]["findings"] == [] and len(rows[None]["findings"]) == 3 * 999
    assert done.count() == 5 and done.columns == table.columns and pii.pseudonymize(table.limit(0), key).count() == 0
    # The same value in other notations: the same pseudonym in them.
    same = lambda *xs, f=lambda x: re.sub(r"\D", "", x): len({f(pii.pseudonymized(x, key)[0]) for x in xs}) == 1
    assert same("+49 151 2345678", "+491512345678", "+49-151-234-5678") and same("(212) 555-0123", "212-555-0123", "212 555 0123")
    assert same("John.Doe@x.org", "john.doe@x.org", "JOHN.DOE@X.ORG", f=str.lower) and pii.pseudonymized("John.Doe@x.org", key)[0][0].isupper()
    assert same("DE89 3704 0044 0532 0130 00", "DE89370400440532013000", f=lambda x: x.replace(" ", ""))
    assert pii.pseudonymized("+49 151 2345678", key)[0].startswith("+49 ") and pii.pseudonymized("+1 212 555 0123", key)[0].startswith("+1 ")


def test_pseudonyms_before_other_numbers():
    """Cards and IBANs that other digits or capitals follow or precede are found whole."""
    card, new = "4111 1111 1111 1111", pii.pseudonymized("4111 1111 1111 1111", b"k")[0]
    for around in ("{} 12/26", "{} 123", "{} 12345 x", "pay 99 {} 100.50", "{0} {0}", "20240101 {}"):
        assert pii.pseudonymized(around.format(card), b"k")[0] == around.format(new), around
    for iban in ("ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "AT611904300234573201", "DE89 3704 0044 0532 0130 00"):
        new = pii.pseudonymized(iban, b"k")[0]
        assert new != iban
        for around in ("{} EUR", "{} BIC", "{} 250 EUR", "REF AB12 ABCD EFGH {}", "{}, 1"):
            assert pii.pseudonymized(around.format(iban), b"k")[0] == around.format(new), (around, iban)


def test_language(spark, edge):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in langid.language_of(docs).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["lang"]]
    assert len(got) == docs.count() and np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.95
    few = langid.language_of(edge).collect()
    assert len(few) == edge.count() and {r["lang_pred"] for r in few if r["doc_id"] in (3, 4, 5, 7)} == {"und"}
    assert langid.keep_known(edge).columns == edge.columns and langid.language_of(edge.limit(0)).count() == 0


def test_paragraphs(spark, edge):
    passage = " ".join(f"p{i * 31 % 997}" for i in range(60))
    filler = lambda s, n=80: " ".join(f"{s}{i * i % 1009}" for i in range(n))
    words = passage.split()
    rows = [(1, f"{filler('a')} {passage} {filler('b')}"), (2, f"{filler('c', 33)}\n{passage}"), (3, filler("d")), (4, " ".join([*words[:30], "changed", *words[31:]])), (5, None), (6, ""), (6, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = paradedup.repeated_paragraphs(table).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 4} and {r["class_id"] for r in got} == {1, 2}  # the line of 4 is like that of 2
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    left = {r["doc_id"]: r for r in paradedup.remove_repeats(table.dropDuplicates(), paradedup.repeated_paragraphs(table)).collect()}
    assert left[1]["n_cut"] == 0 and left[2]["n_cut"] >= 20 and left[3]["text"] == rows[2][1]
    # Texts of a few words, repeats inside one document, repeated rows and clashing names.
    few = [(1, "one two three"), (2, "one  two THREE!"), (3, "one two"), (4, filler("w", 19)), (5, filler("w", 19)), (6, f"{passage}\n{filler('v')}\n{passage}"), (6, f"{passage}\n{filler('v')}\n{passage}"), (7, filler("u")), (None, filler("w", 19))]
    other = spark.createDataFrame([(*r, 5, "x") for r in few], "doc_id long, text string, n_cut int, start string")
    got = {(r["doc_id"], r["start"], r["size"], r["class_id"], r["kept"]) for r in paradedup.repeated_paragraphs(other).collect()}
    assert got == {(1, 0, 3, 1, True), (2, 0, 3, 1, False), (4, 0, 19, 4, True), (5, 0, 19, 4, False)}
    again = paradedup.repeated_paragraphs(other, inside=True)
    assert {(6, 0, 60, 6, True), (6, 140, 60, 6, False)} <= {tuple(r) for r in again.collect()}
    done = paradedup.remove_repeats(other, again).collect()
    assert len(done) == len(few) and {(r["doc_id"], r["n_cut"], r["start"]) for r in done} == {(1, 0, "x"), (2, 3, "x"), (3, 0, "x"), (4, 0, "x"), (5, 19, "x"), (6, 60, "x"), (7, 0, "x"), (None, 0, "x")}
    assert paradedup.remove_repeats(other.limit(0), again).count() == 0
    # Distinct paragraphs of one bucket, of which only some are alike: links don't depend on the least one.
    t = {1: words[:20], 2: filler("z", 20).split(), 3: [*filler("z", 19).split(), "other"], 4: words[1:21]}
    tiles = paradedup._tiles(spark.createDataFrame([(9, i) for i in t], "key long, rep long"), tile=2)
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in t.items()], "rep long, t string")
    links = {tuple(sorted(r)) for r in paradedup._similar(tiles.join(texts, "rep"), 0.8).collect()}
    assert links == {(1, 4), (2, 3)}
    assert paradedup.repeated_paragraphs(edge).where("doc_id = 1").count() > 0 and paradedup.repeated_paragraphs(edge.limit(0)).count() == 0


CLASHING = "key key2 row gone fp component ids bytes media pcm codec samples features weight toxic held_out lang_pred score predicted findings n_cut h at counts".split()


def test_clashing_columns_and_empty_tables(spark, edge):
    """Extra columns named like the operators' own change no result and no row count; empty tables give no rows."""
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (None, 1)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "word7 word8")], "item_id long, text string")
    full = edge.select(*edge.columns, *(F.lit("x").alias(c) for c in CLASHING if c not in edge.columns))
    operators = {
        "telephony": audio.telephony_digests, "leaks": lambda d: contamination.contaminated(d, items), "clean": lambda d: contamination.decontaminate(d, items), "toxicity": lambda d: toxicity.toxicity(d, labels), "lines": linededup.line_dedup,
        "boilerplate": linededup.strip_boilerplate, "bpe": bpe.bpe_digests, "simhash": simhash.simhash_components, "one": simhash.keep_one, "language": langid.language_of, "known": langid.keep_known, "pii": lambda d: pii.pseudonymize(d, b"k"),
        "repeats": paradedup.repeated_paragraphs,
    }
    for name, f in operators.items():
        plain, clashing = f(edge), f(full)
        own = [c for c in plain.columns if c in clashing.columns and (c not in edge.columns or c in ("doc_id", "text"))]
        got = [sorted(map(str, df.select(*own).collect())) for df in (plain, clashing)]
        assert got[0] == got[1], name
        assert f(full.limit(0)).count() == 0, name


def test_pipeline_gives_ids(spark, docs):
    one = corpus_pipeline.tokens(spark, docs.limit(3), SMALL).first()
    assert len(one["ids"]) == one["n_tokens"] and hashlib.sha256(np.array(one["ids"], "<u4").tobytes()).hexdigest() == one["ids_sha256"]


def test_paragraph_recall(spark):
    """Lines with changed words: at least 0.9 of the pairs that all-pairs Jaccard finds at 0.8 are linked, and none below."""
    rng = np.random.default_rng(8)
    rows = []
    for n in range(60):
        base = [f"t{x}" for x in rng.integers(0, 5000, int(rng.integers(50, 160)))]
        for k in range(4):
            ws = list(base)
            for i in rng.integers(0, len(ws), int(rng.integers(0, 4))):
                ws[i] = f"edit{rng.integers(0, 1 << 30)}"
            rows.append((4 * n + k, "head\n" + " ".join(ws) + "\ntail of it"))
    sets = {i: {" ".join(ws[j : j + 5]) for j in range(len(ws) - 4)} for i, t in rows for ws in [t.split("\n")[1].split()]}
    pairs = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    line = {i: t.split("\n")[1].count(" ") + 1 for i, t in rows}
    got = {(r["doc_id"], r["class_id"]) for r in paradedup.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect() if (r["start"], r["size"]) == (1, line[r["doc_id"]])}
    top = dict(got)
    assert len(pairs) > 100 and np.mean([top.get(a, a) == top.get(b, -b) for a, b in pairs]) >= 0.9
    want = groups(pairs, sets)
    assert all(want[d] == want[c] for d, c in got)


def test_pipeline(spark, docs):
    """Each stage against a plain version of it on the stage's own input."""
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    known = corpus_pipeline.language(spark, docs, SMALL).collect()
    assert len(known) > 0.9 * docs.count()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in known]
    cut = dict(brute_lines(rows))
    table = spark.createDataFrame(known, docs.schema)
    lines = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, table, SMALL).collect()}
    assert lines == cut
    fp = {i: brute_fingerprint(t) for i, t in cut.items()}
    top = groups([(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2], fp)
    leaks = {d for d, _ in brute_contained([(i, cut[i]) for i in fp if top[i] == i], items)}
    want = {i for i in fp if top[i] == i and i not in leaks}
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == {i: hashlib.sha256((cut[i] or "").encode()).hexdigest() for i in want}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "decontaminate", "tokens"]
    assert all(f(spark, docs.limit(0), SMALL).columns == docs.columns for _, f in corpus_pipeline.STAGES[:-1])
    assert docs.select(F.count("*")).first()[0] == docs.count()


def test_windows_find_every_long_passage(spark):
    """A passage of 51 words or more that two long lines share is found, wherever it stands; lines without one are left alone."""
    rng = np.random.default_rng(11)
    docs, planted = [], []
    for k in range(60):
        own = [f"w{v}" for v in rng.integers(0, 4000, 400)]
        other = [f"w{v}" for v in rng.integers(0, 4000, 400)]
        passage = [f"p{v}" for v in rng.integers(0, 4000, 51 + k)]
        a, b = rng.integers(0, 400, 2)
        docs += [(2 * k, " ".join([*own[:a], *passage, *own[a:]])), (2 * k + 1, " ".join([*other[:b], *passage, *other[b:]]))]
        planted.append((2 * k, a, b, len(passage)))
    docs += [(1000 + k, " ".join(f"u{v}" for v in rng.integers(0, 4000, 300))) for k in range(40)]
    rows = paradedup.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    places = collections.defaultdict(list)
    for r in rows:
        places[r["doc_id"]].append((r["start"], r["size"], r["class_id"], r["kept"]))
    assert set(places) == set(range(120))
    for first, a, b, n in planted:
        for doc, at, kept in ((first, a, True), (first + 1, b, False)):
            assert all(c == first and k is kept and at - 1 <= s and s + size <= at + n + 1 for s, size, c, k in places[doc])


def test_paragraphs_against_all_pairs_of_a_bucket(spark):
    """Classes of edited windows are those of exact similarity over all pairs that share a bucket."""
    rng = np.random.default_rng(12)
    base = [[f"w{v}" for v in rng.integers(0, 500, 20)] for _ in range(30)]
    texts = [[*b[: 20 - cut], *(f"x{v}" for v in rng.integers(0, 500, cut))] for b in base for cut in rng.integers(0, 5, 12)]
    groups_ = spark.createDataFrame([(k // 40, 0, 0, 0, k, " ".join(t)) for k, t in enumerate(texts)], "key long, p int, q int, side int, rep long, t string")
    sets = [{" ".join(t[i : i + 5]) for i in range(16)} for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if i // 40 == j // 40 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    found = [(r["a"], r["b"]) for r in paradedup._similar(groups_, 0.8).collect()]
    assert groups(found, range(len(texts))) == groups(pairs, range(len(texts))) and len(found) < len(texts)


def test_run_keys_miss_no_similar_paragraph():
    # Windows without a repeat of three words against all sorts of similar paragraphs: shifted, turned, with stretches repeated or inserted.
    rng = random.Random(5)
    sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    repeats = lambda w: len({tuple(w[i : i + 3]) for i in range(len(w) - 2)}) < len(w) - 2
    seen = turned = 0
    for _ in range(60_000):
        v = rng.choice([5, 6, 8, 12, 30])
        a = [rng.randrange(v) for _ in range(20)]
        if repeats(a):
            continue
        c, q, x = rng.randrange(1, 20), rng.randrange(5), rng.randrange(2)
        cut = rng.randrange(-4, 5)
        shifted = [rng.randrange(v) for _ in range(rng.randrange(4))] + a[max(0, cut) : 20 + min(0, cut)] + [rng.randrange(v) for _ in range(rng.randrange(4))]
        b = rng.choice([a[c + x :] + a[: c + q], a[: c + q] + a[c:], shifted, a[:c] + a[c - min(c, q) : c] * 2 + a[c:]])
        if a == b or len(b) < 5 or 10 * len(sets(a) & sets(b)) < 8 * len(sets(a) | sets(b)):
            continue
        seen += 1
        assert paradedup.FEWEST <= len(sets(b)) <= paradedup.MOST
        if tuple(a[3:17]) not in {tuple(b[i : i + 14]) for i in range(len(b) - 13)}:
            turned += 1
            assert repeats(b) and len(sets(b)) > paradedup.FEWEST + 2 and tuple(a[3:17]) in paradedup.spliced(b)
        assert len(b) != 20 or {tuple(a[:19]), tuple(a[1:])} & {tuple(b[:19]), tuple(b[1:])}
    assert seen > 5000 and turned > 1000


def test_similar_windows_meet(spark):
    # Windows that differ in an end word, and lines that hold a window's middle or turn it: every pair meets in a bucket.
    rng = random.Random(6)
    rows, pairs = [], []
    for k in range(60):
        text = [f"w{k}x{rng.randrange(10**6)}" for _ in range(80)]
        rows.append((2 * k, " ".join(text)))
        rows.append((2 * k + 1, ""))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    windows = [r for r in paradedup.paragraphs(table).where("core is not null").collect() if r["doc_id"] % 2 == 0]
    at = {r["doc_id"]: r for r in windows}
    words_of = dict(rows)
    lines = []
    for d, r in at.items():
        ws = words_of[d].split()[r["start"] : r["start"] + 20]
        lines.append((d + 1, " ".join([ws[2:] + ws[:6], ws[1:18], ["new", *ws, "other"]][d // 2 % 3])))
        pairs.append((r, d + 1))
    keys = {r["doc_id"]: set(r["cores"]) for r in paradedup.paragraphs(spark.createDataFrame(lines, "doc_id long, text string")).where("core is null").collect()}
    assert len(pairs) == 60 and all(r["core"] in keys[d] for r, d in pairs)
    got = {r["doc_id"]: r["class_id"] for r in paradedup.repeated_paragraphs(spark.createDataFrame([x for x in rows if x[1]] + lines, "doc_id long, text string")).where("start = 0").collect()}
    assert all(got.get(d) == d - 1 for d, _ in lines)
    # The runs of one window shifted by a word, and of one with another word at its end.
    base = [f"a{i}" for i in range(20)]
    texts = [base, [*base[1:], "z"], [*base[:-1], "y"]]
    runs = [set(r["keys"]) for r in paradedup.paragraphs(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()]
    assert all(runs[i] & runs[j] for i in range(3) for j in range(i))
