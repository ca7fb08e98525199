"""One query per operator over the whole tables of a folder, and DuckDB SQL where it can express them."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, bpe, contamination, filteraudit, langid, linededup, mixing, paradedup, pii, simhash, toxicity, turnrepair, warc

#: The session setting that holds the key of the pseudonym query; without it every call makes a key of its own.
KEY = "spark.lexmill.pseudonym.key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.telephony_digests(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(_table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.conf.get(KEY, None) or secrets.token_hex(32)).encode()
    done = pii.pseudonymize(_table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    kinds = F.array_sort(F.array_distinct(F.transform("findings", lambda x: x.kind)))
    return done.select("doc_id", "text", F.size("findings").alias("n_found"), F.array_join(kinds, ",").alias("kinds"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_of(_table(spark, sf_dir, "documents"))


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paradedup.repeated_paragraphs(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turnrepair.damage_audit(_table(spark, sf_dir, "conversations"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_telephony, op2_decontamination, op3_toxicity, op4_line_dedup, op5_byte_bpe, op6_warc, op7_simhash, op8_pseudonyms, op9_language, op10_paragraph_dedup,
        op11_filter_audit, op12_turn_repair, op13_source_mix,
    )
}

SQL: dict[str, str] = {
    "op2_decontamination": """
        WITH words AS (
            SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '[a-z0-9_\\x{80}-\\x{10FFFF}]+') AS w FROM documents WHERE text IS NOT NULL
            UNION ALL
            SELECT 'i', item_id, regexp_extract_all(lower(text), '[a-z0-9_\\x{80}-\\x{10FFFF}]+') FROM benchmark WHERE text IS NOT NULL
        ), lengths AS (
            SELECT DISTINCT least(5, len(w)) AS k FROM words WHERE side = 'i' AND len(w) > 0
        ), shingles AS (
            SELECT DISTINCT side, id, k, array_to_string(list_slice(w, j, j + k - 1), ' ') AS s
            FROM (SELECT side, id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM words JOIN lengths ON CASE side WHEN 'i' THEN k = least(5, len(w)) ELSE k <= len(w) END)
        ), items AS (
            SELECT id AS item_id, k, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE side = 'i'
        )
        SELECT d.id AS doc_id, item_id, count(*)::INT AS shared, any_value(n)::INT AS item_shingles, count(*) / any_value(n) AS containment
        FROM items JOIN shingles d ON d.side = 'd' AND d.k = items.k AND d.s = items.s
        GROUP BY d.id, item_id HAVING count(*) >= 0.8 * any_value(n)
    """,
    "op4_line_dedup": """
        WITH lines AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
        ), keyed AS (
            SELECT *, trim(line, chr(32) || chr(9) || chr(13)) AS k FROM lines
        ), spread AS (
            SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT coalesce(source, '')) >= 10
        ), counted AS (
            SELECT doc_id, count(*) AS n_lines, count(spread.k) AS n_removed, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE spread.k IS NULL) AS kept
            FROM keyed LEFT JOIN spread ON keyed.k = spread.k GROUP BY doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
        FROM documents d LEFT JOIN counted USING (doc_id)
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
        )
        SELECT page_id, octet_length(encode(html)) AS payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM p
    """,
    "op11_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), said AS (
            SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
        ), failing AS (
            SELECT part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::INT
                + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS bits, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
            FROM d LEFT JOIN said ON d.doc_id = said.doc_id
        ), counted AS (
            SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, bits
        ), f AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit
        ), orders AS (
            SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM f a, f b, f c, f d, f e WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
        ), steps AS (
            SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[:step - 1]), 0)::INT AS earlier FROM orders, range(1, 6) r(step)
        ), rows AS (
            SELECT part, filter_order, step::INT AS step, bit, coalesce(sum(n) FILTER (WHERE (bits & (earlier | bit)) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE (bits & bit) > 0 AND (bits & earlier) = 0), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (WHERE (bits & bit) > 0 AND (bits & earlier) > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE bits = bit), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (WHERE (bits & bit) > 0 AND (bits & earlier) = 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE (bits & bit) > 0 AND (bits & earlier) = 0), 0)::BIGINT AS toxic_lost
            FROM counted, steps GROUP BY ALL
        )
        SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM rows
    """,
    "op12_turn_repair": r"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
        ), told AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
        ), dealt AS (
            SELECT told.* EXCLUDE (k), xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: ord(k[i])::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS d FROM told, crc
        ), damaged AS (
            SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE d WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM dealt WHERE d <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k FROM damaged
        ), flagged AS (
            SELECT conv_id, turn, role, text, k, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
                NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY k) || role[1:1] AS pair
            FROM placed
        ), told_faults AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT blank AND again) AS duplicate,
                count(*) FILTER (WHERE NOT blank AND NOT again AND open) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
            FROM flagged GROUP BY conv_id
        ), moves(p, q, before) AS (
            VALUES ('', 's', ''), ('', 'u', ''), ('s', 'u', ''), ('a', 'u', ''), ('u', 'u', 'a'), ('u', 'a', ''), ('', 'a', 'u'), ('s', 'a', 'u'), ('a', 'a', 'u')
        ), walk AS (
            SELECT conv_id, 0::BIGINT AS k, '' AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS done FROM told_faults
            UNION ALL
            SELECT conv_id, k, q, cost, audit, done FROM (
                SELECT w.conv_id, f.k, w.q, w.cost + 2 AS cost, w.audit || 'D' AS audit, w.done FROM walk w JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1
                UNION ALL
                SELECT w.conv_id, f.k, m.q, w.cost + 5 * length(before) + (f.role[1:1] <> m.q)::INT + 5 * f.open::INT, w.audit || CASE before WHEN '' THEN '' ELSE 'I' END || CASE WHEN f.role[1:1] = m.q THEN 'K' ELSE 'R' END,
                    w.done || CASE before WHEN 'u' THEN ['user:'] WHEN 'a' THEN ['assistant:'] ELSE [] END || [CASE WHEN f.role[1:1] = m.q THEN f.role WHEN m.q = 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text]
                FROM walk w JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1 JOIN moves m ON m.p = w.q
                WHERE NOT f.blank AND NOT f.again AND (m.q <> 's' OR f.role[1:1] = 's')
            ) QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1
        ), endings AS (
            SELECT w.conv_id, cost + CASE q WHEN 's' THEN 10 WHEN 'u' THEN 5 ELSE 0 END AS cost, audit || CASE q WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS audit,
                done || CASE q WHEN 's' THEN ['user:', 'assistant:'] WHEN 'u' THEN ['assistant:'] ELSE [] END AS done
            FROM walk w JOIN told_faults t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.k
        ), ended AS (
            SELECT * FROM endings QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
        )
        SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(done, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told_faults t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
    "op13_source_mix": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source
        ), fill AS (
            SELECT 0 AS round, sum(source_size)::DOUBLE / sum(weight) AS level FROM s
            UNION ALL
            SELECT round + 1, (sum(source_size) - sum(CASE WHEN weight * level > 3 * source_size THEN 3 * source_size ELSE 0 END))::DOUBLE / sum(CASE WHEN weight * level > 3 * source_size THEN 0 ELSE weight END)
            FROM fill, s WHERE round <= (SELECT count(*) FROM s) GROUP BY round, level
        ), planned AS (
            SELECT source, source_size, least(weight * level, 3.0::DOUBLE * source_size) AS target FROM s, (SELECT level FROM fill ORDER BY round DESC LIMIT 1)
        ), parted AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM planned
        ), running AS (
            SELECT d.*, source_size, target, copies, target - copies * source_size AS rest, sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source
        )
        SELECT doc_id, source, size, source_size, target, size * (copies + CASE WHEN upto <= rest THEN 1 WHEN upto - size <= rest AND floor((rest - upto + size) / size + 0.5) >= 1 THEN 1 ELSE 0 END) AS taken FROM running
    """,
}
