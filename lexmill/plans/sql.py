"""DuckDB SQL for the queries that it can express, written from the tables and not from the operators' steps."""

from __future__ import annotations

from . import cases

_HREFS = """hrefs AS (
    SELECT event_id AS ord, event_id, user_id, user_id % 3 AS own, 'K15000' || lpad((user_id % 7)::VARCHAR, 5, '0') AS doc, (event_id % 9 + 1)::VARCHAR AS num, event_id % 6 AS k,
        CASE event_id % 6 WHEN 0 THEN 'https://example.org/docs/K15000' || lpad((user_id % 7)::VARCHAR, 5, '0') || '#z' || (event_id % 9 + 1)
            WHEN 1 THEN CASE event_id % 12 WHEN 1 THEN 'https://example.org' ELSE '' END || '/rus/docs/K15000' || lpad((user_id % 7)::VARCHAR, 5, '0') || '#' || (event_id % 9 + 1)
            WHEN 2 THEN 'http://example.com/docs/K15000' || lpad((user_id % 7)::VARCHAR, 5, '0')
            WHEN 3 THEN '#z' || (event_id % 9 + 1)
            WHEN 4 THEN 'https://example.org/docs/K15000' || lpad((user_id % 7)::VARCHAR, 5, '0') || '/history'
            ELSE '/search/' || (event_id % 9 + 1) END AS href
    FROM events
)"""
_LINKS = """links AS (
    SELECT page_id::VARCHAR AS doc_key, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>', 1)) AS href,
        unnest(regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>([^<]*)</a>', 1)) AS said, generate_subscripts(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>', 1), 1) AS ord
    FROM pages
)"""
_UNESCAPE = "replace(replace(replace(replace(replace({0}, '&quot;', chr(34)), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_RANKED = "ranked AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders)"
_LINES = r"lines AS (SELECT doc_id::VARCHAR AS doc_key, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)"
_PAGE_LINKS = f"WITH {_LINKS} SELECT doc_key, ord, {_UNESCAPE.format('href')} AS href, trim({_UNESCAPE.format('said')}) AS text FROM links"
_ROMAN = "(['', 'X', 'XX', 'XXX', 'XL', 'L'])[p_size // 10 + 1] || (['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'])[p_size % 10 + 1]"
_QUANTITY = "l_quantity::INT"
_REFS = f"refs AS (SELECT l_suppkey::VARCHAR AS doc_key, {_QUANTITY} AS a, (l_partkey % 50 + 1)::INT AS b, l_linenumber AS n FROM lineitem)"

SQL: dict[str, str] = {
    "link_inventory": f"WITH {_LINKS} SELECT doc_key, 'nav' AS kind, count(*) AS n FROM links GROUP BY doc_key",
    "page_links": _PAGE_LINKS,
    "serialized_pages": _PAGE_LINKS,
    "raw_hrefs": f"WITH {_LINKS} SELECT doc_key, ord - 1 AS ord, href FROM links",
    "tag_counts": "SELECT page_id::VARCHAR AS doc_key, tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[ >]', 1)) AS tag FROM pages) GROUP BY ALL",
    "content_root": f"""
        SELECT page_id::VARCHAR AS doc_key, length(t) AS n_chars, md5(t) AS digest
        FROM (SELECT page_id, {_UNESCAPE.format("regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<[^>]*>', '', 'g')")} AS t FROM pages)
    """,
    "head_injection": """
        SELECT page_id, length(html) + 34 AS n_chars, CASE WHEN instr(html, '<head>') > 0 THEN instr(html, '<head>') + 6 WHEN instr(html, '<body>') > 0 THEN instr(html, '<body>') + 6 ELSE 1 END AS at FROM pages
    """,
    "duplicate_ids": f"WITH {_LINKS} SELECT doc_key, {_UNESCAPE.format('href')} AS id, count(*) AS n FROM links GROUP BY ALL HAVING count(*) > 1",
    "roman_numbers": f"SELECT p_partkey, {_ROMAN} AS numeral, CASE WHEN p_size <= 25 OR p_size = 30 THEN p_size ELSE 0 END AS value FROM part",
    "ordinal_words": "SELECT p_partkey, CASE WHEN p_size <= 20 THEN p_size END AS value FROM part",
    "line_hierarchy": f"""
        WITH {_LINES}, leveled AS (
            SELECT doc_key, pos, CASE WHEN length(text) <= 40 THEN 2 WHEN length(text) <= 120 THEN 4 WHEN length(text) <= 400 THEN 7 END AS level FROM lines
        )
        SELECT a.doc_key, a.pos, any_value(a.level) AS level, max(b.pos) AS parent_pos
        FROM leveled a LEFT JOIN leveled b ON a.doc_key = b.doc_key AND b.pos < a.pos AND b.level < coalesce(a.level, 99)
        GROUP BY a.doc_key, a.pos
    """,
    "act_structure": f"WITH {_RANKED} SELECT 'article' AS node_type, count(*) AS n FROM ranked UNION ALL SELECT 'chapter', count(*) FROM ranked WHERE n % 5 = 1",
    "act_hierarchy": f"WITH {_RANKED} SELECT o_custkey::VARCHAR AS doc_key, n::VARCHAR AS number, 'Заказ' AS title, 'w_z' || o_orderkey AS wrapper, ((n + 4) // 5)::VARCHAR AS chapter FROM ranked",
    "article_map": f"WITH {_RANKED} SELECT o_custkey::VARCHAR AS doc_key, n::VARCHAR AS article, 'z' || o_orderkey AS anchor, 2 AS method FROM ranked",
    "subpoint_map": f"""
        WITH {_RANKED} SELECT DISTINCT o_custkey::VARCHAR AS doc_key, n || '_' || l_linenumber AS key, 'z' || n || '_p' || l_linenumber AS anchor FROM ranked JOIN lineitem ON l_orderkey = o_orderkey
    """,
    "chapter_map": f"WITH {_RANKED} SELECT o_custkey::VARCHAR AS doc_key, ((n + 4) // 5)::VARCHAR AS chapter, 'c' || ((n + 4) // 5) AS anchor FROM ranked WHERE n % 5 = 1",
    "article_map_json": """
        SELECT n_regionkey::VARCHAR AS code, '{' || string_agg('"' || n_nationkey || '":"' || n_name || '"', ',' ORDER BY n_nationkey::VARCHAR) || '}' AS json FROM nation GROUP BY n_regionkey
    """,
    "act_events": f"""
        WITH {_RANKED} SELECT 'H' AS kind, count(*) AS n, count(DISTINCT n) AS vals FROM ranked
        UNION ALL SELECT 'B', count(*), 0 FROM lineitem
        UNION ALL SELECT 'A', count(*), count(DISTINCT v) FROM (SELECT 'z' || o_orderkey AS v FROM ranked UNION ALL SELECT 'c' || ((n + 4) // 5) FROM ranked WHERE n % 5 = 1)
    """,
    "first_wins": "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
    "reverse_map": """
        SELECT l_suppkey AS code, l_partkey::VARCHAR AS anchor, l_orderkey::VARCHAR AS article FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY (l_linenumber > 1)::INT, l_orderkey::VARCHAR) = 1
    """,
    "anchor_resolution": """
        WITH e AS (
            SELECT user_id::VARCHAR AS doc_key, event_id AS pos, CASE event_type WHEN 'purchase' THEN 'H' WHEN 'view' THEN 'B' ELSE 'A' END AS kind FROM events
        ), w AS (
            SELECT *, min(CASE WHEN kind = 'H' THEN pos END) OVER (PARTITION BY doc_key ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nh,
                min(CASE WHEN kind = 'B' THEN pos END) OVER (PARTITION BY doc_key ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nb,
                max(CASE WHEN kind = 'H' THEN pos END) OVER (PARTITION BY doc_key ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lh
            FROM e
        )
        SELECT doc_key, pos, pos::VARCHAR AS id, CASE WHEN nh IS NOT NULL AND (nb IS NULL OR nb > nh) THEN nh ELSE coalesce(lh, nh) END::VARCHAR AS article, nh::VARCHAR AS next_article FROM w WHERE kind = 'A'
    """,
    "found_references": f"""
        WITH {_REFS}, found AS (
            SELECT doc_key, 'point_article' AS rule, a AS article, 'z' || a AS anchor FROM refs WHERE n = 1 AND a <= 40
            UNION ALL SELECT doc_key, 'articles', a, 'z' || a FROM refs WHERE n = 2 AND a <= 40
            UNION ALL SELECT doc_key, 'articles', b, 'z' || b FROM refs WHERE n = 2 AND b <= 40
            UNION ALL SELECT doc_key, 'article', a, 'z' || a FROM refs WHERE n = 3 AND a <= 40
            UNION ALL SELECT doc_key, 'subpoint', a, CASE WHEN a % 2 = 0 THEN 'z' || a || '_2_4' ELSE 'z' || a END FROM refs WHERE n = 4 AND a <= 40
            UNION ALL SELECT doc_key, 'subpoint', a, 'z' || a FROM refs CROSS JOIN range(2) WHERE n = 4 AND a <= 40
            UNION ALL SELECT doc_key, 'chapter', NULL, 'c5' FROM refs WHERE n = 5
            UNION ALL SELECT doc_key, 'points_article', a, 'z' || a FROM refs WHERE n = 7 AND a <= 40
        )
        SELECT doc_key, rule, article::VARCHAR AS article, anchor, count(*) AS n FROM found GROUP BY ALL
    """,
    "top_references": "SELECT l_partkey AS article, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, article LIMIT 10",
    "merged_chains": f"""
        WITH {_REFS}
        SELECT doc_key, CASE n WHEN 1 THEN 'пунктами 1 и 2 статьи ' || a ELSE 'частями первой, второй статьи ' || a END AS text, '#p1_' || a AS keep,
            CASE n WHEN 1 THEN 'link' ELSE 'plain' END AS terminal, count(*) AS n, max(CASE n WHEN 1 THEN 2 ELSE 1 END)::INT AS dropped
        FROM refs WHERE n IN (1, 4) GROUP BY doc_key, refs.n, a
    """,
    "full_spans": f"WITH {_REFS} SELECT doc_key, 'merge' AS kind, count(*) AS n FROM refs WHERE n = 2 GROUP BY doc_key",
    "chain_gates": "SELECT gate, true AS ok, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS n FROM (VALUES ('text'), ('nested'), ('hrefs'), ('dangling')) g(gate)",
    "link_verdicts": """
        WITH r AS (SELECT l_suppkey::VARCHAR AS doc_key, l_linenumber AS n, l_orderkey % 6 AS k FROM lineitem), have AS (SELECT DISTINCT doc_key, n FROM r)
        SELECT r.doc_key, CASE k WHEN 3 THEN 'SELF' WHEN 4 THEN 'NONART' ELSE 'ARTICLE' END AS kind,
            CASE WHEN k = 2 OR (k IN (1, 4) AND have.n IS NULL) THEN 'BROKEN' WHEN k = 0 THEN 'OK' WHEN k = 1 THEN 'WRONG_TARGET' WHEN k = 3 THEN 'SELF_OK' ELSE 'NONART' END AS verdict, count(*) AS n
        FROM r LEFT JOIN have ON have.doc_key = r.doc_key AND have.n = r.n % 7 + 1 WHERE k <> 5 GROUP BY ALL
    """,
    "canonical_hrefs": f"""
        WITH {_HREFS}, known AS (
            SELECT DISTINCT (user_id % 3)::VARCHAR AS doc_key, CASE WHEN (event_id % 9 + 1) % 3 <> 0 THEN 'z' || (event_id % 9 + 1) ELSE (event_id % 9 + 1)::VARCHAR END AS id FROM events WHERE event_id % 9 <> 8
        )
        SELECT ord, CASE WHEN k IN (3, 5) THEN href
                WHEN user_id % 7 <> own THEN 'https://example.org/docs/' || doc || CASE k WHEN 0 THEN '#z' || num ELSE '' END
                WHEN k = 0 THEN '#z' || num WHEN k = 2 THEN '#'
                WHEN ord % 12 = 1 AND (own::VARCHAR, 'z' || num) IN (SELECT (doc_key, id) FROM known) THEN '#z' || num
                WHEN ord % 12 = 1 AND (own::VARCHAR, num) IN (SELECT (doc_key, id) FROM known) THEN '#' || num
                ELSE href END AS href,
            CASE WHEN k = 5 THEN 'nav' WHEN k = 3 OR (k IN (0, 1) AND user_id % 7 = own) THEN 'internal' ELSE 'external' END AS kind
        FROM hrefs
    """,
    "stale_links": f"""
        WITH {_HREFS} SELECT doc AS doc_id, status, candidate, CASE WHEN k IN (0, 1) THEN 'art' ELSE 'root' END AS kind, count(*) AS n
        FROM hrefs JOIN (VALUES ('K1500000001', 'confirmed', 'K2500000001'), ('K1500000004', 'review', NULL)) s(doc_id, status, candidate) ON doc = doc_id WHERE k NOT IN (3, 5) GROUP BY ALL
    """,
    "external_inventory": f"WITH {_HREFS} SELECT doc AS doc_id, count(*) AS n FROM hrefs WHERE k NOT IN (3, 5) AND doc NOT IN ('K1500000000', 'K1500000002') GROUP BY 1",
    "remapped_links": f"""
        WITH {_HREFS} SELECT ord, CASE WHEN k NOT IN (3, 5) AND user_id % 7 IN (1, 3) THEN 'https://example.org/docs/K25000' || lpad((user_id % 7)::VARCHAR, 5, '0') ELSE href END AS href,
            CASE WHEN k NOT IN (3, 5) AND user_id % 7 IN (1, 3) THEN doc END AS was FROM hrefs
    """,
    "relinked_acts": f"""
        WITH {_HREFS}, last AS (SELECT 'C' || (max(n_nationkey) + 1000001) AS id FROM nation), moved AS (
            SELECT ord, href, doc, event_id % 4 + 1 AS said, CASE WHEN k IN (3, 5) THEN NULL WHEN user_id % 7 = 1 THEN (SELECT id FROM last) WHEN user_id % 7 = 3 THEN 'K2500000003' END AS new_id FROM hrefs
        )
        SELECT ord, CASE WHEN new_id IS NULL THEN href ELSE 'https://example.org/docs/' || new_id || CASE WHEN new_id LIKE 'C%' AND said < 4 THEN '#z' || said WHEN new_id LIKE 'K%' AND said = 2 THEN '#z22' ELSE '' END END AS href,
            CASE WHEN new_id IS NOT NULL THEN doc END AS was
        FROM moved
    """,
    "cross_verification": f"""
        WITH {_HREFS}, linked AS (
            SELECT own::VARCHAR AS doc_key, (user_id % 7)::VARCHAR AS target, CASE k WHEN 0 THEN 'z' || num ELSE num END AS anchor, (event_id % 4 + 1)::VARCHAR AS meant FROM hrefs
            WHERE k IN (0, 1) AND user_id % 7 < 5 AND user_id % 7 <> own
        ), resolved AS (
            SELECT *, CASE WHEN anchor IN ('z1', 'z2', 'z3', 'z4', 'z5', 'z6') THEN anchor[2:] WHEN anchor = 'z7' THEN '2' END AS article FROM linked
        )
        SELECT doc_key, target, CASE WHEN target = '4' THEN 'NO_MAP' WHEN article IS NULL THEN 'UNRESOLVED' WHEN article = meant THEN 'OK' ELSE 'MISMATCH' END AS verdict, count(*) AS n FROM resolved GROUP BY ALL
    """,
    "dangling_links": """
        SELECT o_orderpriority AS doc_key, o_custkey::VARCHAR AS id, o_orderkey, '#' || o_custkey AS href FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderpriority = o.o_orderpriority AND t.o_custkey = o.o_custkey AND t.o_orderstatus = 'F')
    """,
    "renamed_duplicates": """
        WITH d AS (SELECT coalesce(lang, '-') AS doc_key, doc_id AS node_id, n_chars::VARCHAR AS id, source FROM documents),
        used AS (SELECT DISTINCT doc_key, id FROM d WHERE source = 'src0'), numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_key, id ORDER BY node_id) AS k FROM d)
        SELECT n.doc_key, node_id, n.id, CASE WHEN k > 1 AND used.id IS NULL THEN n.id || '__d' || (k - 1) ELSE n.id END AS new_id
        FROM numbered n LEFT JOIN used ON n.doc_key = used.doc_key AND n.id = used.id
    """,
    "href_delta": f"""
        WITH {_LINKS}, a AS (SELECT doc_key, href, count(*) AS old_n FROM links GROUP BY ALL), b AS (SELECT doc_key, lower(href) AS href, count(*) AS new_n FROM links GROUP BY ALL)
        SELECT doc_key, href, coalesce(old_n, 0) AS old_n, coalesce(new_n, 0) AS new_n FROM a FULL JOIN b USING (doc_key, href) WHERE coalesce(old_n, 0) <> coalesce(new_n, 0)
    """,
    "text_hashes": "SELECT doc_id AS doc_key, sha256(coalesce(text, '')) AS sha FROM documents",
    "frozen_texts": "SELECT coalesce(text NOT LIKE '%  %', true) AS same, count(*) AS n FROM documents GROUP BY ALL",
    "pattern_delta": "SELECT page_id AS doc_key, len(regexp_extract_all(html, '<br>'))::INT AS old_n, 0 AS new_n FROM pages",
    "preceding_text": f"""
        WITH {_LINES} SELECT doc_key, pos, right(trim(regexp_replace(coalesce(string_agg(text, '') OVER (PARTITION BY doc_key ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), '\\s+', ' ', 'g')), 60) AS prev_text FROM lines
    """,
    "longest_hint": """
        SELECT doc_id AS id, hint, expected FROM documents JOIN (VALUES ('the', 'E1'), ('thethe', 'E2'), ('und', 'E3'), ('unden', 'E4'), ('que', 'E5'), ('queleaux', 'E6')) h(hint, expected) ON contains(lower(text), hint)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(hint) DESC, hint DESC) = 1
    """,
    "coverage_ratios": """
        WITH c AS (
            SELECT l_suppkey, count(*) FILTER (WHERE l_linenumber = 1) AS linked, count(*) FILTER (WHERE l_linenumber = 2) AS unlinked, count(*) FILTER (WHERE l_linenumber = 2 AND l_returnflag = 'A') AS generic FROM lineitem GROUP BY 1
        )
        SELECT l_suppkey, round(coalesce(linked / nullif(linked + unlinked, 0), 0.0), 6) AS cov_lit, round(coalesce(linked / nullif(linked + unlinked - generic, 0), 0.0), 6) AS cov_content,
            round(coalesce(linked / nullif(linked + unlinked - generic, 0), 0.0), 6) AS cov_real
        FROM c
    """,
    "line_units": f"""
        WITH {_LINES}, classed AS (
            SELECT *, CASE WHEN regexp_matches(text, '^[S-T]') THEN 'nested' WHEN regexp_matches(text, '^[A-F]') THEN 'punkt' WHEN regexp_matches(text, '^[G-R]') THEN 'sub' ELSE 'text' END AS class FROM lines
        ), opened AS (
            SELECT *, CASE WHEN class = 'punkt' OR (class = 'sub' AND coalesce(sum((class IN ('punkt', 'sub'))::INT) OVER (PARTITION BY doc_key ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0) THEN 1 ELSE 0 END AS opens FROM classed
        ), united AS (
            SELECT *, sum(opens) OVER (PARTITION BY doc_key ORDER BY pos) AS u FROM opened
        ), subbed AS (
            SELECT *, sum((class = 'sub')::INT) OVER (PARTITION BY doc_key, u ORDER BY pos) AS s FROM united
        ), childed AS (
            SELECT *, sum((class = 'sub' OR (class = 'nested' AND s = 0))::INT) OVER (PARTITION BY doc_key, u ORDER BY pos) AS k FROM subbed
        )
        SELECT doc_key, pos, class, u::BIGINT AS u, CASE WHEN s = 0 AND class <> 'nested' THEN 0 ELSE k END::BIGINT AS c, max(CASE WHEN class = 'punkt' THEN substr(text, 1, 1) END) OVER (PARTITION BY doc_key, u) AS unit FROM childed
    """,
    "line_chunks": f"""
        WITH {_LINES}, united AS (
            SELECT *, sum(regexp_matches(text, '^[A-F]')::INT) OVER (PARTITION BY doc_key ORDER BY pos) AS u FROM lines
        ), bodies AS (
            SELECT doc_key, u, string_agg(text, chr(10) ORDER BY pos) AS body, min_by(substr(text, 1, 1), pos) AS letter FROM united GROUP BY ALL
        ), docs AS (
            SELECT d.doc_id::VARCHAR AS doc_key, coalesce(source, '-') AS code, b.u, b.body, b.letter, l.body AS loose, '[' || coalesce(source, '-') || ' | Статья ' || d.doc_id || '. T' AS head, row_number() OVER (PARTITION BY d.doc_id ORDER BY b.u) AS ord
            FROM documents d LEFT JOIN bodies b ON b.doc_key = d.doc_id::VARCHAR AND b.u > 0 LEFT JOIN bodies l ON l.doc_key = d.doc_id::VARCHAR AND l.u = 0
        ), made AS (
            SELECT doc_key, ord, code || '_ст' || doc_key || CASE WHEN u IS NULL THEN '' ELSE '_п' || letter END AS id, row_number() OVER (PARTITION BY doc_key, letter ORDER BY ord) AS seq,
                CASE WHEN u IS NULL THEN head || ']' || chr(10) || coalesce(loose, '') ELSE CASE WHEN ord = 1 AND loose IS NOT NULL THEN '[intro]' || chr(10) || loose || chr(10) || chr(10) ELSE '' END || head || ' | пункт ' || letter || ']' || chr(10) || body END AS text
            FROM docs
        )
        SELECT doc_key, ord, id || CASE WHEN seq > 1 THEN '~' || seq ELSE '' END AS id, md5(text) AS digest, length(text) AS char_len FROM made
    """,
    "chunk_stats": """
        SELECT coalesce(lang, '-') AS code, count(DISTINCT source) AS articles, count(*) AS chunks, count(*) FILTER (WHERE doc_id % 10 = 0) AS repealed, count(*) FILTER (WHERE doc_id % 7 = 0) AS orphans,
            max(length(text)) AS longest, count(*) FILTER (WHERE length(text) > 4000) AS over_4000, count(*) FILTER (WHERE length(text) > 8000) AS over_8000, grouping(coalesce(lang, '-')) = 1 AS is_total
        FROM documents GROUP BY ROLLUP (coalesce(lang, '-'))
    """,
    "sample_examples": """
        SELECT event_id, event_type, turn::INT AS turn FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS turn FROM events) ORDER BY turn, event_type LIMIT 20
    """,
    "linked_pages": f"""
        WITH {_REFS} SELECT doc_key, sum(CASE n WHEN 2 THEN (a <= 40)::INT + (b <= 40)::INT WHEN 4 THEN 3 * (a <= 40)::INT WHEN 5 THEN 1 WHEN 6 THEN 0 ELSE (a <= 40)::INT END)::BIGINT AS n_links,
            sum(length(CASE n WHEN 1 THEN 'согласно пункту ' || n || ' статьи ' || a || ' закона' WHEN 2 THEN 'указано в статьях ' || a || ', ' || b || ' закона' WHEN 3 THEN 'нарушение статьи ' || a || ' закона'
                WHEN 4 THEN 'в подпункте ' || n || ') пункта 2 статьи ' || a || ' закона' WHEN 5 THEN 'как следует из главы ' || n || ' настоящего Кодекса' WHEN 6 THEN 'см. статья ' || a || '. Заголовок' ELSE 'ПУНКТАМИ 1, 2 СТАТЬИ ' || a || ' закона' END))::BIGINT AS n_chars
        FROM refs GROUP BY doc_key
    """,
    "act_chunks": f"""
        WITH {_RANKED}, points AS (
            SELECT o_custkey, n, l_linenumber AS k, l_linenumber || '. Товар ' || l_partkey AS body, row_number() OVER (PARTITION BY o_orderkey, l_linenumber ORDER BY l_partkey) AS seq FROM ranked JOIN lineitem ON l_orderkey = o_orderkey
        ), bare AS (
            SELECT o_custkey, n FROM ranked WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
        ), made AS (
            SELECT o_custkey, o_custkey || '_ст' || n || '_п' || k || CASE WHEN seq > 1 THEN '~' || seq ELSE '' END AS id, '[' || o_custkey || ' | Статья ' || n || '. Заказ | пункт ' || k || ']' || chr(10) || body AS text,
                o_custkey || 'G' || ((n + 4) // 5) || 'ST' || n || 'P' || k || CASE WHEN seq > 1 THEN '~' || seq ELSE '' END AS hier_id, 'пункт' AS unit_type FROM points
            UNION ALL SELECT o_custkey, o_custkey || '_ст' || n, '[' || o_custkey || ' | Статья ' || n || '. Заказ]' || chr(10), o_custkey || 'G' || ((n + 4) // 5) || 'ST' || n, NULL FROM bare
        )
        SELECT id, text, hier_id, (SELECT c_name FROM customer WHERE c_custkey = o_custkey) AS doc_id, unit_type, length(text) AS char_len FROM made
    """,
    "linked_acts": cases.sql(cases.LINKED, "ord INT, text VARCHAR, href VARCHAR"),
    "swept_acts": cases.sql(cases.SWEPT, "ord INT, text VARCHAR, href VARCHAR"),
    "act_sections": cases.sql(cases.SECTIONS, "pos INT, kind VARCHAR, type VARCHAR, number VARCHAR, anchor VARCHAR, parent_pos INT"),
    "structured_pages": cases.sql(cases.WRAPPERS, "ord INT, type VARCHAR, number VARCHAR, id VARCHAR, around VARCHAR"),
    "structured_markup": cases.sql(cases.KEPT, "tag VARCHAR, name VARCHAR, n BIGINT"),
    "span_merges": cases.sql(cases.MERGES, "ord INT, kind VARCHAR, text VARCHAR, keep VARCHAR, dropped VARCHAR"),
    "merged_links": cases.sql(cases.MERGED, "ord INT, text VARCHAR, href VARCHAR"),
    "chained_links": cases.sql(cases.CHAINED, "text VARCHAR, keep VARCHAR, terminal VARCHAR, dropped INT"),
    "note_texts": cases.sql(cases.NOTES, "text VARCHAR, narrow BOOLEAN, wide BOOLEAN"),
    "content_texts": cases.sql(cases.TEXTS, "text VARCHAR, noise_free BOOLEAN, in_link BOOLEAN, eligible BOOLEAN, in_heading BOOLEAN"),
    "broken_lines": cases.sql(cases.LINES, "ord INT, text VARCHAR"),
    "link_neighbours": cases.sql(cases.AROUND, "text VARCHAR, before VARCHAR, after VARCHAR, gap VARCHAR"),
    "link_hosts": cases.sql(cases.HOSTS, "text VARCHAR, in_scope BOOLEAN, article VARCHAR"),
    "element_anchors": cases.sql(cases.ANCHORS, "tag VARCHAR, anchor VARCHAR"),
    "id_inventory": cases.sql(cases.IDS, "id VARCHAR, of_links BOOLEAN"),
    "link_context": cases.sql(cases.BEFORE, "text VARCHAR, prev_text VARCHAR"),
    "anchor_methods": cases.sql(cases.METHODS, "article VARCHAR, anchor VARCHAR, method INT"),
    "synthetic_anchors": cases.sql(cases.SYNTHETIC, "id VARCHAR, text VARCHAR"),
    "article_headings": cases.sql(cases.DETECTED, "article VARCHAR, anchor VARCHAR"),
    "point_anchors": cases.sql(cases.POINTS, "key VARCHAR, anchor VARCHAR"),
    "written_points": cases.sql(cases.WRITTEN_POINTS, "id VARCHAR, text VARCHAR"),
    "part_map": cases.sql(cases.PARTS, "article VARCHAR, part VARCHAR, anchor VARCHAR"),
    "chapter_sources": cases.sql(cases.CHAPTERS, "chapter VARCHAR, anchor VARCHAR"),
    "named_ids": cases.sql(cases.NAMED_IDS, "name VARCHAR, id VARCHAR"),
    "heading_numbers": cases.sql(cases.NUMBERED, "id VARCHAR, number VARCHAR"),
    "boundary_marks": cases.sql(cases.EDGES, "id VARCHAR, number VARCHAR"),
    "chunked_acts": cases.sql(cases.CHUNKED, "id VARCHAR, text VARCHAR, hier_id VARCHAR, unit_type VARCHAR, unit_number VARCHAR, status VARCHAR, split_from VARCHAR"),
    "discrepancy_log": cases.sql(cases.DISCREPANT, "kind VARCHAR, number VARCHAR, own_number VARCHAR"),
    "tree_records": cases.sql(cases.TREES, "ord INT, article VARCHAR, units INT, children INT"),
    "title_numbers": cases.sql(cases.TITLES, "text VARCHAR, bold VARCHAR, plain VARCHAR, title VARCHAR", key=False),
    "unit_words": cases.sql(cases.UNIT_WORDS, "code VARCHAR, article VARCHAR, special BOOLEAN, word VARCHAR", key=False),
    "unlinked_references": cases.sql(cases.UNLINKED, "class VARCHAR, match VARCHAR, context VARCHAR, editorial BOOLEAN"),
    "page_coverage": cases.sql(cases.COVERAGE, "class VARCHAR, n BIGINT"),
    "coverage_totals": "WITH n AS (SELECT count(*) AS k FROM supplier) SELECT class, (n * k)::BIGINT AS n FROM n, (VALUES ('article', 2), ('linked:external', 1), ('linked:internal', 1), ('linked:nav', 1), ('self', 1), (NULL, 6)) v(class, n)",
    "claimed_verdicts": cases.sql(cases.VERDICTS, "kind VARCHAR, claimed VARCHAR, article VARCHAR, verdict VARCHAR, inherited BOOLEAN"),
    "independent_checks": cases.sql(cases.INDEPENDENT, "n VARCHAR, target VARCHAR, verdict VARCHAR"),
    "hinted_mismatches": cases.sql(cases.HINTED, "hint VARCHAR, expected VARCHAR, actual VARCHAR"),
    "named_acts": cases.sql(cases.NAMES, "text VARCHAR, expected VARCHAR", key=False),
    "external_names": f"""
        WITH {_HREFS}, n AS (SELECT *, event_id % 4 + 1 AS said FROM hrefs WHERE k NOT IN (3, 5) AND user_id % 7 < 5)
        SELECT ord, doc AS actual, CASE WHEN said < 3 THEN 'K1500000001,K1500000002' ELSE 'K1500000003' END AS expected FROM n
        WHERE said < 4 AND CASE WHEN said < 3 THEN user_id % 7 NOT IN (1, 2) ELSE user_id % 7 <> 3 END
    """,
    "all_checks": cases.sql(cases.SIX, '"check" VARCHAR, n BIGINT, contexts VARCHAR'),
    "canon_gates": cases.sql(cases.GATES, "gate VARCHAR, n BIGINT"),
    "retargeted_links": cases.sql(cases.RETARGETED, "ord INT, href VARCHAR"),
    "dropped_letters": cases.sql(cases.DROPPED, "ord INT, href VARCHAR"),
    "odd_hrefs": cases.sql(cases.ODD, "href VARCHAR"),
    "meant_articles": cases.sql(cases.MEANT, "text VARCHAR, prev VARCHAR, articles VARCHAR", key=False),
    "phrase_places": cases.sql(cases.PHRASED, "ord INT, phrase VARCHAR, doc_id VARCHAR"),
    "phrase_pages": cases.sql(cases.PHRASED_LINKS, "ord INT, text VARCHAR, href VARCHAR"),
    "partial_phrases": cases.sql(cases.PARTIAL, "phrase VARCHAR, link_text VARCHAR"),
    "overridden_pages": cases.sql(cases.OVERRIDDEN, "html VARCHAR"),
    "span_gates": """
        WITH n AS (SELECT count(*) AS k FROM supplier)
        SELECT log, gate, ok, (c * k)::BIGINT AS n FROM n, (VALUES
            ('whole', 'text', true, 10), ('whole', 'nested', true, 10), ('whole', 'dangling', true, 10), ('whole', 'hrefs', true, 10),
            ('none', 'text', true, 10), ('none', 'nested', true, 10), ('none', 'dangling', true, 10), ('none', 'hrefs', true, 8), ('none', 'hrefs', false, 2),
            ('changed text', 'text', true, 4), ('changed text', 'text', false, 6), ('changed text', 'nested', true, 10), ('changed text', 'dangling', true, 10), ('changed text', 'hrefs', true, 10)
        ) v(log, gate, ok, c)
    """,
    "noise_free_text": f"""
        WITH p AS (SELECT page_id::VARCHAR AS doc_key, unnest(list_filter(regexp_split_to_array(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '<x>', 'gs'), '<[^>]*>'), lambda x: x <> '')) AS t FROM pages)
        SELECT doc_key, sum(length({_UNESCAPE.format("replace(replace(t, '&copy;', '©'), '&middot;', '·')")}))::BIGINT AS n_chars, count(*) AS n_texts FROM p GROUP BY doc_key
    """,
    "eligible_texts": f"""
        WITH p AS (
            SELECT page_id::VARCHAR AS doc_key, unnest(regexp_split_to_array(regexp_replace(html, '<(script|style|head|a|h[1-6])( [^>]*)?>.*?</(script|style|head|a|h[1-6])>', '<x>', 'gs'), '<[^>]*>')) AS t FROM pages
        )
        SELECT doc_key, count(*) AS n FROM p WHERE length(trim(regexp_replace({_UNESCAPE.format('t')}, '\\s+', ' ', 'g'))) >= 3 GROUP BY doc_key
    """,
    "dictionary_links": r"""
        WITH t AS (SELECT doc_id AS document, regexp_replace(' ' || lower(text) || ' ', '([^\p{L}\p{N}])', '\1\1', 'g') AS t FROM documents WHERE text IS NOT NULL),
        c AS (
            SELECT document, unnest([
                {'doc_id': 'D2', 'n': len(regexp_extract_all(t, '[^\p{L}\p{N}]of\s+the\s+and[^\p{L}\p{N}]'))},
                {'doc_id': 'D1', 'n': len(regexp_extract_all(t, '[^\p{L}\p{N}]of\s+the[^\p{L}\p{N}]')) - len(regexp_extract_all(t, '[^\p{L}\p{N}]of\s+the\s+and[^\p{L}\p{N}]'))},
                {'doc_id': 'D3', 'n': len(regexp_extract_all(t, '[^\p{L}\p{N}]in\s+la[^\p{L}\p{N}]'))},
                {'doc_id': 'D4', 'n': len(regexp_extract_all(t, '[^\p{L}\p{N}]der\s+und[^\p{L}\p{N}]'))},
                {'doc_id': 'D5', 'n': len(regexp_extract_all(t, '[^\p{L}\p{N}]de\s+la[^\p{L}\p{N}]'))}
            ]) AS x FROM t
        )
        SELECT document, x.doc_id AS doc_id, x.n AS n FROM c WHERE x.n > 0
    """,
    "first_articles": """
        SELECT article, p_partkey FROM (SELECT CASE p_size % 3 WHEN 0 THEN (p_partkey % 50)::VARCHAR ELSE (p_partkey % 50) || '-' || p_size END AS article, p_partkey, p_partkey % 50 AS a, CASE p_size % 3 WHEN 0 THEN 0 ELSE p_size END AS b FROM part)
        ORDER BY a, b, article, p_partkey LIMIT 10
    """,
    "stale_phrases": "SELECT p_name AS phrase, 'D' || p_size AS doc_id, CASE WHEN p_size = 7 THEN 'confirmed' ELSE 'review' END AS status, CASE WHEN p_size = 7 THEN 'D107' END AS candidate FROM part WHERE p_size IN (7, 8)",
    "strict_gates": f"""
        WITH {_HREFS}, c AS (SELECT count(*) FILTER (WHERE doc = 'K1500000001' AND k IN (2, 4)) AS n FROM hrefs), p AS (SELECT count(*) FILTER (WHERE p_size = 7) AS m FROM part)
        SELECT 'all' AS name, n AS links, m AS "rows", n = 0 AND m = 0 AS ok FROM c, p
        UNION ALL SELECT 'no links', 0, m, m = 0 FROM p UNION ALL SELECT 'no rows', n, 0, n = 0 FROM c UNION ALL SELECT 'none', 0, 0, true
    """,
    "registry_files": """
        SELECT 's' || s_suppkey AS code, CASE WHEN s_suppkey % 2 = 0 THEN 'K' || (1000000 + s_suppkey) ELSE 'K' || (1000000 + s_suppkey) || '_' END AS doc_id, s_name AS title,
            CASE WHEN s_suppkey % 3 = 0 THEN 'alias' || s_suppkey ELSE 's' || s_suppkey END AS source_name FROM supplier
    """,
    "remap_file": "SELECT 'K' || (1000000 + s_suppkey) AS old_id, 'K' || (2000000 + s_suppkey) AS new_id FROM supplier",
    "map_files": "SELECT n_regionkey::VARCHAR AS code, n_nationkey::VARCHAR AS key, n_name AS anchor FROM nation",
    "phrase_file": "SELECT phrase, 'D' || max(p_partkey) AS doc_id, length(phrase) AS size FROM (SELECT p_type || ' ' || p_brand || ' ' || p_size AS phrase, p_partkey FROM part) WHERE length(phrase) >= 16 GROUP BY phrase",
    "override_file": "SELECT s_suppkey::VARCHAR AS id, 's' || s_suppkey % 5 AS code, s_name AS find_phrase, 'anchor ' || s_suppkey AS anchor_phrase, 'K' || (1000000 + s_suppkey) AS doc_id, 'z' || s_suppkey AS anchor, CASE WHEN s_suppkey % 2 = 0 THEN 'mark' END AS context_marker FROM supplier",
    "preferred_forms": "SELECT 'act' || s_suppkey AS doc_key, CASE s_suppkey % 3 WHEN 0 THEN 'source' WHEN 1 THEN 'structured' ELSE 'ready' END AS form, '<p>' || CASE s_suppkey % 3 WHEN 0 THEN 'source' WHEN 1 THEN 'structured' ELSE 'ready' END || ' ' || s_suppkey || '</p>' AS html FROM supplier",
    "page_versions": "SELECT version, page_id::VARCHAR AS doc_key, length(html) + CASE version WHEN 2 THEN 1 ELSE 0 END AS n_chars FROM pages CROSS JOIN (VALUES (1), (2)) v(version)",
    "chunk_lines": "SELECT n_nationkey::VARCHAR AS id, n_name AS text, CASE WHEN n_regionkey > 1 THEN n_regionkey::VARCHAR END AS unit_type, CASE WHEN n_regionkey > 1 THEN 4 ELSE 4 END AS n_fields FROM nation",
    "change_files": "SELECT n_nationkey::VARCHAR AS original, n_name AS article, 'z' || n_regionkey AS anchor, true AS was_written, false AS empty_written FROM nation",
    "report_lines": "SELECT n_nationkey || ': ' || n_name AS line FROM nation",
}
