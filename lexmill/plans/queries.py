"""One query per operator family over the driver tables, whole tables and whole texts each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import ORDINALS, ordinal, roman
from ..operators import anchors, audit, chunks, dom, references, spans, structure
from ..sources import html, registry, sinks
from ..sources.shared import bucketed, shared_folder, written
from . import acts, cases
from .sql import SQL


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.kept_nodes(html.told_apart(_t(spark, sf_dir, "pages"), "page_id", "html"), "doc_key", "html")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, inst, pos, anchor, text): the lines of documents as segments."""
    docs = _t(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("doc_key"), F.lit("1").alias("inst"), F.posexplode(F.split("text", "\n")).alias("pos", "text")).withColumn("anchor", F.lit(None).cast("string"))


def link_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    href = dom.attr("href")
    links = html.parse_nodes(_t(spark, sf_dir, "pages"), "page_id", "html", texts=False).where((F.col("tag") == "a") & href.isNotNull())
    return links.groupBy("doc_key", spans.link_kind(href).alias("kind")).agg(F.count("*").alias("n"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("doc_key").orderBy("node_id"))
    return dom.links(_pages(spark, sf_dir)).select("doc_key", rank.alias("ord"), "href", "text")


def raw_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.raw_hrefs(_t(spark, sf_dir, "pages"), "page_id", "html")


def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.parse_nodes(_t(spark, sf_dir, "pages"), "page_id", "html", texts=False).groupBy("doc_key", "tag").agg(F.count("*").alias("n"))


def content_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _pages(spark, sf_dir)
    texts = dom.element_texts(nodes, dom.content_root(nodes).select("doc_key", "node_id"))
    return texts.select("doc_key", F.length("text_raw").alias("n_chars"), F.md5("text_raw").alias("digest"))


def noise_free_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dom.without_noise(_pages(spark, sf_dir)).where("kind = 'text'")
    return texts.groupBy("doc_key").agg(F.sum(F.length("text")).alias("n_chars"), F.count("*").alias("n_texts"))


def eligible_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _pages(spark, sf_dir)
    rows = nodes.where(dom.eligible_text()).join(dom.heading_texts(nodes), ["doc_key", "node_id"], "left_anti")
    return rows.groupBy("doc_key").agg(F.count("*").alias("n"))


def serialized_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written from their nodes and parsed again: the links are the same."""
    again = html.kept_nodes(html.serialize(_pages(spark, sf_dir)), "doc_key", "html")
    rank = F.row_number().over(Window.partitionBy("doc_key").orderBy("node_id"))
    return dom.links(again).select("doc_key", rank.alias("ord"), "href", "text")


def head_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _t(spark, sf_dir, "pages")
    done = sinks.with_head(F.col("html"), "<style>a:target{color:red}</style>")
    return pages.select("page_id", F.length(done).alias("n_chars"), F.instr(done, "<style>a:target").alias("at"))


def preceding_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("doc_key", F.lit(0).alias("parent_id"), F.col("pos").alias("sib_pos"), F.lit("text").alias("kind"), "text")
    return dom.before(rows, 60).select("doc_key", F.col("sib_pos").alias("pos"), "prev_text")


def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _pages(spark, sf_dir).where("tag = 'a'").select("doc_key", F.create_map(F.lit("id"), dom.attr("href")).alias("attrs"))
    return dom.duplicate_ids(nodes).select("doc_key", "id", F.col("count").alias("n"))


def roman_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tens, ones = F.array(*map(F.lit, ["", "X", "XX", "XXX", "XL", "L"])), F.array(*map(F.lit, ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]))
    text = F.concat(tens[(F.col("p_size") / 10).cast("int")], ones[F.col("p_size") % 10])
    return _t(spark, sf_dir, "part").select("p_partkey", text.alias("numeral"), roman(text).alias("value"))


def ordinal_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*(F.lit(stem + "ой") for stem in ORDINALS))
    word = F.try_element_at(words, F.col("p_size"))
    return _t(spark, sf_dir, "part").select("p_partkey", ordinal(word).alias("value"))


def line_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as headings by their length; each with its parent."""
    n = F.length("text")
    kind = F.when(n <= 40, "section").when(n <= 120, "chapter").when(n <= 400, "article")
    rows = _lines(spark, sf_dir).withColumn("type", kind)
    return structure.hierarchy(rows).select("doc_key", "pos", "level", "parent_pos")


def act_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.kept_nodes(acts.act_pages(spark, sf_dir), "doc_key", "html")
    return structure.level_counts(structure.blocks(nodes))


def act_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.kept_nodes(acts.act_pages(spark, sf_dir), "doc_key", "html")
    rows = structure.structured(nodes).select("doc_key", "pos", "type", "number", "title", "wrapper", "parent_pos")
    up = rows.select("doc_key", F.col("pos").alias("parent_pos"), F.col("number").alias("chapter"))
    return rows.where("type = 'article'").join(up, ["doc_key", "parent_pos"], "left").select("doc_key", "number", "title", "wrapper", "chapter")


def article_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.kept_nodes(acts.act_pages(spark, sf_dir), "doc_key", "html")
    return anchors.article_anchors(nodes).select("doc_key", "article", "anchor", "method")


def subpoint_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.kept_nodes(acts.act_pages(spark, sf_dir), "doc_key", "html")
    return anchors.subpoint_anchors(nodes).select("doc_key", "key", "anchor")


def chapter_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.chapter_anchors(html.kept_nodes(acts.act_pages(spark, sf_dir), "doc_key", "html"))


def article_map_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("code"), F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("anchor"))
    return sinks.map_json(rows)


def act_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw acts to structured pages to articles to chunks."""
    nodes = html.kept_nodes(structure.structured_html(html.kept_nodes(acts.act_pages(spark, sf_dir), "doc_key", "html")), "doc_key", "html")
    registered = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("doc_id"))
    articles, segments = (bucketed(df, "articles", "doc_key", "inst") for df in chunks.parse_articles(nodes, registered))
    made = chunks.chunks(articles, segments)
    return made.select("id", "text", F.col("meta.hier_id").alias("hier_id"), F.col("meta.doc_id").alias("doc_id"), F.col("meta.unit_type").alias("unit_type"), F.col("meta.char_len").alias("char_len"))


def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return anchors.first_wins(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


def reverse_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("code"), F.col("l_partkey").cast("string").alias("anchor"), F.col("l_orderkey").cast("string").alias("o"), F.col("l_linenumber").alias("n"))
    articles = rows.where("n = 1").select("code", "anchor", F.col("o").alias("key"))
    subpoints = rows.where("n > 1").select("code", "anchor", F.concat_ws("_", "o", "n").alias("key"))
    return anchors.reverse_anchors(articles, subpoints)


def anchor_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "H").when(F.col("event_type") == "view", "B").otherwise("A")
    rows = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doc_key"), F.col("event_id").alias("pos"), kind.alias("kind"), F.col("event_id").cast("string").alias("val"))
    return anchors.resolve(rows)


def found_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = acts.reference_pages(spark, sf_dir)
    found = references.find_references(html.kept_nodes(pages, "doc_key", "html"), acts.reference_maps(pages))
    return references.references(found).groupBy("doc_key", "rule", "article", "anchor").agg(F.count("*").alias("n"))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their references linked: how many links each has, and its text's length, which stays."""
    pages = acts.reference_pages(spark, sf_dir)
    nodes = html.kept_nodes(pages, "doc_key", "html")
    found = references.find_references(nodes, acts.reference_maps(pages))
    again = html.kept_nodes(html.serialize(references.linked_nodes(nodes, found)), "doc_key", "html")
    links = F.count(F.when(F.col("tag") == "a", 1)).alias("n_links")
    return again.groupBy("doc_key").agg(links, F.sum(F.length("text")).alias("n_chars"))


def top_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.top_changes(_t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("article")))


def merged_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.kept_nodes(acts.chain_pages(spark, sf_dir), "doc_key", "html")
    found = spans.chains(spans.siblings(nodes))
    return found.groupBy("doc_key", "text", "keep", "terminal").agg(F.count("*").alias("n"), F.max(F.size("dropped")).alias("dropped"))


def full_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.kept_nodes(acts.chain_pages(spark, sf_dir), "doc_key", "html")
    return spans.span_log(spans.full_spans(spans.siblings(nodes))).groupBy("doc_key", "kind").agg(F.count("*").alias("n"))


def chain_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merging chains keeps every page's text and drops just the logged hrefs; what tells is gathered while the pages are written."""
    nodes = html.kept_nodes(acts.chain_pages(spark, sf_dir), "doc_key", "html")
    found = written(spans.chains(spans.siblings(nodes)), "chains")
    pages = written(audit.profiled(spans.merged_chains(nodes, found), pages=True), "pages")
    told = audit.compared(audit.profiled(nodes), pages, found.select("doc_key", "dropped"))
    return told.groupBy("gate", "ok").agg(F.count("*").alias("n"))


def canonical_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.concat(F.lit("K15000"), F.lpad("doc_key", 5, "0"))
    rows = acts.hrefs(spark, sf_dir)
    rows = spans.canonical(rows.withColumn("kind", spans.link_kind(F.col("href"), own)), acts.known_ids(spark, sf_dir), own)
    return rows.select("ord", "href", "kind")


def dangling_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("doc_key"), "o_orderstatus", "o_orderkey", F.col("o_custkey").cast("string").alias("id"))
    rows = orders.select("doc_key", "o_orderkey", F.concat(F.lit("#"), "id").alias("href"))
    return spans.dangling(rows, orders.where("o_orderstatus = 'F'").select("doc_key", "id").distinct())


def renamed_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("-")).alias("doc_key"), F.col("doc_id").alias("node_id"), F.col("n_chars").cast("string").alias("id"), "source")
    return spans.renamed_duplicates(docs.drop("source"), docs.where("source = 'src0'").select("doc_key", "id"))


def href_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = registry.raw_hrefs(_t(spark, sf_dir, "pages"), "page_id", "html")
    return spans.href_delta(old, old.withColumn("href", F.lower("href")))


def text_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.text_hash(_t(spark, sf_dir, "documents").withColumnRenamed("doc_id", "doc_key"))


def frozen_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_key"), "text")
    done = docs.withColumn("text", F.regexp_replace("text", "  +", " "))
    return audit.frozen(spans.text_hash(docs), spans.text_hash(done)).groupBy("same").agg(F.count("*").alias("n"))


def pattern_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _t(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_key"), "html")
    return audit.pattern_delta(pages, pages.withColumn("html", F.regexp_replace("html", "<br>", "")), "<br>")


#: A dictionary of the driver's made-up prose.
PHRASES = [("of the", "D1"), ("of the and", "D2"), ("in la", "D3"), ("der und", "D4"), ("de la", "D5")]


def dictionary_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = spark.createDataFrame(PHRASES, "phrase string, doc_id string")
    found = spans.phrase_links(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("document"), "text"), phrases, least=5)
    return spans.phrase_hits(found, "document").groupBy("document", "doc_id").agg(F.count("*").alias("n"))


def longest_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    hints = spark.createDataFrame([("the", "E1"), ("thethe", "E2"), ("und", "E3"), ("unden", "E4"), ("que", "E5"), ("queleaux", "E6")], "hint string, expected string")
    return audit.longest_hint(_t(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id"), hints)


def stale_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = spark.createDataFrame([("K1500000001", "confirmed", "K2500000001"), ("K1500000004", "review", None)], "doc_id string, status string, candidate string")
    return audit.stale_links(acts.hrefs(spark, sf_dir), status)


def external_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([("K1500000000",), ("K1500000002",)], "doc_id string")
    return audit.inventory(acts.hrefs(spark, sf_dir), own)


def remapped_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    remap = spark.createDataFrame([("K1500000001", "K2500000001"), ("K1500000003", "K2500000003")], "old_id string, new_id string")
    return spans.remapped(acts.hrefs(spark, sf_dir).select("ord", "href"), remap)


def relinked_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to deprecated acts taken to the end of their chains: one of 25 acts, one of a single step, and a cycle, which stays; articles by the new acts' maps."""
    n = F.col("n_nationkey")
    chain = _t(spark, sf_dir, "nation").select(F.concat(F.lit("C"), n + 1000000).alias("old_id"), F.concat(F.lit("C"), n + 1000001).alias("new_id"))
    more = spark.createDataFrame([("K1500000001", "C1000000"), ("K1500000003", "K2500000003"), ("K1500000005", "K2500000005"), ("K2500000005", "K1500000005")], "old_id string, new_id string")
    last = F.concat(F.lit("C"), F.max(n) + 1000001)
    articles = _t(spark, sf_dir, "nation").agg(last.alias("doc_id")).select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("k")).select("doc_id", F.col("k").cast("string").alias("article"), F.concat(F.lit("z"), "k").alias("anchor"))
    articles = articles.union(spark.createDataFrame([("K2500000003", "2", "z22")], "doc_id string, article string, anchor string"))
    return spans.remapped(acts.hrefs(spark, sf_dir).select("ord", "href", "text"), chain.union(more), articles).select("ord", "href", "was")


def link_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of pages against those of another form, in which some are gone, some point elsewhere and some are new."""
    rank = F.row_number().over(Window.partitionBy("doc_key").orderBy("node_id"))
    old = written(dom.links(_pages(spark, sf_dir)).select("doc_key", rank.alias("ord"), "href", "text"), "links")
    kept = old.where("ord % 5 <> 3").withColumn("href", F.when(F.col("ord") % 7 == 2, F.concat("href", F.lit("#moved"))).otherwise(F.col("href"))).withColumn("ord", F.col("ord") * 2)
    new = kept.unionByName(old.where("ord % 11 = 4").select("doc_key", (F.col("ord") * 2 + 1).alias("ord"), F.lit("/new").alias("href"), F.lit("neu").alias("text")))
    return audit.sequence_diff(old, new)


def cross_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    registered = spark.createDataFrame([(str(i), f"K15000{i:05d}") for i in range(5)], "code string, doc_id string")
    articles = spark.range(5).select(F.col("id").cast("string").alias("code"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("k")).where("code <> '4'").select("code", F.col("k").cast("string").alias("key"), F.concat(F.lit("z"), "k").alias("anchor"))
    subpoints = articles.where("key = '2'").select("code", F.lit("2_1").alias("key"), F.lit("z7").alias("anchor"))
    rows = acts.hrefs(spark, sf_dir).where(~F.col("href").rlike(spans.ODD_HREF))
    return audit.cross_verify(rows, registered, articles, subpoints).groupBy("doc_key", "target", "verdict").agg(F.count("*").alias("n"))


def coverage_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_linenumber") == 1).alias("linked"), F.count_if(F.col("l_linenumber") == 2).alias("open"), F.count_if((F.col("l_linenumber") == 2) & (F.col("l_returnflag") == "A")).alias("generic"), F.lit(0).cast("long").alias("editorial"))
    out = audit.coverage_ratios(rows)
    return out.select("l_suppkey", *(F.round(c, 6).alias(c) for c in ("cov_lit", "cov_content", "cov_real")))


def line_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as units by their first letter, carried forward."""
    rows = chunks.units(_lines(spark, sf_dir), punkt="^([A-F])", sub="^([G-R])", nested="^([S-T])")
    return rows.select("doc_key", "pos", "class", "u", "c", "unit")


def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    articles = docs.select(F.col("doc_id").cast("string").alias("doc_key"), F.lit("1").alias("inst"), F.coalesce("source", F.lit("-")).alias("code"), F.lit("D").alias("doc_id"), F.col("doc_id").cast("string").alias("article"), F.lit("T").alias("title"), F.lit("пункт").alias("unit_type"), F.lit("active").alias("status"), none.alias("code_part"), none.alias("section"), none.alias("chapter"), none.alias("paragraph"), F.lit(False).alias("partial"), F.lit(False).alias("orphan"))
    made = chunks.chunks(articles, _lines(spark, sf_dir), split_chars=1 << 30, punkt="^([A-F])", sub="^(~)", nested="^(~~)")
    return made.select("doc_key", "ord", "id", F.md5("text").alias("digest"), F.col("meta.char_len").alias("char_len"))


def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    rows = docs.select(F.coalesce("lang", F.lit("-")).alias("code"), F.col("source").alias("article_key"), F.length("text").alias("char_len"), F.when(F.col("doc_id") % 10 == 0, "repealed").otherwise("active").alias("status"), (F.col("doc_id") % 7 == 0).alias("orphan"))
    return chunks.chunk_stats(rows)


def sample_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.round_robin(_t(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", ["event_id"]).select("event_id", "event_type", "turn")


def act_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html.kept_nodes(acts.act_pages(spark, sf_dir), "doc_key", "html")
    return audit.events(nodes).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("val").alias("vals"))


def link_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of acts whose claims and targets follow from the line items, some of them outside content or to other anchors."""
    nodes = html.kept_nodes(acts.verdict_pages(spark, sf_dir), "doc_key", "html")
    return audit.correctness(nodes).groupBy("doc_key", "kind", "verdict").agg(F.count("*").alias("n"))


def _ranked_links(nodes: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("doc_key").orderBy("node_id")) - 1
    return dom.links(nodes).select("doc_key", rank.alias("ord"), "text", "href")


def _nodes_of(spark: SparkSession, sf_dir: str, own: list[cases.Case]) -> DataFrame:
    return html.kept_nodes(cases.pages(spark, sf_dir, own), "doc_key", "html")


def linked_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw acts with all references linked by their own anchors, every rule with a phrase that it takes and one that it leaves."""
    done = references.linked_pages(cases.pages(spark, sf_dir, cases.LINKED))
    return _ranked_links(html.kept_nodes(done, "doc_key", "html"))


def swept_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw acts with all references linked, also those to the act's own articles that markup parts into several texts."""
    done = references.linked_pages(cases.pages(spark, sf_dir, cases.SWEPT), sweep=True)
    return _ranked_links(html.kept_nodes(done, "doc_key", "html"))


def act_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of heading, split, virtual and merged ones among them, with its place in the hierarchy."""
    return structure.structured(_nodes_of(spark, sf_dir, cases.SECTIONS)).select("doc_key", "pos", "kind", "type", "number", "anchor", "parent_pos")


def structured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wrappers of pages written with their hierarchy and read again, each with the one around it."""
    again = html.kept_nodes(structure.structured_html(_nodes_of(spark, sf_dir, cases.WRAPPERS)), "doc_key", "html")
    divs = again.where((F.col("tag") == "div") & dom.attr("data-type").isNotNull())
    around = dom.host(divs, None).select("doc_key", "node_id", "host").join(divs.select("doc_key", F.col("node_id").alias("host"), dom.attr("data-type").alias("around")), ["doc_key", "host"])
    rank = F.row_number().over(Window.partitionBy("doc_key").orderBy("node_id")) - 1
    rows = divs.select("doc_key", "node_id", dom.attr("data-type").alias("type"), dom.attr("data-number").alias("number"), dom.attr("id").alias("id"), rank.alias("ord"))
    return rows.join(around.drop("host"), ["doc_key", "node_id"], "left").drop("node_id")


def structured_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What structured pages keep of the markup: links, anchors, tables, what stands outside the root."""
    again = html.kept_nodes(structure.structured_html(_nodes_of(spark, sf_dir, cases.KEPT)), "doc_key", "html")
    name = F.coalesce(dom.attr("href"), dom.attr("id"), dom.attr("name"))
    wanted = F.col("tag").isin("a", "table", "td", "i", "nav", "title", "span", "h4") | name.isin("a6", "a9", "a9_chapter9")
    return again.where(wanted).groupBy("doc_key", "tag", name.alias("name")).agg(F.count("*").alias("n"))


def span_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widened and merged links by kind, in the order in which they were applied."""
    found = spans.full_spans(spans.siblings(_nodes_of(spark, sf_dir, cases.MERGES)))
    return spans.span_log(found).select("doc_key", "ord", "kind", "text", "keep", "dropped")


def merged_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of pages after all merges, written and read again."""
    done = html.serialize(spans.merged_spans(_nodes_of(spark, sf_dir, cases.MERGED)))
    return _ranked_links(html.kept_nodes(done, "doc_key", "html"))


def chained_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans.chains(spans.siblings(_nodes_of(spark, sf_dir, cases.CHAINED)))
    return found.select("doc_key", "text", "keep", "terminal", F.size("dropped").alias("dropped"))


def span_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates of merges as they were logged, and of the same with a log that leaves out what was dropped: these must fail."""
    nodes = _nodes_of(spark, sf_dir, cases.MERGES)
    found = written(spans.full_spans(spans.siblings(nodes)), "spans")
    again = html.kept_nodes(html.serialize(spans.merged_spans(nodes, found)), "doc_key", "html")
    dropped = spans.span_log(found).groupBy("doc_key").agg(F.collect_list("dropped").alias("dropped"))
    told = audit.gates(nodes, again, dropped).withColumn("log", F.lit("whole"))
    untold = audit.gates(nodes, again).withColumn("log", F.lit("none"))
    other = audit.gates(nodes, again.withColumn("text", F.replace("text", F.lit("закона"), F.lit("кодекса"))), dropped).withColumn("log", F.lit("changed text"))
    return told.unionByName(untold).unionByName(other).groupBy("log", "gate", "ok").agg(F.count("*").alias("n"))


def _texts(nodes: DataFrame) -> DataFrame:
    return nodes.where("kind = 'text'").select("doc_key", "node_id", "text")


def _flag(rows: DataFrame, among: DataFrame, name: str) -> DataFrame:
    """``rows`` with whether (doc_key, node_id) is ``among`` others."""
    return rows.join(among.select("doc_key", "node_id").distinct().withColumn(name, F.lit(True)), ["doc_key", "node_id"], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def note_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.NOTES)
    return _flag(_flag(_texts(nodes), dom.in_note(nodes, wide=False), "narrow"), dom.in_note(nodes), "wide").drop("node_id")


def content_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.TEXTS)
    rows = _texts(nodes)
    for name, among in (("noise_free", dom.without_noise(nodes)), ("in_link", nodes.where(dom.inside_link())), ("eligible", nodes.where(dom.eligible_text())), ("in_heading", dom.heading_texts(nodes))):
        rows = _flag(rows, among, name)
    return rows.drop("node_id")


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("doc_key").orderBy("line")) - 1
    return dom.lines(_nodes_of(spark, sf_dir, cases.LINES)).select("doc_key", rank.alias("ord"), "text")


def link_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.AROUND)
    said = lambda c: F.coalesce(F.col(c)["tag"], F.col(c)["text"])
    rows = dom.neighbours(nodes).select("doc_key", "node_id", said("prev_node").alias("before"), said("next_node").alias("after"), "gap")
    return dom.links(nodes).select("doc_key", "node_id", "text").join(rows, ["doc_key", "node_id"]).drop("node_id")


def link_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.HOSTS)
    rows = _flag(dom.links(nodes), dom.in_scope(nodes), "in_scope")
    return rows.join(dom.host(nodes), ["doc_key", "node_id"], "left").select("doc_key", "text", "in_scope", F.col("host_number").alias("article"))


def element_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.ANCHORS)
    return nodes.where("tag in ('h3', 'p', 'h4', 'h5', 'h6')").select("doc_key", "node_id", "tag").join(dom.anchor_ids(nodes), ["doc_key", "node_id"]).drop("node_id")


def id_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.IDS)
    own = dom.ids(nodes, ["a"]).withColumn("of_links", F.lit(True))
    return dom.ids(nodes).join(own, ["doc_key", "id"], "left").withColumn("of_links", F.coalesce("of_links", F.lit(False)))


def link_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.BEFORE)
    return dom.links(nodes).select("doc_key", "node_id", "text").join(dom.preceding(nodes, 20), ["doc_key", "node_id"]).drop("node_id")


def anchor_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.article_anchors(_nodes_of(spark, sf_dir, cases.METHODS)).select("doc_key", "article", "anchor", "method")


def _said_by_ids(nodes: DataFrame, tag: str) -> DataFrame:
    """(doc_key, id, text): links with an id, and what the ``tag`` around them says."""
    own = nodes.where((F.col("tag") == "a") & dom.attr("id").isNotNull()).select("doc_key", dom.attr("id").alias("id"), F.col("parent_id").alias("node_id"))
    return dom.element_texts(nodes, own.join(nodes.where(F.col("tag") == tag).select("doc_key", "node_id"), ["doc_key", "node_id"])).select("doc_key", "id", F.col("text_raw").alias("text"))


def synthetic_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.SYNTHETIC)
    return _said_by_ids(html.kept_nodes(html.serialize(anchors.with_synthetic(nodes, anchors.article_anchors(nodes))), "doc_key", "html"), "b")


def article_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.article_headings(_nodes_of(spark, sf_dir, cases.DETECTED)).drop("node_id")


def point_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.subpoint_anchors(_nodes_of(spark, sf_dir, cases.POINTS)).drop("node_id")


def written_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.WRITTEN_POINTS)
    return _said_by_ids(html.kept_nodes(html.serialize(anchors.with_point_ids(nodes, anchors.subpoint_anchors(nodes))), "doc_key", "html"), "p")


def part_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.part_anchors(_nodes_of(spark, sf_dir, cases.PARTS))


def chapter_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.chapter_anchors(_nodes_of(spark, sf_dir, cases.CHAPTERS))


def named_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.ids_from_names(_nodes_of(spark, sf_dir, cases.NAMED_IDS)).where("tag = 'a'").select("doc_key", dom.attr("name").alias("name"), dom.attr("id").alias("id"))


def heading_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.heading_map(_nodes_of(spark, sf_dir, cases.NUMBERED))


def boundary_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.boundary(_nodes_of(spark, sf_dir, cases.EDGES))


def first_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    article = F.when(F.col("p_size") % 3 == 0, (F.col("p_partkey") % 50).cast("string")).otherwise(F.concat_ws("-", F.col("p_partkey") % 50, "p_size"))
    return anchors.by_number(_t(spark, sf_dir, "part").select(article.alias("article"), "p_partkey"), 10, "p_partkey")


def _articles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    nodes = _nodes_of(spark, sf_dir, cases.CHUNKED)
    registered = nodes.select(F.col("doc_key").alias("code"), F.lit("D").alias("doc_id")).distinct()
    return nodes, *(bucketed(df, "articles", "doc_key", "inst") for df in chunks.parse_articles(nodes, registered))


def chunked_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a path, repealed, embedded, broken by lines, outside every div, without points, and with a long list."""
    _, articles, segments = _articles(spark, sf_dir)
    return chunks.chunks(articles, segments).select("doc_key", "id", "text", *(F.col(f"meta.{c}").alias(c) for c in ("hier_id", "unit_type", "unit_number", "status", "split_from")))


def discrepancy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.discrepancies(_nodes_of(spark, sf_dir, cases.DISCREPANT)).drop("node_id")


def tree_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree records written as JSON lines and read again: each article's units and subunits counted."""
    _, articles, segments = _articles(spark, sf_dir)
    folder = shared_folder(spark, "trees")
    made = chunks.tree_records(articles, segments)
    sinks.write_lines(made, folder)
    again = spark.read.schema(made.schema).json(folder).select(F.col("code").alias("doc_key"), F.posexplode("articles").alias("ord", "a"))
    children = F.aggregate("a.units", F.lit(0), lambda n, u: n + F.size(u["children"]))
    return again.select("doc_key", "ord", "a.article", F.when(F.col("a.units").isNotNull(), F.size("a.units")).alias("units"), F.when(F.col("a.units").isNotNull(), children).alias("children"))


def title_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases.table(spark, sf_dir, "text string", [(r[0],) for r in cases.TITLES[0].rows])
    text = F.col("text")
    return rows.select("text", chunks.title_number(text, F.lit(True)).alias("bold"), chunks.title_number(text, F.lit(False)).alias("plain"), chunks.without_title_prefix(text).alias("title"))


def unit_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases.table(spark, sf_dir, "code string, article string, special boolean", [r[:3] for r in cases.UNIT_WORDS[0].rows])
    return rows.withColumn("word", chunks.unit_word(F.col("code"), F.col("article"), F.col("special")))


def unlinked_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.unlinked(_nodes_of(spark, sf_dir, cases.UNLINKED)).drop("line")


def page_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.coverage(_nodes_of(spark, sf_dir, cases.COVERAGE))


def coverage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.class_totals(audit.coverage(_nodes_of(spark, sf_dir, cases.COVERAGE)))


def claimed_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.VERDICTS)
    source = nodes.select("doc_key", F.lit("#z1").alias("href")).distinct()
    return audit.correctness(nodes, source).select("doc_key", "kind", "claimed", "article", "verdict", "inherited")


def independent_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.INDEPENDENT)
    return audit.independent(nodes, anchors.boundary(nodes)).select("doc_key", "n", "target", "verdict")


def hinted_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    hints = spark.createDataFrame([("налогов", "K1500000002"), ("трудов", "K1500000001"), ("социально-трудов", "K1500000003")], "hint string, expected string")
    known = spark.createDataFrame([("K1500000001",), ("K1500000002",), ("K1500000003",)], "doc_id string")
    return audit.hinted_mismatches(_nodes_of(spark, sf_dir, cases.HINTED), hints, known).drop("node_id")


#: Names of acts for the queries: all words of an alternative must stand in the text; the first rule that matches counts.
NAME_RULES = [([["уголовн", "исполн"]], ["D2"]), ([["уголовн"]], ["D1"]), ([["рынк", "труд"], ["кратко"]], ["D3", "D4"])]


def named_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases.table(spark, sf_dir, "text string", [(r[0],) for r in cases.NAMES[0].rows])
    named = audit.named_acts(F.col("text"), NAME_RULES)
    return rows.select("text", F.when(named.isNotNull(), F.array_join(named, ",")).alias("expected"))


def external_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all shapes under names of acts: those whose act isn't among the ones that the name may mean."""
    rules = [([["статьи 1"], ["статьи 2"]], ["K1500000001", "K1500000002"]), ([["статьи 3"]], ["K1500000003"])]
    known = spark.createDataFrame([(f"K150000000{i}_",) for i in range(5)], "doc_id string")
    return audit.external_mismatches(acts.hrefs(spark, sf_dir), known, rules).select("ord", "actual", F.array_join("expected", ",").alias("expected"))


def all_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.SIX)
    own = nodes.select("doc_key", F.lit("K1500000077").alias("own")).distinct()
    return audit.six_checks(nodes, own).withColumn("contexts", F.array_join("contexts", "|"))


def canon_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.GATES)
    return spans.canon_gates(nodes, nodes.select("doc_key", F.lit("K1500000077").alias("own")).distinct())


def _by_place(rows: DataFrame) -> DataFrame:
    return rows.select("doc_key", (F.row_number().over(Window.partitionBy("doc_key").orderBy("node_id")) - 1).alias("ord"), "href")


def retargeted_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.RETARGETED)
    return _by_place(spans.retargeted(dom.links(nodes), anchors.article_anchors(nodes)))


def dropped_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.DROPPED)
    return _by_place(spans.with_dropped_z(dom.links(nodes), dom.ids(nodes)))


def odd_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.anomalies(dom.links(_nodes_of(spark, sf_dir, cases.ODD))).select("doc_key", "href")


def meant_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases.table(spark, sf_dir, "text string, prev string", [r[:2] for r in cases.MEANT[0].rows])
    return rows.withColumn("articles", F.array_join(audit.candidates(F.col("text"), F.col("prev")), ","))


def _dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("закону о рынке труда", "D1"), ("закону о рынке", "D2"), ("закон", "SHORT")], "phrase string, doc_id string")


def phrase_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _nodes_of(spark, sf_dir, cases.PHRASED).where(dom.eligible_text(1)).select("doc_key", "node_id", "text")
    return spans.phrase_hits(spans.phrase_links(texts, _dictionary(spark), 6), "doc_key")


def phrase_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = html.serialize(spans.linked_phrases(_nodes_of(spark, sf_dir, cases.PHRASED_LINKS), _dictionary(spark), 6))
    return _ranked_links(html.kept_nodes(done, "doc_key", "html"))


def partial_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _nodes_of(spark, sf_dir, cases.PARTIAL)
    blocks = dom.element_texts(nodes, nodes.where("tag = 'p'").select("doc_key", "node_id")).select("doc_key", F.col("node_id").alias("block_id"), F.col("text_raw").alias("text"))
    own = dom.links(nodes).join(nodes.select("doc_key", "node_id", "block_id"), ["doc_key", "node_id"])
    return spans.partial_phrases(blocks, own, _dictionary(spark))


def overridden_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases.pages(spark, sf_dir, cases.OVERRIDDEN).withColumnRenamed("doc_key", "code")
    own = cases.table(spark, sf_dir, "id string, find_phrase string, anchor_phrase string, doc_id string, anchor string, context_marker string", cases.OVERRIDES)
    codes = rows.select("code", F.split("code", "-")[0].alias("n"))
    numbered = own.withColumn("__n", F.regexp_extract("find_phrase", r"5(\d+)", 1))
    first = numbered.where("__n <> ''").drop("__n").withColumn("n", F.regexp_extract("find_phrase", r"5(\d+)", 1))
    rest = numbered.where("__n = ''").drop("__n").distinct()
    mine = codes.join(first, "n").drop("n").unionByName(F.broadcast(rest).crossJoin(codes.select("code")))  # three rows for every page
    return spans.overridden(rows, mine).select(F.col("code").alias("doc_key"), "html")


def stale_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "part").select(F.col("p_name").alias("phrase"), F.concat(F.lit("D"), "p_size").alias("doc_id"))
    return audit.stale_phrases(rows, spark.createDataFrame([("D7", "confirmed", "D107"), ("D8", "review", None)], "doc_id string, status string, candidate string"))


def strict_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = spark.createDataFrame([("K1500000001", "confirmed", "K2500000001"), ("K1500000004", "review", None)], "doc_id string, status string, candidate string")
    links_, rows = audit.stale_links(acts.hrefs(spark, sf_dir), status), stale_phrases(spark, sf_dir)
    out = None
    for name, a, b in (("all", links_, rows), ("no links", links_.limit(0), rows), ("no rows", links_, rows.limit(0)), ("none", links_.limit(0), rows.limit(0))):
        one = audit.strict_gate(a, b).withColumn("name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


# Files, written to the shared folder and read again


def _json_file(rows: DataFrame, name: str, key: str, value: Column, head: str = "") -> str:
    """The path of a JSON file with one object: ``key`` to ``value``, after the members of ``head``."""
    folder = shared_folder(rows.sparkSession, name)
    entries = F.array_sort(F.collect_list(F.concat(F.to_json(F.struct(F.col(key).alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(key).alias("k")))) - 6), F.lit(":"), value)))
    one = rows.agg(F.concat(F.lit("{" + head), F.array_join(entries, ","), F.lit("}")).alias("line"))
    sinks.write_report(one, folder)
    return f"{folder}/*.txt"


def _registry_path(spark: SparkSession, sf_dir: str) -> str:
    s = _t(spark, sf_dir, "supplier")
    doc = F.concat(F.lit("K"), F.col("s_suppkey") + 1000000, F.when(F.col("s_suppkey") % 2 == 0, "").otherwise("_"))
    rows = s.select(F.concat(F.lit("s"), "s_suppkey").alias("code"), doc.alias("doc_id"), F.col("s_name").alias("title"))
    return _json_file(rows, "registry", "code", F.to_json(F.struct("doc_id", "title")), '"_note":"meta","_remap":{"a":"b"},')


def registry_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry file read again, each act found by its id, with the names of its source file."""
    registered = written(registry.acts(spark, _registry_path(spark, sf_dir)), "registered")
    found = registry.code_of(registered.select(F.col("doc_id").alias("target_doc"), "title"), registered).withColumnRenamed("target_doc", "doc_id")
    names = registered.select("code").withColumn("k", F.substring("code", 2, 20).cast("int")).where("k % 3 = 0").select("code", F.concat(F.lit("alias"), "k").alias("alias"))
    return registry.source_name(found, names)


def remap_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "supplier").select(F.concat(F.lit("K"), F.col("s_suppkey") + 1000000).alias("old"), F.concat(F.lit("K"), F.col("s_suppkey") + 2000000).alias("new"))
    folder = shared_folder(spark, "remap")
    pairs = F.map_from_entries(F.array_sort(F.collect_list(F.struct("old", "new"))))
    sinks.write_report(s.agg(F.to_json(F.struct(F.lit("n").alias("_note"), pairs.alias("_deprecated"))).alias("line")), folder)
    return registry.act_remap(spark, f"{folder}/*.txt", "_deprecated")


def map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("code"), F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("anchor"))
    folder = shared_folder(spark, "maps")
    sinks.write_maps(sinks.map_json(rows), folder)
    return registry.anchor_maps(spark, folder)


def phrase_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrase = F.concat_ws(" ", "p_type", "p_brand", "p_size")
    rows = _t(spark, sf_dir, "part").groupBy(phrase.alias("phrase")).agg(F.concat(F.lit("D"), F.max("p_partkey")).alias("doc"))
    return registry.phrases(spark, _json_file(rows, "phrases", "phrase", F.concat(F.lit('"'), "doc", F.lit('"'))))


def override_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("s_suppkey")
    rows = _t(spark, sf_dir, "supplier").select(
        n.cast("string").alias("id"), F.concat(F.lit("s"), n % 5).alias("code"), F.col("s_name").alias("find_phrase"), F.concat(F.lit("anchor "), n).alias("anchor_phrase"), F.concat(F.lit("K"), n + 1000000).alias("doc_id"),
        F.concat(F.lit("z"), n).alias("anchor"), F.when(n % 2 == 0, "mark").alias("context_marker"),
    )
    folder = shared_folder(spark, "overrides")
    sinks.write_report(rows.agg(F.to_json(F.struct(F.collect_list(F.struct(*rows.columns)).alias("overrides"))).alias("line")), folder)
    return registry.overrides(spark, f"{folder}/*.txt")


def preferred_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages kept as files in one to three forms: the best form of each act."""
    s = _t(spark, sf_dir, "supplier")
    forms = F.slice(F.array(F.lit("source"), F.lit("structured"), F.lit("ready")), F.lit(1), F.col("s_suppkey") % 3 + 1)
    rows = s.select("s_suppkey", F.explode(forms).alias("form"))
    name = F.concat(F.lit("act"), "s_suppkey", F.when(F.col("form") == "source", "").otherwise(F.concat(F.lit("_"), "form")), F.lit(".html"))
    folder = shared_folder(spark, "forms")
    sinks.write_files(rows.select(name.alias("name"), F.concat(F.lit("<p>"), "form", F.lit(" "), "s_suppkey", F.lit("</p>")).alias("html")), folder)
    return html.preferred_form(html.read_html(spark, folder))


def page_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written twice: the first version stays as the backup of the second."""
    folder = shared_folder(spark, "pages")
    rows = _t(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("doc_key"), "html")
    sinks.write_pages(rows, folder, 1)
    sinks.write_pages(rows.withColumn("html", F.concat("html", F.lit("!"))), folder, 2)
    both = sinks.read_pages(spark, folder, 1).withColumn("version", F.lit(1)).unionByName(sinks.read_pages(spark, folder).withColumn("version", F.lit(2)))
    return both.select("version", "doc_key", F.length("html").alias("n_chars"))


def chunk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as JSON lines with explicit nulls: every line has all fields."""
    folder = shared_folder(spark, "chunks")
    rows = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("text"), F.when(F.col("n_regionkey") > 1, F.col("n_regionkey").cast("string")).alias("unit_type"), F.lit(None).cast("string").alias("gone"))
    sinks.write_lines(rows, folder)
    got = spark.read.text(folder)
    return got.select(*(F.get_json_object("value", f"$.{c}").alias(c) for c in ("id", "text", "unit_type")), F.size(F.from_json("value", "map<string,string>")).alias("n_fields"))


def change_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("original"), F.col("n_name").alias("article"), F.concat(F.lit("z"), "n_regionkey").alias("anchor"))
    folder = shared_folder(spark, "changes")
    was, empty = sinks.write_changes(rows, folder), sinks.write_changes(rows.limit(0), f"{folder}-none")
    return spark.read.option("header", True).schema(rows.schema).csv(folder).select("*", F.lit(was).alias("was_written"), F.lit(empty).alias("empty_written"))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "report")
    sinks.write_report(_t(spark, sf_dir, "nation").select(F.concat("n_nationkey", F.lit(": "), "n_name").alias("line")), folder)
    return spark.read.text(folder).withColumnRenamed("value", "line")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        link_inventory, page_links, raw_hrefs, tag_counts, content_root, noise_free_text, eligible_texts, serialized_pages, head_injection, preceding_text, duplicate_ids,
        roman_numbers, ordinal_words, line_hierarchy, act_structure, act_hierarchy, article_map, subpoint_map, chapter_map, article_map_json, first_wins, reverse_map,
        anchor_resolution, found_references, linked_pages, top_references, merged_chains, full_spans, chain_gates, canonical_hrefs, dangling_links, renamed_duplicates, href_delta,
        text_hashes, frozen_texts, pattern_delta, dictionary_links, longest_hint, stale_links, external_inventory, remapped_links, relinked_acts, link_sequences, cross_verification, coverage_ratios, page_coverage,
        note_texts, content_texts, broken_lines, link_neighbours, link_hosts, element_anchors, id_inventory, link_context, anchor_methods, synthetic_anchors, article_headings, point_anchors, written_points,
        part_map, chapter_sources, named_ids, heading_numbers, boundary_marks, first_articles, chunked_acts, discrepancy_log, tree_records, title_numbers, unit_words, unlinked_references, coverage_totals,
        claimed_verdicts, independent_checks, hinted_mismatches, named_acts, external_names, all_checks, canon_gates, retargeted_links, dropped_letters, odd_hrefs, meant_articles, phrase_places, phrase_pages,
        partial_phrases, overridden_pages, stale_phrases, strict_gates, registry_files, remap_file, map_files, phrase_file, override_file, preferred_forms, page_versions, chunk_lines, change_files, report_lines,
        linked_acts, swept_acts, act_sections, structured_pages, structured_markup, span_merges, merged_links, chained_links, span_gates, act_chunks,
        line_units, line_chunks, chunk_stats, sample_examples, act_events, link_verdicts,
    )
}

__all__ = ["QUERIES", "SQL"]
