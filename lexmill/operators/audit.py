"""Audits of links: coverage, correctness, independent verification, freshness, cross-document checks and gates.

Links without an href and texts that are null are not counted; documents without what is counted give no rows (gates
give a row for every document); empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.phrases import phrase_spans
from ..functions.sequences import aligned
from ..functions.text import IU, U, collapse
from ..sources import html
from ..sources.shared import bucketed
from .anchors import first_wins, heading_map, resolve, reverse_anchors
from .dom import around, attr, element_texts, first_inside, host, ids, in_scope, inside, inside_link, lines, links, preceding
from .references import ART, NUM
from .spans import ODD_HREF, SITE, dangling, doc_of, fragment_of, link_kind

#: Endings of an adjective in front of «кодекс», and of «конституция» (fixed values).
ADJECTIVE = ["им", "ым", "ого", "ому", "ом", "ой", "ий", "ый"]
CONSTITUTION = ["я", "и", "ю", "ей", "ею", "е"]
#: What counts as a reference in plain text, by class: an article with its number, this act, a code by its name, a law by its date or title, the constitution.
UNLINKED = {
    "article": rf"{IU}(?<![\p{{L}}]){ART}\s+{NUM}",
    "self": rf"{IU}(?<![\p{{L}}])настоящ\p{{L}}+\s+(?:кодекс|стать|закон)\p{{L}}*",
    "code": rf"{U}(?<![\p{{L}}])(?!Настоящ)[А-ЯЁ]\p{{L}}+(?:{'|'.join(ADJECTIVE)})\s+кодекс\p{{L}}*",
    "law": rf"{U}Закон\p{{L}}*\s+(?:Республики\s+Казахстан|РК)\s*(?:от\s+\d|[«\"„]\s*[А-ЯЁ])",
    "constitution": rf"{IU}(?<![\p{{L}}])конституци(?:{'|'.join(CONSTITUTION)})(?![\p{{L}}])",
}
#: Words near a reference that show an editor's remark (fixed values).
EDITORIAL = [
    "вводится в действие", "действует до", "в редакции", "Заголовок", "Сноска", "изложен", "исключен", "исключён", "дополнен", "внесен", "внесён", "предусматривается в редакции", "приостанов",
]
#: Characters before and after a reference in which they count, by class (fixed values).
AROUND = {"article": (45, 35), "law": (10, 45)}
TITLE_LINE = rf"{U}^\s*[СCϹ]тать[яиею]\s+{NUM}\s*\."
TITLE_NUMBER = rf"{U}^\s*[СCϹ]тать[яиею]\s+({NUM})\s*\."


def coverage(nodes: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """(doc_key, class, n): links in content by kind, and references in the plain text of articles by class."""
    linked = links(in_scope(nodes)).select("doc_key", F.concat(F.lit("linked:"), link_kind(F.col("href"))).alias("class"))
    counted = unlinked(nodes, patterns).select("doc_key", "class")
    return linked.unionByName(counted).groupBy("doc_key", "class").agg(F.count("*").alias("n"))


def class_totals(counts: DataFrame) -> DataFrame:
    """(class, n) over all documents, the commonest first, then the total (class null)."""
    total = counts.rollup("class").agg(F.sum("n").cast("long").alias("n"), F.grouping("class").alias("is_total"))
    return total.orderBy("is_total", F.desc("n"), "class").select("class", "n")


def unlinked(nodes: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """(doc_key, line, class, match, context, editorial): every reference in plain lines of articles, with what stands around it.

    Title lines are left out. An editor's remark is known by its words near the reference; a law's also needs a date.
    """
    inside = nodes.join(host(nodes).select("doc_key", "node_id"), ["doc_key", "node_id"], "left_semi")
    rows = lines(inside).where(~F.col("text").rlike(TITLE_LINE))
    found = []
    for name, pattern in (patterns or UNLINKED).items():
        left, right = AROUND.get(name, (45, 35))
        # What stands between the matches, so that every match has the text before and after it.
        each = rows.where(F.col("text").rlike(pattern)).select("doc_key", "line", F.split("text", pattern).alias("rest"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("hits"))
        each = each.select("doc_key", "line", "rest", "hits", F.posexplode("hits").alias("k", "match"))
        mixed = F.transform(F.sequence(F.lit(0), F.size("hits")), lambda i: F.concat(F.get("rest", i), F.coalesce(F.get("hits", i), F.lit(""))))
        head = F.concat(F.array_join(F.slice(mixed, F.lit(1), F.col("k")), ""), F.get("rest", F.col("k")))
        tail = F.array_join(F.slice(mixed, F.col("k") + 2, F.size("hits") + 1), "")
        around = F.concat(F.right(head, F.lit(left)), "match", F.left(tail, F.lit(right)))
        remark = reduce(lambda a, b: a | b, (around.contains(w) for w in EDITORIAL))
        if name == "law":
            remark = remark & F.col("match").rlike(r"от\s+\d")
        elif name == "article":
            remark = remark | F.concat("match", tail).rlike(rf"{IU}^стать[яиею]\s+{NUM}\s+(?:вводится|действует|приостан)")
        elif name not in AROUND:
            remark = F.lit(False)
        found.append(each.select("doc_key", "line", F.lit(name).alias("class"), "match", collapse(around).alias("context"), remark.alias("editorial")))
    return reduce(DataFrame.unionByName, found)


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def coverage_ratios(counts: DataFrame) -> DataFrame:
    """``counts`` (linked, open, generic, editorial) with cov_lit, cov_content and cov_real; 0 where nothing is."""
    c = lambda *names: sum((F.col(n) for n in names[1:]), F.col(names[0]))
    content = F.col("linked") + F.col("open") - F.col("generic")
    return counts.withColumn("cov_lit", ratio(F.col("linked"), c("linked", "open"))).withColumn("cov_content", ratio(F.col("linked"), content)).withColumn("cov_real", ratio(F.col("linked"), content - F.col("editorial")))


def events(nodes: DataFrame) -> DataFrame:
    """(doc_key, pos, kind, val) of article headings H, bodies B and anchors A in document order."""
    heads = element_texts(nodes, nodes.where(F.col("tag").isin("p", "h3")).select("doc_key", "node_id", "end_id"))
    number = F.nullif(F.regexp_extract("text_sp", rf"{U}^\s*Статья\s+({NUM})", 1), F.lit(""))
    rows = heads.select("doc_key", F.col("node_id").alias("pos"), F.when(number.isNotNull(), "H").otherwise("B").alias("kind"), number.alias("val")).where(F.col("val").isNotNull() | (F.length("text_sp") > 0))
    marks = nodes.where("kind = 'element'").select("doc_key", F.col("node_id").alias("pos"), F.explode(F.array_distinct(F.array_compact(F.array(attr("id"), attr("name"))))).alias("val"))
    # An anchor inside a heading is asked as if it stood just before it.
    return rows.select("doc_key", (F.col("pos") * 2 + 1).alias("pos"), "kind", "val").unionByName(marks.select("doc_key", (F.col("pos") * 2).alias("pos"), F.lit("A").alias("kind"), "val"))


def claimed(text: Column, prev: Column) -> Column:
    """Struct (kind, number) of what a link says it points to: ARTICLE N, SELF or NONART.

    A bare number is an article's behind that word (or a list that begins with it); behind «настоящей статьи» it is this one.
    """
    n = F.nullif(F.regexp_extract(text, rf"{IU}{ART}\s+({NUM})", 1), F.lit(""))
    own = rf"{IU}настоящ\p{{L}}+\s+стать"
    bare = F.when(prev.rlike(rf"{IU}{ART}\s*(?:{NUM}\s*[,и]\s*)*$"), F.nullif(F.regexp_extract(text, rf"^\s*({NUM})\s*$", 1), F.lit("")))
    kind = F.when(text.rlike(own), "SELF").when(n.isNotNull(), "ARTICLE").when(F.right(prev, F.lit(25)).rlike(own) & ~F.lower(text).contains("стать"), "SELF").when(bare.isNotNull(), "ARTICLE").otherwise("NONART")
    return F.struct(kind.alias("kind"), F.when(kind == "ARTICLE", F.coalesce(n, bare)).alias("number"))


def own_article(nodes: DataFrame) -> DataFrame:
    """(doc_key, node_id, host_number) of the links in content: the number of the article that they stand in, null outside articles."""
    typed = (F.col("tag") == "div") & attr("data-type").isNotNull()
    titles = element_texts(nodes, nodes.where(F.col("tag").isin("h2", "h3", "h4", "p")).select("doc_key", "node_id", "end_id"))
    number = F.nullif(F.regexp_extract("text_sp", TITLE_NUMBER, 1), F.lit(""))
    titles = titles.select("doc_key", "node_id", number.alias("title")).where("title is not null")
    seen = nodes.join(titles, ["doc_key", "node_id"], "left").withColumn("first", first_inside(F.col("title").isNotNull(), F.col("title"))).withColumn("scope", inside(typed))
    articles = seen.where(typed & (attr("data-type") == "статья")).select("doc_key", "node_id", "end_id", F.coalesce("first", attr("data-number")).alias("number"))
    asked = seen.where("tag = 'a' and scope").select("doc_key", "node_id")
    return asked.join(around(nodes, asked, articles, nearest=True).select("doc_key", "node_id", F.col("mark.number").alias("host_number")), ["doc_key", "node_id"], "left")


def correctness(nodes: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """(doc_key, node_id, href, text, kind, claimed, article, verdict, inherited) of the content's internal links to a ``z`` anchor.

    Links outside the divs with data-type, and those to other fragments, don't count. A link's own article is the first
    title inside its article div, without one the div's data-number.

    BROKEN: no such id; SELF_OK / SELF_WRONG; OK, WRONG_TARGET or WRONG_SUB for a claimed article (a range counts by
    its start if the dashed number is no article here); NONART otherwise. ``source`` (doc_key, href) tells which came
    with the source.
    """
    anchor = F.nullif(F.regexp_extract("href", r"#(z\d+[\w-]*)", 1), F.lit(""))
    rows = links(nodes).where(link_kind(F.col("href")) == "internal").withColumn("id", anchor).where("id is not null").join(own_article(nodes), ["doc_key", "node_id"]).join(preceding(nodes), ["doc_key", "node_id"], "left")
    rows = bucketed(rows.withColumn("c", claimed(F.col("text"), F.coalesce("prev_text", F.lit("")))), "claims", "doc_key", "id")
    there = ids(nodes).withColumn("there", F.lit(True))
    marks = bucketed(events(nodes), "marks", "doc_key", "pos")
    resolved = first_wins(resolve(marks), ["doc_key", "id"], ["pos"]).select("doc_key", "id", "article", "next_article")
    known = marks.where("kind = 'H'").select("doc_key", F.col("val").alias("number")).distinct().withColumn("known", F.lit(True))
    rows = rows.join(there, ["doc_key", "id"], "left").join(resolved, ["doc_key", "id"], "left").withColumn("number", F.col("c.number")).join(known, ["doc_key", "number"], "left")
    near = F.array_compact(F.array("article", "next_article"))
    n = F.when(F.col("number").contains("-") & F.col("known").isNull(), F.split("number", "-")[0]).otherwise(F.col("number"))
    article = F.when(F.array_contains(near, n), "OK").when(n.contains("-"), "WRONG_SUB").otherwise("WRONG_TARGET")
    verdict = F.when(F.col("there").isNull(), "BROKEN").when(F.col("c.kind") == "SELF", F.when(F.array_contains(near, F.coalesce("host_number", F.lit(""))), "SELF_OK").otherwise("SELF_WRONG")).when(F.col("c.kind") == "ARTICLE", article).otherwise("NONART")
    out = rows.select("doc_key", "node_id", "href", "text", F.col("c.kind").alias("kind"), F.col("number").alias("claimed"), "article", verdict.alias("verdict"), "id")
    if source is None:
        return out.withColumn("inherited", F.lit(False)).drop("id")
    old = source.select("doc_key", fragment_of(F.col("href")).alias("id")).where("id is not null").distinct().withColumn("inherited", F.lit(True))
    return out.join(old, ["doc_key", "id"], "left").withColumn("inherited", F.coalesce("inherited", F.lit(False))).drop("id")


def longest_hint(rows: DataFrame, hints: DataFrame, text: str = "text", key: str = "id") -> DataFrame:
    """For each row the longest hint that its text contains, with what it stands for: (key, hint, expected).

    ``hints`` (hint, expected) may have any size. Of equally long hints the one that sorts last is taken.
    """
    found = phrase_spans(rows.select(key, text), hints.select(F.col("hint").alias("phrase"), F.col("expected").alias("value")), text, words=False).where(F.size("spans") > 0)
    best = F.array_max(F.transform("spans", lambda x: F.struct(F.length(x["phrase"]).alias("n"), x["phrase"].alias("hint"), x["value"].alias("expected"))))
    return found.select(key, best.alias("b")).select(key, "b.hint", "b.expected")


def hinted_mismatches(nodes: DataFrame, hints: DataFrame, known: DataFrame) -> DataFrame:
    """Links of content to an act of ``known`` (doc_id) whose name says another: (doc_key, node_id, hint, expected, actual).

    The name is the link's text, with what stands before it if the text is only a number or signs.
    """
    rows = links(in_scope(nodes)).where(link_kind(F.col("href")) == "external").join(preceding(nodes), ["doc_key", "node_id"], "left")
    bare = F.col("text").rlike(r"^[\s\d).,;№-]*$")
    name = F.when(bare, F.concat_ws(" ", "prev_text", "text")).otherwise(F.col("text"))
    rows = rows.select("doc_key", "node_id", doc_of(F.col("href")).alias("actual"), name.alias("name")).join(known.select(F.col("doc_id").alias("actual")).distinct(), "actual", "left_semi").withColumn("key", F.struct("doc_key", "node_id", "actual"))
    best = longest_hint(rows.withColumnRenamed("name", "said"), hints, "said", "key")
    return best.select("key.doc_key", "key.node_id", "hint", "expected", "key.actual").where("actual <> expected")


#: One rule: words that must all stand in a name (one list an alternative), and the acts that it may mean.
NameRule = tuple[list[list[str]], list[str]]


def named_acts(text: Column, rules: list[NameRule]) -> Column:
    """The acts a text names by the first rule that matches, null if none does; the caller's table of rules is part of the plan."""
    low, out = F.lower(text), F.lit(None).cast("array<string>")
    for alternatives, docs in reversed(rules):
        hit = reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (low.contains(w) for w in words)) for words in alternatives))
        out = F.when(hit, F.array(*map(F.lit, docs))).otherwise(out)
    return out


def external_mismatches(rows: DataFrame, known: DataFrame, rules: list[NameRule]) -> DataFrame:
    """Links to an act of ``known`` (doc_id) that their text doesn't name; rows: doc_key, href, text."""
    bare = lambda c: F.rtrim(c, F.lit("_"))
    got = rows.withColumn("actual", bare(doc_of(F.col("href")))).withColumn("expected", named_acts(F.col("text"), rules)).where("actual is not null and expected is not null")
    return got.join(known.select(bare(F.col("doc_id")).alias("actual")).distinct(), "actual", "left_semi").where(~F.array_contains("expected", F.col("actual")))


def independent(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Internal links against ``anchors.heading_map``: match, range_base, boundary, mismatch, unresolved.

    ``edges`` (doc_key, id, number) are articles that begin shortly after an anchor (``anchors.boundary``).
    """
    rows = links(nodes).where(F.col("href").startswith("#")).withColumn("id", fragment_of(F.col("href"))).withColumn("n", F.nullif(F.regexp_extract("text", rf"{IU}{ART}\s+({NUM})", 1), F.lit(""))).where("n is not null")
    target = heading_map(nodes).withColumnRenamed("number", "target")
    rows = rows.join(target, ["doc_key", "id"], "left").join(edges.groupBy("doc_key", "id").agg(F.min("number").alias("edge")), ["doc_key", "id"], "left")
    base = F.split("n", "-")[0]
    verdict = F.when(F.col("target").isNull(), "unresolved").when(F.col("target") == F.col("n"), "match").when(F.col("n").contains("-") & (F.col("target") == base), "range_base").when(F.col("edge").isin(F.col("n"), base), "boundary").otherwise("mismatch")
    return rows.select("doc_key", "node_id", "href", "text", "n", "target", verdict.alias("verdict"))


#: Plural forms, behind which a list of linked numbers is right (fixed values).
PLURAL = ["статьями", "статьях", "статей"]
ARCHIVED = r"/archive/|\?|\b\d{2}\.\d{2}\.\d{4}\b|/\d{8}/|[?&]ver="


def six_checks(nodes: DataFrame, own: DataFrame | None = None, site: str = SITE, chrome: list[str] | None = None) -> DataFrame:
    """(doc_key, check, n, contexts): what is wrong with a document's links, up to three contexts each.

    unparsed: no element; nested: a link in a link; empty: no target; split: a singular «статья» in front of a linked
    number; archive: another act's dated or archived form; dangling: a #z target that isn't there. Not defects, but
    counted: list (a plural in front of a linked number), own (full links to the act itself), odd (other forms of another
    act's link), elsewhere (links to no act). Links in the tags of ``chrome`` are not counted as empty. ``own`` (doc_key,
    own) names each document's act. Documents without any give no rows.
    """
    all_links = links(nodes)
    up = nodes.where("tag = 'a'").select("doc_key", "node_id", "parent_id", "sib_pos", "tags", attr("href").alias("href"))
    said = up.join(all_links.select("doc_key", "node_id", "text"), ["doc_key", "node_id"], "left").withColumn("text", F.coalesce("text", F.lit("")))
    href = F.trim("href")
    nested = said.where(F.array_contains("tags", "a")).select("doc_key", F.lit("nested").alias("check"), "text")
    empty = said.where(~F.arrays_overlap("tags", F.array(*map(F.lit, chrome or ["nav"]))) & href.isin("", "#")).select("doc_key", F.lit("empty").alias("check"), "text")
    w = Window.partitionBy("doc_key", "parent_id").orderBy("sib_pos")
    word = F.nullif(F.regexp_extract("text", rf"{IU}(стать\w+)\s+$", 1), F.lit(""))
    fore = nodes.withColumn("next", F.lead(F.when(F.col("tag") == "a", F.col("node_id"))).over(w)).where("kind = 'text'").select("doc_key", F.col("next").alias("node_id"), word.alias("word")).where("word is not null and node_id is not null")
    split = fore.join(all_links.where(F.col("text").rlike(r"^\d")), ["doc_key", "node_id"]).select("doc_key", F.when(F.lower("word").isin(PLURAL), "list").otherwise("split").alias("check"), F.concat_ws(" ", "word", "text").alias("text"))
    full = all_links.where(F.trim("href").startswith("http"))
    full = full.join(own, "doc_key", "left") if own is not None else full.withColumn("own", F.lit(None).cast("string"))
    doc = F.nullif(F.regexp_extract("href", r"/docs/([A-Z][A-Z0-9]*)_?", 1), F.lit(""))
    at_site = F.col("href").startswith(site)
    right = F.col("href").rlike(r"/docs/[A-Z][A-Z0-9]{4,}_?(?:#z[\w.-]+)?$") & at_site
    kind = F.when(~at_site | doc.isNull(), "elsewhere").when(F.rtrim(doc, F.lit("_")) == F.rtrim(F.coalesce("own", F.lit("")), F.lit("_")), "own").when(F.col("href").rlike(ARCHIVED), "archive").otherwise("odd")
    others = full.where(~right).select("doc_key", kind.alias("check"), F.col("href").alias("text"))
    lost = dangling(all_links.where(F.col("href").rlike(r"^#z[\w.-]+$")), ids(nodes)).select("doc_key", F.lit("dangling").alias("check"), F.col("href").alias("text"))
    unparsed = nodes.groupBy("doc_key").agg(F.count_if(F.col("kind") == "element").alias("k")).where("k = 0").select("doc_key", F.lit("unparsed").alias("check"), F.lit("").alias("text"))
    rows = nested.union(empty).union(split).union(others).union(lost).union(unparsed)
    k = F.row_number().over(Window.partitionBy("doc_key", "check").orderBy("text"))
    return rows.withColumn("k", k).groupBy("doc_key", "check").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("k") <= 3, F.col("text")))).alias("contexts"))


def pattern_delta(old: DataFrame, new: DataFrame, pattern: str, text: str = "html") -> DataFrame:
    """(doc_key, old_n, new_n): how often a pattern stands in a document and in its backup."""
    count = lambda df, n: df.select("doc_key", F.regexp_count(text, F.lit(pattern)).alias(n))
    return count(old, "old_n").join(count(new, "new_n"), "doc_key")


def frozen(old: DataFrame, new: DataFrame) -> DataFrame:
    """(doc_key, same): whether a document's text is what it was; both: doc_key, sha."""
    return old.withColumnRenamed("sha", "was").join(new, "doc_key", "full").select("doc_key", F.coalesce(F.col("was") == F.col("sha"), F.lit(False)).alias("same"))


# Freshness


def stale_phrases(phrases: DataFrame, status: DataFrame) -> DataFrame:
    """Dictionary rows that point to an act with a newer one; status: doc_id, status, candidate."""
    return phrases.join(status, "doc_id").select("phrase", "doc_id", "status", "candidate")


def stale_links(hrefs: DataFrame, status: DataFrame) -> DataFrame:
    """(doc_id, status, candidate, kind, n): links to such acts, root or to an article."""
    rows = hrefs.withColumn("doc_id", doc_of(F.col("href"))).withColumn("kind", F.when(fragment_of(F.col("href")).isNotNull(), "art").otherwise("root"))
    return rows.join(status, "doc_id").groupBy("doc_id", "status", "candidate", "kind").agg(F.count("*").alias("n"))


def inventory(hrefs: DataFrame, own: DataFrame) -> DataFrame:
    """(doc_id, n) of the acts linked to that are none of ``own`` (doc_id), the commonest first."""
    rows = hrefs.withColumn("doc_id", doc_of(F.col("href"))).where("doc_id is not null").join(own.select("doc_id"), "doc_id", "left_anti")
    return rows.groupBy("doc_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "doc_id")


def strict_gate(stale: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row, ok: false if a root link or a dictionary row is stale."""
    a = stale.where("kind = 'root' and status = 'confirmed'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("links"))
    b = mapping.where("status = 'confirmed'").agg(F.count("*").alias("rows"))
    return a.join(b, F.lit(True)).select("links", "rows", ((F.col("links") == 0) & (F.col("rows") == 0)).alias("ok"))  # two single rows


# Across documents


def candidates(text: Column, prev: Column) -> Column:
    """Articles a link may mean: a bare number, numbers behind «статья» in its text or in the 80 characters before."""
    bare = F.nullif(F.regexp_extract(text, rf"^\s*({NUM})\s*$", 1), F.lit(""))
    behind = lambda c: F.regexp_extract_all(c, F.lit(rf"{IU}{ART}\s+({NUM})"), 1)
    return F.array_distinct(F.concat(F.array_compact(F.array(bare)), behind(text), behind(F.right(F.coalesce(prev, F.lit("")), F.lit(80)))))


def cross_verify(rows: DataFrame, registry: DataFrame, articles: DataFrame, subpoints: DataFrame, own: bool = False) -> DataFrame:
    """``rows`` (doc_key = code, href, text, prev_text) with target, article and verdict.

    NO_MAP: the act has no maps; UNRESOLVED: not this anchor; NO_ART_TEXT: the text names no article; OK; MISMATCH.
    Links to acts outside ``registry`` (code, doc_id) are left out, and those to the own act unless ``own``.
    """
    acts = registry.select(F.rtrim("doc_id", F.lit("_")).alias("target_id"), F.col("code").alias("target"))
    got = rows.withColumn("target_id", F.rtrim(doc_of(F.col("href")), F.lit("_"))).withColumn("anchor", fragment_of(F.col("href"))).where("anchor is not null").join(acts, "target_id")
    got = got if own else got.where("target <> doc_key")
    back = reverse_anchors(articles, subpoints).withColumnRenamed("code", "target")
    mapped = articles.select(F.col("code").alias("target")).distinct().withColumn("mapped", F.lit(True))
    got = got.join(mapped, "target", "left").join(back, ["target", "anchor"], "left").withColumn("may_mean", candidates(F.col("text"), F.col("prev_text")))
    verdict = F.when(F.col("mapped").isNull(), "NO_MAP").when(F.col("article").isNull(), "UNRESOLVED").when(F.size("may_mean") == 0, "NO_ART_TEXT").when(F.array_contains("may_mean", F.col("article")), "OK").otherwise("MISMATCH")
    return got.select("doc_key", "target", "anchor", "text", "article", "may_mean", verdict.alias("verdict"))


_CHANGES = "array<struct<kind:string,old_at:int,new_at:int>>"


def sequence_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(doc_key, kind, old_ord, new_ord, old_href, new_href, text) of what differs between two forms' links (doc_key, ord, href, text).

    Links that both have, in the same order, are a longest common subsequence; between its members equal texts with
    another target are ``retarget``, the rest is ``only_old`` or ``only_new``. A document's own links are gathered once for each form.
    """
    own = lambda df, name: df.groupBy("doc_key").agg(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("href", F.lit("")).alias("href"), F.coalesce("text", F.lit("")).alias("text")))).alias(name))
    both = own(old, "old").join(own(new, "new"), "doc_key", "full")

    def changes(old: pd.Series, new: pd.Series) -> pd.Series:
        links = lambda own: [(x["href"], x["text"]) for x in own] if own is not None else []
        return pd.Series([[dict(zip(("kind", "old_at", "new_at"), c, strict=True)) for c in aligned(links(a), links(b))] for a, b in zip(old, new, strict=True)])

    each = both.withColumn("changes", F.pandas_udf(changes, _CHANGES)("old", "new")).select("doc_key", "old", "new", F.explode("changes").alias("c"))
    was, is_ = F.get("old", F.col("c.old_at")), F.get("new", F.col("c.new_at"))
    return each.select("doc_key", "c.kind", was["ord"].alias("old_ord"), is_["ord"].alias("new_ord"), was["href"].alias("old_href"), is_["href"].alias("new_href"), F.coalesce(was["text"], is_["text"]).alias("text"))


def round_robin(rows: DataFrame, kind: str, order: list[str], n: int = 20) -> DataFrame:
    """``n`` examples that take turns over the kinds: the first of each, then the second, ..."""
    k = F.row_number().over(Window.partitionBy(kind).orderBy(*order))
    return rows.withColumn("turn", k).where(F.col("turn") <= n).orderBy("turn", kind).limit(n)


_SUM = "decimal(38,0)"


def _hashes(hrefs: Column, seed: int) -> Column:
    return F.aggregate(hrefs, F.lit(0).cast(_SUM), lambda acc, h: (acc + F.xxhash64(F.lit(seed), h)).cast(_SUM))


def _hung(marks: Column) -> Column:
    """How many own links of a document have no target; marks: (id, asks), sorted, so that a target stands in front of the links to it."""
    state = lambda id_, n: F.named_struct(F.lit("id"), id_.cast("string"), F.lit("n"), n.cast("bigint"))
    step = lambda acc, m: F.when(m["asks"], state(acc["id"], acc["n"] + F.when(acc["id"].eqNullSafe(m["id"]), 0).otherwise(1))).otherwise(state(m["id"], acc["n"]))
    return F.aggregate(marks, state(F.lit(None), F.lit(0)), step, lambda acc: acc["n"])


def profiled(nodes: DataFrame, pages: bool = False) -> DataFrame:
    """What ``gates`` compare, one row a document: (doc_key, sha, nested, hung, n, sum1, sum2), with ``pages`` also html, the page.

    It is gathered from the pieces that make the page, in one pass and with the page itself, from nodes as they are or
    with columns ``render``, ``lead`` and ``tail``: what is written needn't be parsed to be judged. sha is that of the
    text (white space collapsed), nested the links inside links, hung the own links without a target; the multiset of
    hrefs is told by its size and two sums of different 64-bit hashes.
    """
    here = lambda a, href, id_, name: F.named_struct(F.lit("a"), a, F.lit("href"), href, F.lit("id"), id_, F.lit("name"), name)
    own = F.when(F.col("kind") == "element", F.array(here(F.col("tag") == "a", attr("href"), attr("id"), attr("name"))))
    if "render" in nodes.columns:
        starts = F.filter(F.regexp_extract_all("render", F.lit("<[^>]*>"), F.lit(0)), lambda t: ~t.startswith("</"))
        value = lambda t, name: F.when(t.rlike(rf'\s{name}="'), html.unescape(F.regexp_extract(t, rf'\s{name}="([^"]*)"', 1)))
        own = F.coalesce(F.transform(starts, lambda t: here(t.rlike(r"^<a[\s>]"), value(t, "href"), value(t, "id"), value(t, "name"))), own)
    # What an element's start says counts once, with its first piece.
    each = nodes.select("doc_key", inside_link().alias("in_a"), own.alias("own"), F.explode(html.pieces(nodes)).alias("p")).withColumn("own", F.when(F.col("p.b") == 0, F.col("own")))
    each = each.withColumn("hrefs", F.array_compact(F.transform("own", lambda x: F.when(x["a"], x["href"]))))
    mark = lambda id_, asks: F.named_struct(F.lit("id"), id_, F.lit("asks"), F.lit(asks))
    targets = F.transform(F.array_compact(F.flatten(F.transform("own", lambda x: F.array(x["id"], x["name"])))), lambda i: mark(i, False))
    asked = F.transform(F.filter("hrefs", lambda h: h.startswith("#") & (F.length(h) > 1)), lambda h: mark(F.substring(h, 2, 1 << 20), True))
    marks = F.concat(targets, asked)
    page = [html.in_order("p", "s").alias("html")] if pages else []
    return each.groupBy("doc_key").agg(
        F.sha2(collapse(html.in_order("p", "t")), 256).alias("sha"), F.coalesce(F.sum(F.when(F.col("in_a"), F.size(F.filter("own", lambda x: x["a"])))), F.lit(0)).alias("nested"),
        _hung(F.array_sort(F.flatten(F.collect_list(F.when(F.size(marks) > 0, marks))))).alias("hung"), F.coalesce(F.sum(F.size("hrefs")), F.lit(0)).alias("n"),
        *(F.coalesce(F.sum(_hashes(F.col("hrefs"), k)), F.lit(0)).cast(_SUM).alias(f"sum{k}") for k in (1, 2)), *page,
    )


def compared(old: DataFrame, new: DataFrame, dropped: DataFrame | None = None, added: DataFrame | None = None) -> DataFrame:
    """(doc_key, gate, ok) of two forms' ``profiled`` rows, one row a document each: nothing but these narrow rows is joined.

    text: the same text; nested: no link inside a link; dangling: no more own links without a target; hrefs: the new
    hrefs are the old ones without ``dropped`` and with ``added`` (doc_key and an array of that name), as multisets. A
    document that only one form has counts as one without text and links in the other.
    """
    counts = ["n", "sum1", "sum2"]

    def logged(log: DataFrame | None, name: str) -> DataFrame | None:
        if log is None:
            return None
        own = F.array_compact(F.col(name))
        rows = log.select("doc_key", F.size(own).cast(_SUM).alias("n"), _hashes(own, 1).alias("sum1"), _hashes(own, 2).alias("sum2"))
        return rows.groupBy("doc_key").agg(F.struct(*(F.sum(c).cast(_SUM).alias(c) for c in counts)).alias(name))

    of = lambda df, name: df.select("doc_key", F.struct(*(c for c in df.columns if c not in ("doc_key", "html"))).alias(name))
    both = of(old, "old").join(of(new, "new"), "doc_key", "full")
    for log, name in ((dropped, "dropped"), (added, "added")):
        log = logged(log, name)
        both = both.withColumn(name, F.lit(None).cast(f"struct<n:{_SUM},sum1:{_SUM},sum2:{_SUM}>")) if log is None else both.join(log, "doc_key", "left")
    zero = lambda c: F.coalesce(F.col(c).cast(_SUM), F.lit(0).cast(_SUM))
    same = [zero(f"old.{c}") + zero(f"added.{c}") == zero(f"new.{c}") + zero(f"dropped.{c}") for c in counts]
    none = F.sha2(F.lit(""), 256)
    told = {
        "text": F.coalesce("old.sha", none) == F.coalesce("new.sha", none), "nested": zero("new.nested") == 0,
        "dangling": zero("new.hung") <= zero("old.hung"), "hrefs": reduce(lambda a, b: a & b, same),
    }
    each = F.array(*(F.struct(F.lit(gate).alias("gate"), ok.alias("ok")) for gate, ok in told.items()))
    return both.select("doc_key", F.explode(each).alias("g")).select("doc_key", "g.gate", "g.ok")


def gates(before_: DataFrame, after: DataFrame, dropped: DataFrame | None = None, added: DataFrame | None = None) -> DataFrame:
    """``compared`` of two node tables: an edit keeps the text, nests no link, leaves none dangling, and its hrefs are as logged."""
    return compared(profiled(before_), profiled(after), dropped, added)
