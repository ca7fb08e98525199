"""Projections and predicates over the node table. Rows of a document are only ever joined or windowed by doc_key.

What is inside what follows from the nodes' intervals, which nest: whether something is around a node is a running
maximum of ends, what comes first inside an element is the next one if it isn't beyond the end, and the elements around
a node are a stack that two windows carry (``around``). No row is multiplied by its depth.

Null texts and attributes meet no predicate; documents without what is asked for give no rows; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.text import U, blank, collapse
from ..sources.shared import bucketed

#: Tags that are no content, tags whose texts are never linked, headings, tags that break a line (fixed values).
NOISE = ["script", "style", "template", "veepn-lock-screen"]
SKIPPED = ["a", "script", "style", "head", "title"]
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
BREAKS = ["br", "p", "div", "li", "tr", "td", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article"]
ARTICLE_START = rf"{U}^\s*Статья\s+\d"
#: Signs of an editor's note: in a text, at its begin, in a red font (fixed values).
NOTE, NOTE_BEGINS, NOTE_RED = r"Сноска[. ]|Примечание\.", "Примечани", "Примечание (?:ИЗПИ|РЦПИ)"


def attr(name: str, attrs: str = "attrs") -> Column:
    return F.element_at(F.col(attrs), name)


def _tags_any(tags: list[str]) -> Column:
    return F.arrays_overlap(F.col("tags"), F.array(*map(F.lit, tags)))


def _earlier(order: str = "node_id") -> WindowSpec:
    """The rows of a document in front of a row."""
    return Window.partitionBy("doc_key").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _later(order: str = "node_id") -> WindowSpec:
    """The rows of a document behind a row, the last one first: ``last`` over them gives the next. A frame that grows is linear, one that shrinks is not."""
    return Window.partitionBy("doc_key").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)


def upcoming(value: Column, order: str = "node_id") -> Column:
    """The next value behind a row of its document that isn't null."""
    return F.last(value, True).over(_later(order))


def inside(condition: Column) -> Column:
    """Whether a row of a whole node table stands inside an element that meets ``condition``."""
    return F.coalesce(F.max(F.when(condition, F.col("end_id"))).over(_earlier()) >= F.col("node_id"), F.lit(False))


def first_inside(condition: Column, value: Column) -> Column:
    """``value`` of the first node inside a row of a whole node table that meets ``condition``."""
    following = upcoming(F.when(condition, F.struct(F.col("node_id").alias("at"), value.alias("v"))))
    return F.when(following["at"] <= F.col("end_id"), following["v"])


def around(nodes: DataFrame, asking: DataFrame, marks: DataFrame, nearest: bool = False) -> DataFrame:
    """``asking`` (doc_key, node_id, …) with ``mark``: a row for each row of ``marks`` (doc_key, node_id, end_id, …) around a node, or the nearest one's only.

    Both name nodes of ``nodes``, each at most once. Begins and ends of marks in document order give the number of open
    ones; the last one that was opened at a level is open wherever the level is reached again. Nodes with nothing around
    them have no row. Both are joined to the nodes, not united: a union would forget that they are partitioned by document.
    """
    own = lambda df, name: df.select("doc_key", "node_id", F.struct(*(c for c in df.columns if c != "doc_key")).alias(name))
    key = ["doc_key", "node_id"]
    met = nodes.select(*key).join(own(asking, "row"), key, "left").join(own(marks, "mark"), key, "left").where("row is not null or mark is not null")
    none = lambda name: F.lit(None).cast(met.schema[name].dataType).alias(name)
    event = lambda at, phase, step, row, mark: F.struct(at.alias("at"), F.lit(phase).alias("phase"), F.lit(step).alias("step"), row, mark)
    ask = F.when(F.col("row").isNotNull(), event(F.col("node_id"), 0, 0, F.col("row"), none("mark")))
    begin = F.when(F.col("mark").isNotNull(), event(F.col("node_id"), 1, 1, none("row"), F.col("mark")))
    end = F.when(F.col("mark").isNotNull(), event(F.col("mark.end_id"), 2, -1, none("row"), none("mark")))
    w = Window.partitionBy("doc_key").orderBy("at", "phase").rowsBetween(Window.unboundedPreceding, -1)
    events = met.select("doc_key", F.explode(F.array_compact(F.array(ask, begin, end))).alias("e")).select("doc_key", "e.*").withColumn("level", F.coalesce(F.sum("step").over(w), F.lit(0)))
    open_ = F.array("level") if nearest else F.sequence(F.lit(1).cast("bigint"), F.greatest("level", F.lit(1)))
    levels = F.when(F.col("phase") == 1, F.array(F.col("level") + 1)).when((F.col("phase") == 0) & (F.col("level") > 0), open_)
    dealt = events.select("doc_key", "at", "phase", "row", "mark", F.explode(levels).alias("level"))
    w = Window.partitionBy("doc_key", "level").orderBy("at", "phase").rowsBetween(Window.unboundedPreceding, 0)
    return dealt.withColumn("mark", F.last("mark", True).over(w)).where("phase = 0").select("doc_key", "row.*", "mark")


def without_noise(nodes: DataFrame) -> DataFrame:
    """Nodes that are no script, style, template or lock screen and are in none."""
    return nodes.where(~_tags_any(NOISE) & ~F.coalesce(F.col("tag").isin(NOISE), F.lit(False)))


def inside_link() -> Column:
    return F.array_contains("tags", "a")


def eligible_text(least: int = 3) -> Column:
    """Text nodes with at least ``least`` characters outside links, scripts, styles, head and title."""
    return (F.col("kind") == "text") & (F.length(collapse(F.col("text"))) >= least) & ~_tags_any(SKIPPED)


def heading_texts(nodes: DataFrame) -> DataFrame:
    """(doc_key, node_id) of the texts in a heading tag, or in bold text with an anchor or that begins like an article's heading.

    Bold text counts only inside the text's own block.
    """
    texts = nodes.where("kind = 'text'")
    named = (F.col("tag") == "a") & (attr("name").isNotNull() | attr("id").isNotNull())
    bold = nodes.withColumn("anchored", first_inside(named, F.lit(True))).where("tag = 'b'").select("doc_key", "node_id", "end_id", "anchored")
    marks = element_texts(nodes, bold, ["b"]).where(F.col("anchored") | F.col("text_sp").rlike(ARTICLE_START)).select("doc_key", "node_id", "end_id")
    said = around(nodes, texts.where(F.array_contains("tags", "b")).select("doc_key", "node_id", "block_id"), marks, nearest=True).where("mark.node_id > block_id").select("doc_key", "node_id")
    return texts.where(_tags_any(HEADINGS)).select("doc_key", "node_id").union(said).distinct()


def element_texts(nodes: DataFrame, wanted: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """``wanted`` (doc_key, node_id of elements) with text_raw (all text as it is) and text_sp (stripped pieces joined by blanks).

    Where the elements' ``tags`` are given, only texts inside such tags are looked at. ``wanted`` may have end_id; without
    it the nodes are asked.
    """
    texts = nodes.where("kind = 'text'")
    if tags is not None:
        texts = texts.where(_tags_any(tags))
    if "end_id" in wanted.columns:
        marks = wanted.select("doc_key", "node_id", "end_id").distinct()
    else:
        marks = nodes.where("kind = 'element'").select("doc_key", "node_id", "end_id").join(wanted.select("doc_key", "node_id"), ["doc_key", "node_id"], "left_semi")
    met = around(nodes, texts.select("doc_key", "node_id", "text"), marks)
    got = met.groupBy("doc_key", F.col("mark.node_id").alias("of")).agg(F.array_sort(F.collect_list(F.struct("node_id", "text"))).alias("ts"))
    raw = F.array_join(F.transform("ts", lambda t: t["text"]), "")
    sp = F.array_join(F.filter(F.transform("ts", lambda t: F.regexp_replace(t["text"], rf"{U}^\s+|\s+$", "")), lambda t: t != ""), " ")
    got = got.select("doc_key", F.col("of").alias("node_id"), raw.alias("text_raw"), sp.alias("text_sp"))
    return wanted.join(got, ["doc_key", "node_id"], "left").fillna("", ["text_raw", "text_sp"])


def content_root(nodes: DataFrame) -> DataFrame:
    """(doc_key, node_id) of the article element with the longest text; the first of equals. Lengths are summed, no text is gathered."""
    articles = nodes.where("kind = 'element' and tag = 'article'").select("doc_key", "node_id", "end_id")
    texts = nodes.where("kind = 'text'").where(_tags_any(["article"])).select("doc_key", "node_id", F.length("text").alias("n"))
    said = around(nodes, texts, articles).groupBy("doc_key", F.col("mark.node_id").alias("node_id")).agg(F.sum("n").alias("n"))
    found = articles.select("doc_key", "node_id").join(said, ["doc_key", "node_id"], "left")
    best = found.groupBy("doc_key").agg(F.max(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.col("node_id")).alias("k"))).alias("b"))
    return best.select("doc_key", (-F.col("b.k")).alias("node_id"))


def host(nodes: DataFrame, kind: str | None = "статья") -> DataFrame:
    """(doc_key, node_id, host, host_number) of nodes in a div with data-type: the nearest one (of that ``kind``)."""
    condition = (F.col("tag") == "div") & (attr("data-type").isNotNull() if kind is None else attr("data-type") == kind)
    marks = nodes.where(condition).select("doc_key", "node_id", "end_id", attr("data-number").alias("number"))
    found = around(nodes, nodes.select("doc_key", "node_id"), marks, nearest=True)
    return found.select("doc_key", "node_id", F.col("mark.node_id").alias("host"), F.col("mark.number").alias("host_number"))


def in_scope(nodes: DataFrame) -> DataFrame:
    """The nodes inside some div with data-type."""
    return nodes.withColumn("__in", inside((F.col("tag") == "div") & attr("data-type").isNotNull())).where("__in").drop("__in")


def in_note(nodes: DataFrame, wide: bool = True, block: int = 2000) -> DataFrame:
    """(doc_key, node_id) of texts in editors' notes.

    Narrow: in ``span.note``, or in a red font that says so. Wide also: own text like a note's, an earlier sibling that
    holds such a text, or a parent (no article, body or div) of under ``block`` characters that does or begins like one.
    """
    texts = nodes.where("kind = 'text'")
    span = (F.col("tag") == "span") & F.array_contains(F.split(F.coalesce(attr("class"), F.lit("")), r"\s+"), "note")
    red = nodes.where((F.col("tag") == "font") & (F.upper(F.ltrim(F.trim(F.coalesce(attr("color"), F.lit(""))), F.lit("#"))) == "FF0000")).select("doc_key", "node_id", "end_id")
    red = element_texts(nodes, red, ["font"]).where(F.col("text_raw").rlike(NOTE_RED)).select("doc_key", "node_id", "end_id")
    marked = nodes.where(span).select("doc_key", "node_id", "end_id").union(red)
    narrow = around(nodes, texts.where(_tags_any(["span", "font"])).select("doc_key", "node_id"), marked, nearest=True).select("doc_key", "node_id")
    if not wide:
        return narrow
    sign = (F.col("kind") == "text") & (F.col("text").rlike(NOTE) | F.left(F.trim("text"), F.lit(15)).contains(NOTE_BEGINS))
    signs = texts.where(sign)
    # The sign is asked once for a node, so that no text goes through the window; what holds one is read twice.
    holders = nodes.withColumn("__sign", F.coalesce(sign, F.lit(False))).withColumn("__holds", F.col("__sign") | F.coalesce(first_inside(F.col("__sign"), F.lit(True)), F.lit(False)))
    holders = bucketed(holders.where("__holds").select("doc_key", "node_id", "parent_id", "end_id", "sib_pos", "kind", "tag"), "holders", "doc_key", "node_id")
    first = holders.groupBy("doc_key", "parent_id").agg(F.min("sib_pos").alias("from"))
    after = texts.join(first, ["doc_key", "parent_id"]).where("sib_pos > from").select("doc_key", "node_id")
    parents = holders.where((F.col("kind") == "element") & ~F.col("tag").isin("article", "body", "div", "html")).select("doc_key", "node_id", "end_id")
    said = element_texts(nodes, parents).where((F.length("text_raw") < block) & (F.col("text_raw").rlike("Сноска[. ]") | F.ltrim("text_raw").startswith("Примечание")))
    inside = texts.join(said.select("doc_key", F.col("node_id").alias("parent_id")), ["doc_key", "parent_id"], "left_semi").select("doc_key", "node_id")
    return narrow.union(signs.select("doc_key", "node_id")).union(after).union(inside).distinct()


def before(nodes: DataFrame, n: int = 60) -> DataFrame:
    """``nodes`` with prev_text: what siblings before say, white space collapsed, its last ``n`` characters.

    Texts say their text, elements what a column ``said`` holds (nothing without one). Only so many siblings are looked
    back at as give ``n`` characters: a range over the running length, so a row gathers no more than a few times that.
    """
    said = F.when(F.col("kind") == "text", F.col("text"))
    if "said" in nodes.columns:
        said = F.coalesce(said, F.col("said"))
    parent = Window.partitionBy("doc_key", "parent_id")
    own = F.right(F.regexp_replace(said, rf"{U}\s+", " "), F.lit(n + 1))
    rows = nodes.withColumn("__s", own).withColumn("__b", blank(F.col("__s")))
    last = F.last(F.when(F.length("__s") > 0, F.col("__b")), True).over(parent.orderBy("sib_pos").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__last", last).withColumn("__s", F.when(F.col("__b") & F.coalesce("__last", F.lit(True)), None).otherwise(F.col("__s")))
    rows = rows.withColumn("__end", F.sum(F.when(F.col("__b"), 0).otherwise(F.coalesce(F.length("__s"), F.lit(0)))).over(parent.orderBy("sib_pos").rowsBetween(Window.unboundedPreceding, 0)))
    near = F.collect_list(F.when(F.length("__s") > 0, F.struct("sib_pos", "__s"))).over(parent.orderBy("__end").rangeBetween(-(2 * n + 2), 0))
    joined = F.array_join(F.transform(F.filter(F.array_sort("__near"), lambda x: x["sib_pos"] < F.col("sib_pos")), lambda x: x["__s"]), "")
    return rows.withColumn("__near", near).withColumn("prev_text", F.right(collapse(joined), F.lit(n))).drop("__s", "__b", "__last", "__end", "__near")


def preceding(nodes: DataFrame, n: int = 60) -> DataFrame:
    """(doc_key, node_id, prev_text) of every link: what its siblings before say, elements included."""
    held = nodes.where("tag = 'a'").select("doc_key", "parent_id").distinct()
    rows = nodes.where("kind <> 'comment'").join(held, ["doc_key", "parent_id"], "left_semi")
    said = element_texts(nodes, rows.where("kind = 'element'").select("doc_key", "node_id", "end_id")).select("doc_key", "node_id", F.col("text_raw").alias("said"))
    return before(rows.join(said, ["doc_key", "node_id"], "left"), n).where("tag = 'a'").select("doc_key", "node_id", "prev_text")


def neighbours(nodes: DataFrame) -> DataFrame:
    """Nodes with the nearest sibling that isn't blank on either side: prev_node, next_node (struct), and the gap before."""
    w = Window.partitionBy("doc_key", "parent_id").orderBy("sib_pos")
    significant = F.when((F.col("kind") == "element") | ((F.col("kind") == "text") & ~blank(F.col("text"))), F.struct("node_id", "kind", "tag", "text"))
    return (
        nodes.withColumn("prev_node", F.last(significant, True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("next_node", F.last(significant, True).over(Window.partitionBy("doc_key", "parent_id").orderBy(F.desc("sib_pos")).rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("gap", F.when(blank(F.lag("text").over(w)), F.lag("text").over(w)))
    )


def anchor_ids(nodes: DataFrame) -> DataFrame:
    """(doc_key, node_id, anchor): an element's own id, else that of its first inner link with a name, else with an id."""
    link, name, id_ = F.col("tag") == "a", attr("name"), attr("id")
    anchor = F.coalesce(id_, first_inside(link & name.isNotNull(), F.coalesce(id_, name)), first_inside(link & id_.isNotNull(), id_))
    return nodes.select("doc_key", "node_id", "kind", anchor.alias("anchor")).where("kind = 'element' and anchor is not null").drop("kind")


def ids(nodes: DataFrame, names_of: list[str] | None = None) -> DataFrame:
    """(doc_key, id) of every id and name (of the tags ``names_of`` only, if given)."""
    name = attr("name") if names_of is None else F.when(F.col("tag").isin(names_of), attr("name"))
    return nodes.where("kind = 'element'").select("doc_key", F.explode(F.array_compact(F.array(attr("id"), name))).alias("id")).distinct()


def duplicate_ids(nodes: DataFrame) -> DataFrame:
    return nodes.select("doc_key", attr("id").alias("id")).where("id is not null").groupBy("doc_key", "id").count().where("count > 1")


def lines(nodes: DataFrame) -> DataFrame:
    """(doc_key, line, text): text broken at breaks and blocks, with links replaced by a sign; blank lines go."""
    w = Window.partitionBy("doc_key").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    marked = without_noise(nodes).where("kind <> 'comment'").withColumn("line", F.sum(F.coalesce(F.col("tag").isin(BREAKS), F.lit(False)).cast("int")).over(w))
    said = F.when((F.col("kind") == "text") & ~inside_link(), F.col("text")).when(F.col("tag") == "a", F.lit(" ⟦L⟧ "))
    pieces = marked.select("doc_key", "line", F.struct("node_id", said.alias("s")).alias("p")).where("p.s is not null")
    got = pieces.groupBy("doc_key", "line").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return got.select("doc_key", "line", collapse(F.array_join(F.transform("ps", lambda p: p["s"]), "")).alias("text")).where("text <> ''")


def links(nodes: DataFrame) -> DataFrame:
    """(doc_key, node_id, href, text) of the links; text is the link's own, white space collapsed."""
    a = nodes.where("tag = 'a'").select("doc_key", "node_id", "end_id", attr("href").alias("href")).where("href is not null")
    return element_texts(nodes, a, ["a"]).select("doc_key", "node_id", "href", collapse(F.col("text_raw")).alias("text"))
