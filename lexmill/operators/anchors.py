"""Anchor maps: articles, points and subpoints, parts, chapters, their reverse, and what stands near an anchor.

Null attributes and texts name nothing; of equal keys one wins by a stated order; empty tables give empty maps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import IU, U, escape
from .dom import attr, element_texts, first_inside, host, in_note, upcoming
from .structure import anchor_in_text

NATIVE = r"^z\d+"


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each ``keys``: the least by ``order``. A partial aggregate, so hot keys cost little."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    best = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__best"))
    return best.select(*keys, "__best.*")


def article_anchors(nodes: DataFrame) -> DataFrame:
    """(doc_key, article, anchor, method, node_id): four ways to find an article's anchor, the first that finds it wins.

    1: a link named zN followed by «Статья N.»; 2: such a heading with an id; 3: a paragraph or div with an id not used
    so far; 4: bold text without an anchor, which gets zNh.
    """
    w = Window.partitionBy("doc_key", "parent_id").orderBy("sib_pos")
    after = nodes.withColumn("after", F.lead(F.when(F.col("kind") == "text", F.col("text"))).over(w)).where("tag = 'a'")
    named = after.where(attr("name").rlike(NATIVE)).select("doc_key", "node_id", "parent_id", "after", attr("name").alias("anchor"))
    holder = element_texts(nodes, named.select("doc_key", F.col("parent_id").alias("node_id")).distinct()).select("doc_key", F.col("node_id").alias("parent_id"), F.col("text_raw").alias("around"))
    one = named.join(holder, ["doc_key", "parent_id"], "left").select("doc_key", F.coalesce(anchor_in_text(F.col("after")), anchor_in_text(F.col("around"))).alias("article"), "anchor", F.lit(1).alias("method"), "node_id")
    linked = (F.col("tag") == "a") & (attr("id").isNotNull() | attr("name").isNotNull())
    elements = nodes.withColumn("anchored", first_inside(linked, F.lit(True))).where("kind = 'element'")
    blocks = element_texts(nodes, elements.where(F.col("tag").isin("h3", "p", "div", "b")).select("doc_key", "node_id", "tag", "end_id", attr("id").alias("id"), "anchored"))
    two = blocks.where((F.col("tag") == "h3") & F.col("id").rlike(NATIVE)).select("doc_key", anchor_in_text(F.col("text_sp")).alias("article"), F.col("id").alias("anchor"), F.lit(2).alias("method"), "node_id")
    start = F.regexp_extract(F.substring("text_sp", 1, 100), rf"{U}^[Сс]татья\s+(\d+(?:-\d+)?)\s*\.", 1)
    three = blocks.where(F.col("tag").isin("p", "div") & F.col("id").isNotNull()).select("doc_key", F.nullif(start, F.lit("")).alias("article"), F.col("id").alias("anchor"), F.lit(3).alias("method"), "node_id")
    three = three.join(one.union(two).where("article is not null").select("doc_key", "anchor").distinct(), ["doc_key", "anchor"], "left_anti").select(*two.columns)
    number = anchor_in_text(F.col("text_sp"))
    four = blocks.where("tag = 'b' and anchored is null").select("doc_key", number.alias("article"), F.concat(F.lit("z"), number, F.lit("h")).alias("anchor"), F.lit(4).alias("method"), "node_id")
    found = one.union(two).union(three).union(four).where("article is not null")
    return first_wins(found, ["doc_key", "article"], ["method", "node_id"]).select("doc_key", "article", "anchor", "method", "node_id")


def by_number(articles: DataFrame, n: int | None = None, *ties: str) -> DataFrame:
    """Articles by number, then suffix, then ``ties``; the first ``n`` if given (a preview)."""
    number = F.split("article", "-")
    got = articles.orderBy(F.try_element_at(number, F.lit(1)).try_cast("int"), F.coalesce(F.try_element_at(number, F.lit(2)).try_cast("int"), F.lit(0)), "article", *ties)
    return got if n is None else got.limit(n)


def points(nodes: DataFrame) -> DataFrame:
    """Paragraphs as (doc_key, node_id, own id, article, punkt, subpoint, is_punkt, text): headings and numbers carried forward.

    A number with a point begins a point of the current article, one with a bracket a subpoint of the current point.
    """
    blocks = element_texts(nodes, nodes.where(F.col("tag").isin("p", "h3", "div") & (F.col("kind") == "element")).select("doc_key", "node_id", "tag", "end_id", attr("id").alias("id")))
    notes = in_note(nodes, wide=False).join(nodes.where("kind = 'text'").select("doc_key", "node_id", "block_id"), ["doc_key", "node_id"]).select("doc_key", F.col("block_id").alias("node_id")).distinct()
    blocks = blocks.where(F.col("tag").isin("p", "h3")).join(notes, ["doc_key", "node_id"], "left_anti")
    heading = F.regexp_extract("text_sp", rf"{U}^[Сс]татья\s+(\d+(?:-\d+)?)", 1)
    rows = blocks.withColumn("heading", F.nullif(heading, F.lit(""))).withColumn("n", F.nullif(F.regexp_extract("text_sp", rf"{U}^(\d+(?:-\d+)?)\s*\.(?!\d)", 1), F.lit("")))
    rows = rows.withColumn("s", F.nullif(F.regexp_extract("text_sp", rf"{U}^(\d+(?:-\d+)?)\s*\)", 1), F.lit("")))
    w = Window.partitionBy("doc_key").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("article", F.last("heading", True).over(w)).withColumn("__island", F.count("heading").over(w))
    inside = Window.partitionBy("doc_key", "__island").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("punkt", F.last(F.when(F.col("heading").isNull(), F.col("n")), True).over(inside))
    return rows.select("doc_key", "node_id", "id", "article", "punkt", F.col("s").alias("subpoint"), F.col("n").isNotNull().alias("is_punkt"), F.col("heading").isNotNull().alias("is_heading"), F.col("text_sp").alias("text"))


def subpoint_anchors(nodes: DataFrame) -> DataFrame:
    """(doc_key, key, anchor, node_id): ``article_point[_subpoint]`` or ``article_subpoint``; the later of equal keys wins."""
    rows = points(nodes).where("article is not null and not is_heading")
    key = F.when(F.col("is_punkt"), F.concat_ws("_", "article", "punkt")).when(F.col("subpoint").isNotNull(), F.concat_ws("_", "article", "punkt", "subpoint"))
    made = F.when(F.col("is_punkt"), F.concat(F.lit("z"), "article", F.lit("_p"), "punkt")).otherwise(F.concat(F.lit("z"), F.concat_ws("_", "article", "punkt", "subpoint")))
    found = rows.select("doc_key", key.alias("key"), F.coalesce("id", made).alias("anchor"), "node_id").where("key is not null")
    return found.groupBy("doc_key", "key").agg(F.max_by(F.struct("anchor", "node_id"), "node_id").alias("x")).select("doc_key", "key", "x.anchor", "x.node_id")


def part_anchors(nodes: DataFrame) -> DataFrame:
    """(doc_key, article, part, anchor) of paragraphs with an id: a dashed number's last wins, a plain one's first."""
    rows = points(nodes).where("is_punkt and id is not null and article is not null and not is_heading").select("doc_key", "article", F.regexp_extract("text", r"^(\d+(?:-\d+)?)", 1).alias("part"), "id", "node_id")
    got = rows.groupBy("doc_key", "article", "part").agg(F.min_by("id", "node_id").alias("first"), F.max_by("id", "node_id").alias("last"))
    return got.select("doc_key", "article", "part", F.when(F.col("part").contains("-"), F.col("last")).otherwise(F.col("first")).alias("anchor"))


def chapter_anchors(nodes: DataFrame) -> DataFrame:
    """(doc_key, chapter, anchor): headings with an id before bold paragraphs with a named link."""
    number = F.nullif(F.regexp_extract("text_sp", rf"{IU}^\s*глава\s+(\d+(?:-\d+)?)", 1), F.lit(""))
    heads = element_texts(nodes, nodes.where(F.col("tag").isin("h2", "h3", "h4")).select("doc_key", "node_id", "end_id", attr("id").alias("anchor")).where("anchor is not null"), ["h2", "h3", "h4"]).select("doc_key", number.alias("chapter"), "anchor", F.lit(1).alias("source"), "node_id")
    seen = nodes.withColumn("anchor", first_inside((F.col("tag") == "a") & attr("name").isNotNull(), attr("name")))
    bold = element_texts(nodes, seen.where("tag = 'b' and anchor is not null").select("doc_key", "node_id", "end_id", "anchor"), ["b"]).select("doc_key", number.alias("chapter"), "anchor", F.lit(2).alias("source"), "node_id")
    return first_wins(heads.union(bold).where("chapter is not null"), ["doc_key", "chapter"], ["source", "node_id"]).select("doc_key", "chapter", "anchor")


def with_synthetic(nodes: DataFrame, articles: DataFrame) -> DataFrame:
    """``nodes`` with a ``render`` for the first text of bold headings that got a synthetic anchor."""
    made = articles.where("method = 4").select("doc_key", F.col("node_id").alias("parent_id"), "anchor")
    w = Window.partitionBy("doc_key", "parent_id").orderBy("sib_pos")
    first = nodes.where("kind = 'text'").withColumn("k", F.row_number().over(w)).where("k = 1").join(made, ["doc_key", "parent_id"]).select("doc_key", "node_id", "anchor")
    joined = nodes.join(first, ["doc_key", "node_id"], "left")
    return joined.withColumn("render", F.when(F.col("anchor").isNotNull(), F.concat(F.lit('<a id="'), "anchor", F.lit('" name="'), "anchor", F.lit('"></a>'), escape(F.col("text"))))).drop("anchor")


def ids_from_names(nodes: DataFrame) -> DataFrame:
    """Links with a name and no id get the name as id where no element has that id; the first of equals gets it."""
    w = Window.partitionBy("doc_key", "name").orderBy("node_id")
    named = nodes.where("tag = 'a'").select("doc_key", "node_id", attr("name").alias("name"), attr("id").alias("id")).where("name is not null and id is null")
    used = nodes.select("doc_key", attr("id").alias("name")).where("name is not null").distinct()
    chosen = named.withColumn("k", F.row_number().over(w)).where("k = 1").join(used, ["doc_key", "name"], "left_anti").select("doc_key", "node_id", F.col("name").alias("__id"))
    joined = nodes.join(chosen, ["doc_key", "node_id"], "left")
    return joined.withColumn("attrs", F.when(F.col("__id").isNotNull(), F.map_concat("attrs", F.create_map(F.lit("id"), "__id"))).otherwise(F.col("attrs"))).drop("__id")


def reverse_anchors(articles: DataFrame, subpoints: DataFrame, by: str = "code") -> DataFrame:
    """(code, anchor, article): article maps (key, anchor) before subpoint maps, whose key begins with the article."""
    both = articles.select(by, "anchor", F.col("key").alias("article"), F.lit(1).alias("source")).union(subpoints.select(by, "anchor", F.split("key", "_")[0].alias("article"), F.lit(2).alias("source")))
    return first_wins(both, [by, "anchor"], ["source", "article"]).select(by, "anchor", "article")


def resolve(events: DataFrame) -> DataFrame:
    """For each anchor event the article it belongs to and the next one.

    ``events`` are (doc_key, pos, kind, val): H an article's heading, B the begin of a body, A an anchor. An anchor
    before a heading with no body between belongs to that heading, else to the last heading before it.
    """
    behind = Window.partitionBy("doc_key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    is_h, is_b = F.col("kind") == "H", F.col("kind") == "B"
    got = events.withColumn("nh", upcoming(F.when(is_h, F.struct("pos", "val")), "pos")).withColumn("nb", upcoming(F.when(is_b, F.col("pos")), "pos")).withColumn("lh", F.last(F.when(is_h, F.col("val")), True).over(behind))
    target = F.when(F.col("nh").isNotNull() & (F.col("nb").isNull() | (F.col("nb") > F.col("nh.pos"))), F.col("nh.val")).otherwise(F.coalesce("lh", "nh.val"))
    return got.where("kind = 'A'").select("doc_key", "pos", F.col("val").alias("id"), target.alias("article"), F.col("nh.val").alias("next_article"))


def boundary(nodes: DataFrame, window: int = 600) -> DataFrame:
    """(doc_key, id, number) of the article div that opens within ``window`` source characters after an anchor."""
    opens = F.when((F.col("tag") == "div") & (attr("data-type") == "статья"), F.struct("src_pos", attr("data-number").alias("number")))
    got = nodes.withColumn("next_div", upcoming(opens)).select("doc_key", F.coalesce(attr("id"), attr("name")).alias("id"), "src_pos", "next_div")
    return got.where(F.col("id").isNotNull() & (F.col("next_div.src_pos") - F.col("src_pos") <= window)).select("doc_key", "id", "next_div.number")


def article_headings(nodes: DataFrame) -> DataFrame:
    """(doc_key, node_id, article, anchor): paragraphs whose bold text has an anchor and is an article's heading, and h3 with an id that are."""
    start = rf"{U}^\s*Статья\s+(\d+(?:-\d+)?)\s*\."
    link, name, id_ = F.col("tag") == "a", attr("name"), attr("id")
    seen = nodes.withColumn("anchor", F.coalesce(first_inside(link & name.isNotNull(), name), first_inside(link & id_.isNotNull(), id_)))
    bold = seen.where((F.col("tag") == "b") & F.array_contains("tags", "p") & F.col("anchor").isNotNull()).select("doc_key", "node_id", "end_id", "block_id", "anchor")
    bold = element_texts(nodes, bold).select("doc_key", F.col("block_id").alias("node_id"), "text_sp", "anchor")
    heads = element_texts(nodes, nodes.where((F.col("tag") == "h3") & attr("id").isNotNull()).select("doc_key", "node_id", "end_id", attr("id").alias("anchor"))).select("doc_key", "node_id", "text_sp", "anchor")
    return bold.union(heads).select("doc_key", "node_id", F.nullif(F.regexp_extract("text_sp", start, 1), F.lit("")).alias("article"), "anchor").where("article is not null")


def with_point_ids(nodes: DataFrame, made: DataFrame) -> DataFrame:
    """``nodes`` with the anchors of ``subpoint_anchors`` written: paragraphs without an id get an inner ``<a>`` in front."""
    own = made.select("doc_key", "node_id", F.col("anchor").alias("__anchor"))
    marks = nodes.where("kind = 'element'").join(own, ["doc_key", "node_id"]).where(attr("id").isNull()).select("doc_key", F.col("node_id").alias("parent_id"), "__anchor")
    first = nodes.where("kind = 'text'").join(marks, ["doc_key", "parent_id"]).groupBy("doc_key", "parent_id").agg(F.min("node_id").alias("node_id"), F.first("__anchor").alias("__anchor")).drop("parent_id")
    joined = nodes.join(first, ["doc_key", "node_id"], "left")
    return joined.withColumn("render", F.when(F.col("__anchor").isNotNull(), F.concat(F.lit('<a id="'), "__anchor", F.lit('"></a>'), escape(F.col("text"))))).drop("__anchor")


def heading_map(nodes: DataFrame) -> DataFrame:
    """(doc_key, id, number): ids of headings by their own number, other ids by the nearest article div around them."""
    heads = element_texts(nodes, nodes.where(F.col("tag").isin("h1", "h2", "h3", "h4", "h5", "h6") & attr("id").isNotNull()).select("doc_key", "node_id", "end_id", attr("id").alias("id")))
    heads = heads.select("doc_key", "id", "node_id", F.nullif(F.regexp_extract("text_sp", rf"{IU}^\s*[сcϲ]тать[яиею]\s+(\d+(?:-\d+)?)\s*\.", 1), F.lit("")).alias("number"), F.lit(1).alias("source")).where("number is not null")
    rest = nodes.where("kind = 'element'").select("doc_key", "node_id", attr("id").alias("id")).where("id is not null").join(host(nodes).select("doc_key", "node_id", F.col("host_number").alias("number")), ["doc_key", "node_id"]).where("number is not null")
    both = heads.union(rest.select("doc_key", "id", "node_id", "number", F.lit(2).alias("source")))
    return first_wins(both, ["doc_key", "id"], ["source", "node_id"]).select("doc_key", "id", "number")
