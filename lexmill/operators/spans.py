"""Link spans: canonical hrefs, merging of neighbouring links, dictionary links to other acts, and the gates around them.

Chains are found by a pattern over one letter a sibling; the other merges settle among the children of one parent, in a
small Arrow pass over those parents that hold a candidate: the first one in the text is applied and the children are
looked at again, until nothing is left to apply. Merges are edits of nodes (text in front and behind, new text, gone), so
markup inside a link stays.

Null hrefs are no links; rows without a match stay as they are; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.overlaps import cut_out, with_links, without_overlaps
from ..functions.phrases import phrase_spans
from ..functions.text import ENDING, IU, MARK, ORDINALS, U, collapse, escape
from ..sources.shared import written
from .dom import attr, element_texts, host, ids, inside
from .references import ART, NUM, PART, PNUM, PUNKT, SEP, SUB

#: Where acts are published, unless the caller names another place.
SITE = "https://example.org/docs/"
DOC = r"[A-Z]\d{6,}_?"
ODD_HREF = r"(?i)(/archive|/history|\?|/compare|\d{2}\.\d{2}\.\d{4})"


def doc_of(href: Column) -> Column:
    """The act a link points to; null if it names none."""
    return F.nullif(F.regexp_extract(href, rf"(?:/docs/|^/?)({DOC})", 1), F.lit(""))


def fragment_of(href: Column) -> Column:
    return F.nullif(F.regexp_extract(href, r"#([^#]*)$", 1), F.lit(""))


def link_kind(href: Column, own: Column | None = None) -> Column:
    """internal (a fragment, or the act ``own``), external (another act), else nav."""
    doc = doc_of(href)
    inside = href.startswith("#") & (F.length(href) > 1)
    if own is not None:
        inside = inside | F.coalesce((F.rtrim(doc, F.lit("_")) == F.rtrim(own, F.lit("_"))) & fragment_of(href).isNotNull(), F.lit(False))
    return F.when(inside, F.lit("internal")).when(doc.isNotNull(), F.lit("external")).otherwise(F.lit("nav"))


def canonical(rows: DataFrame, targets: DataFrame, own: Column, site: str = SITE) -> DataFrame:
    """``rows`` (doc_key, href, …) with canonical hrefs; ``targets`` (doc_key, id) are the ids that documents have, ``own`` names a row's act.

    A full link to the act itself becomes ``#z…``, ``#`` without a fragment, and for a bare number N ``#zN`` if that id is
    there, else ``#N`` if that is, else it stays; other forms of it stay as well, relative ones too. Any link to another
    act, archived and dated ones included (``anomalies`` reports them), becomes the ``site``'s with its z fragment, if any.
    """
    href = F.col("href")
    doc, tail = (F.regexp_extract(href, rf"/docs/({DOC})(.*)$", k) for k in (1, 2))
    self_ = (doc == own) & href.rlike(r"^https?://")
    number = F.nullif(F.regexp_extract(tail, r"^#(\d[\w-]*)$", 1), F.lit(""))
    asked = rows.withColumn("__n", F.when(self_, number)).withColumn("__z", F.concat(F.lit("z"), "__n"))
    ids_ = targets.select(F.col("doc_key").alias("__d"), F.col("id").alias("__id")).distinct()
    for name, has in (("__z", "__has_z"), ("__n", "__has_n")):
        known = ids_.withColumn(has, F.lit(True))
        asked = asked.join(known, (asked["doc_key"] == known["__d"]) & (asked[name] == known["__id"]), "left").drop("__d", "__id")
    inner = F.when(tail.rlike(r"^#z[\w-]+$"), tail).when(tail == "", "#").when(F.col("__has_z"), F.concat(F.lit("#"), "__z")).when(F.col("__has_n"), F.concat(F.lit("#"), "__n")).otherwise(href)
    outer = F.concat(F.lit(site), doc, F.regexp_extract(tail, r"#z[\w-]+", 0))
    return asked.withColumn("href", F.when(self_, inner).when((doc != "") & (doc != own), outer).otherwise(href)).drop("__n", "__z", "__has_z", "__has_n")


def anomalies(hrefs: DataFrame, href: str = "href") -> DataFrame:
    return hrefs.where(doc_of(F.col(href)).isNotNull() & F.col(href).rlike(ODD_HREF))


def with_dropped_z(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``#N`` becomes ``#zN`` where the document has zN and no N of its own goes first; rows: doc_key, href."""
    number = F.nullif(F.regexp_extract("href", r"^#(\d+)$", 1), F.lit(""))
    known = targets.select("doc_key", F.col("id").alias("__z")).distinct()
    joined = rows.withColumn("__z", F.concat(F.lit("z"), number)).join(known.withColumn("__has", F.lit(True)), ["doc_key", "__z"], "left")
    return joined.withColumn("href", F.when(F.col("__has"), F.concat(F.lit("#"), "__z")).otherwise(F.col("href"))).drop("__z", "__has")


def renamed_duplicates(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` (doc_key, node_id, id) with new_id: second and later uses of an id nobody links to become ``id__dN``."""
    w = Window.partitionBy("doc_key", "id").orderBy("node_id")
    seen = linked.select("doc_key", "id").distinct().withColumn("__linked", F.lit(True))
    numbered = rows.withColumn("k", F.row_number().over(w)).join(seen, ["doc_key", "id"], "left")
    return numbered.withColumn("new_id", F.when((F.col("k") > 1) & F.col("__linked").isNull(), F.concat("id", F.lit("__d"), F.col("k") - 1)).otherwise(F.col("id"))).drop("k", "__linked")


def retargeted(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Links whose whole text is «статья N» point to that article's anchor; of equal links (href and text) only the first does.

    rows: doc_key, node_id, href, text.
    """
    number = F.regexp_extract("text", rf"{IU}^\s*{ART}\s+({NUM})\s*$", 1)
    k = F.row_number().over(Window.partitionBy("doc_key", "href", "text").orderBy("node_id"))
    got = rows.withColumn("article", F.nullif(number, F.lit(""))).withColumn("__k", k).join(articles.select("doc_key", "article", "anchor"), ["doc_key", "article"], "left")
    own = F.col("href").startswith("#") & (F.col("__k") == 1)
    return got.withColumn("href", F.when(own, F.coalesce(F.concat(F.lit("#"), "anchor"), "href")).otherwise(F.col("href"))).drop("article", "anchor", "__k")


def canon_gates(nodes: DataFrame, own: DataFrame, site: str = SITE) -> DataFrame:
    """(doc_key, gate, n): own #z links without a target, links to other acts in another form, full links to the act itself.

    ``own`` (doc_key, own) names each document's act. The last two look at content only (inside a div with data-type).
    """
    a = nodes.where("tag = 'a'").select("doc_key", "node_id", attr("href").alias("href")).where("href is not null").join(own, "doc_key")
    inside = a.join(host(nodes, None).select("doc_key", "node_id"), ["doc_key", "node_id"], "left_semi")
    doc = doc_of(F.col("href"))
    self_ = F.rtrim(doc, F.lit("_")) == F.rtrim("own", F.lit("_"))
    shape = rf"^{re.escape(site)}[A-Z][A-Z0-9]{{4,}}_?(?:#z[\w.-]+)?$"
    broken = dangling(a.where(F.col("href").startswith("#z")), ids(nodes, ["a"]))
    found = [("broken", broken), ("not_canonical", inside.where(doc.isNotNull() & ~self_ & ~F.col("href").rlike(shape))), ("full_self", inside.where(self_))]
    rows = nodes.select("doc_key").distinct()
    for name, bad in found:
        rows = rows.join(bad.groupBy("doc_key").agg(F.count("*").alias(name)), "doc_key", "left")
    each = F.array(*(F.struct(F.lit(n).alias("gate"), F.coalesce(n, F.lit(0)).cast("long").alias("n")) for n, _ in found))
    return rows.select("doc_key", F.explode(each).alias("g")).select("doc_key", "g.gate", "g.n")


def dangling(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Links to a fragment of their own document that it doesn't have; rows: doc_key, href."""
    wanted = rows.where(F.col("href").startswith("#") & (F.length("href") > 1)).withColumn("id", F.substring("href", 2, 1 << 20))
    return wanted.join(targets.select("doc_key", "id"), ["doc_key", "id"], "left_anti")


def href_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """(doc_key, href, old_n, new_n) of the hrefs whose counts differ: a comparison of multisets."""
    a = old.groupBy("doc_key", "href").agg(F.count("*").alias("old_n"))
    b = new.groupBy("doc_key", "href").agg(F.count("*").alias("new_n"))
    return a.join(b, ["doc_key", "href"], "full").fillna(0, ["old_n", "new_n"]).where("old_n <> new_n")


def text_hash(rows: DataFrame, text: str = "text") -> DataFrame:
    return rows.select("doc_key", F.sha2(F.coalesce(text, F.lit("")), 256).alias("sha"))


# Merging of neighbours

CONNECTOR = rf"{IU}^\s*(?:,|;|и|или)?\s*$"
HAS_ARTICLE = rf"{IU}(?<![\p{{L}}]){ART}"
UNIT_WORD = rf"{IU}^\s*(?:{SUB}|{PUNKT}|{PART}|абзац(?:а|е|у|ем|ами|ах|ев|ы)?)\s"
UNIT = rf"{IU}^\s*(?:(?:{SUB}|{PUNKT}|{PART}|абзац(?:а|е|у|ем|ами|ах|ев|ы)?)\s+)?(?:{NUM}\)?|(?:{'|'.join(ORDINALS)}){ENDING})\s*$"
PLAIN = rf"{IU}^\s*({ART}\s+{NUM})"


def siblings(nodes: DataFrame) -> DataFrame:
    """(doc_key, parent_id, sibs): the children of every element with a link, as letter, node_id, kind, text and href.

    R is a link to a unit, B one that is only a number or an ordinal, A one to an article, C a connector or blank text,
    P a text that begins with an article, X anything else. A parent's own children are gathered, nothing more.
    """
    a = nodes.where("tag = 'a'").select("doc_key", "node_id", "end_id", "parent_id", attr("href").alias("href")).where("href is not null")
    held = a.select("doc_key", "parent_id").distinct()
    rows = nodes.join(held, ["doc_key", "parent_id"], "left_semi").where("kind <> 'comment'")
    said = element_texts(nodes, a.select("doc_key", "node_id", "end_id", "href"), ["a"]).select("doc_key", "node_id", "href", F.col("text_raw").alias("said"))
    rows = rows.join(said, ["doc_key", "node_id"], "left")
    own = F.when(F.col("kind") == "text", F.col("text")).otherwise(F.col("said"))
    letter = (
        F.when(F.col("href").isNotNull() & own.rlike(HAS_ARTICLE), "A")
        .when(F.col("href").isNotNull() & own.rlike(UNIT) & own.rlike(UNIT_WORD), "R")
        .when(F.col("href").isNotNull() & own.rlike(UNIT), "B")
        .when((F.col("kind") == "text") & own.rlike(CONNECTOR), "C")
        .when((F.col("kind") == "text") & own.rlike(PLAIN), "P")
        .otherwise("X")
    )
    cell = F.struct("sib_pos", "node_id", letter.alias("letter"), F.when(F.col("href").isNotNull(), "a").when(F.col("kind") == "text", "text").otherwise("other").alias("kind"), own.alias("text"), "href")
    return rows.groupBy("doc_key", "parent_id").agg(F.array_sort(F.collect_list(cell)).alias("sibs"))


def _targets(sibs: Column) -> Column:
    """What each link of a run points to: the act, or this document."""
    return F.array_distinct(F.transform(F.filter(sibs, lambda s: s["href"].isNotNull()), lambda s: F.coalesce(doc_of(s["href"]), F.when(s["href"].startswith("#"), F.lit("#")).otherwise(s["href"]))))


def _runs(sibs: DataFrame, pattern: str) -> DataFrame:
    """The runs of siblings whose letters match ``pattern``: (doc_key, parent_id, run)."""
    letters = F.array_join(F.transform("sibs", lambda s: s["letter"]), "")
    pieces = F.filter(F.split(F.regexp_replace(letters, pattern, f"{MARK}$0!{MARK}"), MARK), lambda p: p != "")
    rows = sibs.where(letters.rlike(pattern)).withColumn("pieces", pieces).select("*", F.posexplode("pieces").alias("k", "piece")).where(F.col("piece").endswith("!"))
    start = F.aggregate(F.slice("pieces", F.lit(1), F.col("k")), F.lit(0), lambda a, p: a + F.length(F.rtrim(p, F.lit("!"))))
    return rows.select("doc_key", "parent_id", F.slice("sibs", start + 1, F.length("piece") - 1).alias("run"))


def chains(sibs: DataFrame) -> DataFrame:
    """Unit links joined by connectors, ended by an article (a link, or plain text): (…, text, keep, dropped, terminal, members).

    At least two units, the first with its word, and all to one target; a plain end is taken for internal chains only.
    """
    found = _runs(sibs, "R(?:C*[RB])+C*[AP]")
    end = F.try_element_at("run", F.lit(-1))
    plain = end["letter"] == "P"
    targets = F.when(plain, _targets(F.slice("run", F.lit(1), F.size("run") - 1))).otherwise(_targets(F.col("run")))
    found = found.where((F.size(targets) == 1) & (~plain | (F.get(targets, F.lit(0)) == "#")))
    words = F.transform("run", lambda s: F.when(s["letter"] == "P", F.regexp_extract(s["text"], PLAIN, 0)).otherwise(s["text"]))
    hrefs = F.transform(F.filter("run", lambda s: s["href"].isNotNull()), lambda s: s["href"])
    members = F.transform("run", lambda s: F.struct(s["node_id"].alias("node_id"), s["kind"].alias("kind"), s["text"].alias("text"), s["letter"].alias("letter")))
    first = F.try_element_at("run", F.lit(1))["node_id"]
    return found.select(
        "doc_key", "parent_id", first.alias("node_id"), collapse(F.array_join(words, "")).alias("text"), F.get(hrefs, F.lit(0)).alias("keep"), F.slice(hrefs, F.lit(2), F.size(hrefs)).alias("dropped"),
        F.when(plain, "plain").otherwise("link").alias("terminal"), F.array_join(F.slice(words, F.lit(2), F.size(words)), "").alias("tail"), members.alias("members"),
    )


def chain_edits(found: DataFrame) -> DataFrame:
    """``chains`` as edits (doc_key, node_id, lead, tail, new_text, gone): the first link takes the rest in, a plain end loses what it took."""
    none = F.lit(None).cast("string")
    first = found.select("doc_key", "node_id", none.alias("lead"), "tail", none.alias("new_text"), F.lit(False).alias("gone"))
    rest = found.select("doc_key", F.explode(F.slice("members", F.lit(2), F.size("members"))).alias("m"))
    left = F.regexp_replace("m.text", PLAIN, "")
    plain = F.col("m.letter") == "P"
    return first.unionByName(rest.select("doc_key", "m.node_id", none.alias("lead"), none.alias("tail"), F.when(plain, left).alias("new_text"), (~plain).alias("gone")))


def edited(nodes: DataFrame, edits: DataFrame) -> DataFrame:
    """``nodes`` with edits applied: what is gone goes with all inside it, new text replaces a text, lead and tail stand inside an element."""
    joined = nodes.join(edits, ["doc_key", "node_id"], "left")
    out = F.coalesce("gone", F.lit(False))
    kept = joined.withColumn("__out", out | inside(out)).where("not __out")
    return kept.withColumn("text", F.coalesce("new_text", "text")).drop("new_text", "gone", "__out")


def merged_chains(nodes: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``nodes`` with every chain as one link: the first keeps its href and gets the whole text, the others go."""
    found = chains(siblings(nodes)) if found is None else found
    return edited(nodes, chain_edits(found))


_WORDS = rf"(?:{SUB}|{PUNKT}|{PART}|абзац\w*)"
_ORD = rf"(?:{'|'.join(ORDINALS)})\w*"
_QUALIFIER = rf"(?:(?:{PART}|абзац\w*)\s+{_ORD}(?:\s*(?:,|и|или)\s*{_ORD})*|{SUB}\s+{PNUM}(?:{SEP}{PNUM})*)"
#: What a link or a text is: begins with a unit, ends with a number, begins with an article, is a number, begins with a point.
_UNIT, _NUMBER, _ARTICLE, _ONLY, _POINT = (re.compile(p, re.I) for p in (rf"\s*{_WORDS}\b", r"\d\)?\s*$", rf"\s*{ART}\s+\d", r"\s*\d+\s*$", rf"\s*(?:{SUB}|{PUNKT})\s+\d"))
_TAKES_ARTICLE, _TAKES_NUMBER, _DASH = re.compile(rf"\s*{ART}\s+{NUM}", re.I), re.compile(r"\s*[–-]\s*\d+"), re.compile(r"\s*[-–]\s*$")
_ENDS_UNIT = re.compile(rf"(?P<unit>(?:{_QUALIFIER}\s+)?(?:{SUB}|{PUNKT})\s+\d+\)?)\s*$", re.I)
_ENDS_QUALIFIER = re.compile(rf"(?P<unit>{_QUALIFIER})\s*$", re.I)


class _Row:
    """The cells of a parent that have text left, as a doubly linked list: an edit costs what it takes, not what stands around it."""

    def __init__(self, cells: list[dict]) -> None:
        self.cells = cells
        here = [i for i, c in enumerate(cells) if not c["gone"] and c["text"] != ""]
        self.after, self.before, self.live = dict(zip(here, here[1:])), dict(zip(here[1:], here)), set(here)
        self.first = here[0] if here else None
        self.link_before: list[int] = []  # the last link in front of every cell, whatever became of it
        last = -1
        for i, c in enumerate(cells):
            self.link_before.append(last)
            last = i if c["kind"] == "a" and i in self.live else last

    def drop(self, i: int) -> None:
        """``i`` goes; what follows it is still found from it."""
        self.live.discard(i)
        a, b = self.before.get(i), self.after.get(i)
        if a is None:
            self.first = b
        elif b is None:
            self.after.pop(a, None)
        else:
            self.after[a] = b
        if b is not None:
            self.before[b] = a
            if a is None:
                del self.before[b]

    def said_before(self, i: int) -> int | None:
        """The nearest cell in front of ``i`` that is no blank text."""
        j = self.before.get(i)
        while j is not None and self.cells[j]["kind"] == "text" and not self.cells[j]["text"].strip():
            j = self.before.get(j)
        return j

    def link_from(self, i: int | None) -> int | None:
        """The first live link from ``i`` on."""
        while i is not None and (i not in self.live or self.cells[i]["kind"] != "a"):
            i = self.after.get(i)
        return i


def edit_at(row: _Row, i: int) -> tuple[str, int, int, int] | None:
    """The merge that the link ``i`` calls for: (kind, link, other cell, characters of the other that are taken).

    forward: a unit's link takes the article after it; backward: a link takes the unit before it; merge: a unit's link and
    an article's become one; range: a number takes the dash and number (or link) after it; complex: seen, not applied.
    """
    cells, said = row.cells, row.cells[i]["text"]
    back = row.said_before(i)
    if _ARTICLE.match(said):
        if back is None:
            return None
        own = cells[back]["text"]
        if cells[back]["kind"] == "a" and _UNIT.match(own) and _NUMBER.search(own):
            further = row.said_before(back)
            if further is not None and cells[further]["kind"] == "a" and _UNIT.match(cells[further]["text"]):
                return "complex", i, back, 0
            return "merge", back, i, 0
        if cells[back]["kind"] == "text" and (m := _ENDS_UNIT.search(own)):
            return "backward", i, back, len(own) - m.start("unit")
        return None
    if _POINT.match(said) and back is not None and cells[back]["kind"] == "text":
        m = _ENDS_QUALIFIER.search(cells[back]["text"])
        if m and "пункт" not in m["unit"].lower():
            return "backward", i, back, len(cells[back]["text"]) - m.start("unit")
    ahead = row.after.get(i)
    if ahead is None or cells[ahead]["kind"] != "text" or not _NUMBER.search(said):
        return None
    after = cells[ahead]["text"]
    if _UNIT.match(said) and (m := _TAKES_ARTICLE.match(after)):
        return "forward", i, ahead, m.end()
    if m := _TAKES_NUMBER.match(after):
        return "range", i, ahead, m.end()
    following = row.after.get(ahead)
    if _DASH.fullmatch(after) and following is not None and cells[following]["kind"] == "a" and _ONLY.match(cells[following]["text"]):
        return "range", i, following, 0
    return None


def settle(cells: list[dict]) -> list[tuple[str, str, str, str | None]]:
    """Merge ``cells`` in place, the first in the text first, until nothing is left; (kind, text, kept href, dropped href) of each.

    After a merge only the link in front of it can have become ready for another, so the walk goes on from there.
    """
    log, row = [], _Row(cells)
    at = row.link_from(row.first)
    while at is not None:
        found = edit_at(row, at)
        if found is None:
            at = row.link_from(row.after.get(at))
            continue
        kind, i, j, n = found
        one, other = cells[i], cells[j]
        if kind == "complex":
            log.append((kind, "".join(c["text"] for c in cells[j : i + 1] if not c["gone"]), other["href"], None))
            at = row.link_from(row.after.get(i))
            continue
        if kind == "backward":
            cut = len(other["text"]) - n
            one["lead"], one["text"], other["text"] = other["text"][cut:] + one["lead"], other["text"][cut:] + one["text"], other["text"][:cut]
        elif n:
            taken = other["text"][:n]
            one["tail"], one["text"], other["text"] = one["tail"] + taken, one["text"] + taken, other["text"][n:]
        else:
            taken = "".join(c["text"] for c in cells[i + 1 : j + 1] if not c["gone"])
            one["tail"], one["text"] = one["tail"] + taken, one["text"] + taken
            for k in range(i + 1, j + 1):
                cells[k]["gone"] = True
                if k in row.live:
                    row.drop(k)
        if not other["gone"] and other["text"] == "":
            row.drop(j)
        log.append((kind, one["text"], one["href"], None if n else other["href"]))
        start = row.link_before[i]
        at = row.link_from(row.first if start < 0 else start)
    return log


_EDITS = pa.list_(pa.struct([("node_id", pa.int32()), ("lead", pa.string()), ("tail", pa.string()), ("new_text", pa.string()), ("gone", pa.bool_())]))
_LOG = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string()), ("keep", pa.string()), ("dropped", pa.string())]))


def full_spans(sibs: DataFrame) -> DataFrame:
    """(doc_key, parent_id, edits, log) of the parents whose links are widened or merged, or have a chain to report."""
    letters = F.array_join(F.transform("sibs", lambda s: s["letter"]), "")
    rows = sibs.where(letters.rlike("[RAB].|.[RAB]"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit, edits, logs = [], [], []
            for own in b.column(2):
                cells = [{**c, "text": c["text"] or "", "lead": "", "tail": "", "gone": False, "was": c["text"] or ""} for c in own.as_py()]
                log = settle(cells)
                hit.append(bool(log))
                if log:
                    logs.append([dict(zip(("kind", "text", "keep", "dropped"), x, strict=True)) for x in log])
                    changed = [c for c in cells if c["gone"] or c["lead"] or c["tail"] or (c["kind"] == "text" and c["text"] != c["was"])]
                    edits.append([{"node_id": c["node_id"], "lead": c["lead"] or None, "tail": c["tail"] or None, "new_text": c["text"] if c["kind"] == "text" else None, "gone": c["gone"]} for c in changed])
            kept = b.filter(pa.array(hit, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(edits, _EDITS), pa.array(logs, _LOG)], ["doc_key", "parent_id", "edits", "log"])

    kind = "doc_key string, parent_id int, edits array<struct<node_id:int,lead:string,tail:string,new_text:string,gone:boolean>>, log array<struct<kind:string,text:string,keep:string,dropped:string>>"
    return rows.select("doc_key", "parent_id", "sibs").mapInArrow(run, kind)


def span_log(found: DataFrame) -> DataFrame:
    """One row a merge of ``full_spans``: (doc_key, parent_id, ord, kind, text, keep, dropped)."""
    return found.select("doc_key", "parent_id", F.posexplode("log").alias("ord", "x")).select("doc_key", "parent_id", "ord", "x.*")


def merged_spans(nodes: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``nodes`` with all widening and merging applied; texts stay the same in sum."""
    found = full_spans(siblings(nodes)) if found is None else found
    return edited(nodes, found.select("doc_key", F.explode("edits").alias("x")).select("doc_key", "x.*"))


# Dictionary links and overrides


def phrase_links(texts: DataFrame, phrases: DataFrame, least: int = 16, text: str = "text") -> DataFrame:
    """``texts`` with links: places (s, e, phrase, value) of dictionary phrases, longest first, none across another.

    ``phrases`` (phrase, doc_id) may have any size; a phrase shorter than ``least`` is left out. White space is flexible.
    """
    wanted = phrases.where(F.length("phrase") >= least).select("phrase", F.col("doc_id").alias("value"))
    found = phrase_spans(texts, wanted, text)
    ordered = F.array_sort(F.transform("spans", lambda x: F.struct((-(x["e"] - x["s"])).alias("n"), x["s"].alias("s"), x["e"].alias("e"), x["phrase"].alias("phrase"), x["value"].alias("value"))))
    return found.withColumn("ordered", ordered).withColumn("links", F.array_sort(F.transform(without_overlaps(F.col("ordered")), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["phrase"].alias("phrase"), x["value"].alias("value"))))).drop("spans", "ordered")


def phrase_hits(found: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """One row a place: ``keep``, ord, doc_id and phrase as it stands there."""
    said = cut_out(F.col(text), F.col("links"))
    each = found.select(*keep, F.transform("links", lambda x: x["value"]).alias("values"), said.alias("said"))
    return each.select(*keep, F.posexplode(F.arrays_zip("values", "said")).alias("ord", "x")).select(*keep, "ord", F.col("x.values").alias("doc_id"), F.col("x.said").alias("phrase"))


def phrase_markup(text: Column, found: Column, site: str = SITE) -> Column:
    """``text`` with links to the acts' own pages, everything else escaped."""
    return with_links(text, found, F.transform(found, lambda x: F.concat(F.lit(site), x["value"])))


def linked_phrases(nodes: DataFrame, phrases: DataFrame, least: int = 16, site: str = SITE) -> DataFrame:
    """``nodes`` with a ``render`` for the texts outside links, scripts and titles that hold a phrase."""
    from .dom import eligible_text

    found = phrase_links(nodes.where(eligible_text(1)).select("doc_key", "node_id", "text"), phrases, least).where(F.size("links") > 0)
    return nodes.join(found.select("doc_key", "node_id", phrase_markup(F.col("text"), F.col("links"), site).alias("render")), ["doc_key", "node_id"], "left")


def partial_phrases(blocks: DataFrame, own_links: DataFrame, phrases: DataFrame, n: int | None = None) -> DataFrame:
    """(doc_key, phrase, link_text): blocks with a phrase of which only a part is linked. ``n`` caps the report."""
    found = phrase_spans(blocks.select("doc_key", "block_id", "text"), phrases.select("phrase", F.col("phrase").alias("value")), words=False)
    near = found.select("doc_key", "block_id", F.explode(F.array_distinct(F.transform("spans", lambda x: x["phrase"]))).alias("phrase"))
    got = near.join(own_links.select("doc_key", "block_id", F.col("text").alias("link_text")), ["doc_key", "block_id"])
    got = got.where(F.lower("phrase").contains(F.lower("link_text")) & (F.length("link_text") > 0) & (F.lower("phrase") != F.lower("link_text"))).select("doc_key", "phrase", "link_text").distinct()
    return got if n is None else got.orderBy("doc_key", "phrase", "link_text").limit(n)


def overridden(pages: DataFrame, overrides: DataFrame, site: str = SITE) -> DataFrame:
    """``pages`` (code, html) with each override's anchor phrase linked in the first place of its find phrase.

    An override with a context marker needs it in the page; a find phrase whose anchor phrase is already linked there
    (a link's text ends in front of it or holds it) stays. A page's overrides are folded in the order of their ids.
    """
    mine = overrides.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("id", "find_phrase", "anchor_phrase", "doc_id", "anchor", "context_marker"))).alias("__o"))

    def once(text: Column, old: Column, new: Column) -> Column:
        at = F.instr(text, old)
        return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.length(old), F.length(text)))).otherwise(text)

    def put(html: Column, o: Column) -> Column:
        href = F.concat(F.when(F.coalesce(o["doc_id"], F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit(site), o["doc_id"])), F.coalesce(F.concat(F.lit("#"), F.nullif(o["anchor"], F.lit(""))), F.lit("")))
        link = F.concat(F.lit('<a href="'), F.replace(escape(href), F.lit('"'), F.lit("&quot;")), F.lit('">'), o["anchor_phrase"], F.lit("</a>"))
        linked = F.replace(o["find_phrase"], o["anchor_phrase"], F.concat(o["anchor_phrase"], F.lit("</a>")))
        ok = (o["context_marker"].isNull() | html.contains(o["context_marker"])) & ~html.contains(linked) & ~html.contains(F.concat(F.lit(">"), o["anchor_phrase"], F.lit("</a>")))
        return F.when(ok, once(html, o["find_phrase"], once(o["find_phrase"], o["anchor_phrase"], link))).otherwise(html)

    joined = pages.join(mine, "code", "left")
    return joined.withColumn("html", F.when(F.col("__o").isNull(), F.col("html")).otherwise(F.aggregate("__o", F.col("html"), put))).drop("__o")


def closed_remap(remap: DataFrame) -> DataFrame:
    """(old_id, new_id) of a remap with every act taken to the end of its chain; no new_id (null) for those that run into a cycle.

    Each round joins the table with itself, so that a step spans twice as many acts; a chain of n acts takes log2(n)
    rounds, and what still leads to a deprecated act after as many as the table could need is a cycle. Of several
    successors of one act the least counts; an act that is its own successor is a cycle.
    """
    now = written(remap.where("old_id is not null and new_id is not null").groupBy("old_id").agg(F.min("new_id").alias("new_id")), "remap")
    rounds = max(1, now.count()).bit_length()
    for _ in range(rounds):
        onward = now.select(F.col("old_id").alias("at"), F.col("new_id").alias("then"))
        met = written(now.join(onward, F.col("new_id") == F.col("at"), "left"), "remap")
        now = met.select("old_id", F.coalesce("then", "new_id").alias("new_id"))
        if met.where("at is not null").isEmpty():
            return now
    olds = now.select(F.col("old_id").alias("at"), F.lit(True).alias("again"))
    return now.join(olds, F.col("new_id") == F.col("at"), "left").select("old_id", F.when(F.col("again").isNull(), F.col("new_id")).alias("new_id"))


def remapped(rows: DataFrame, remap: DataFrame, articles: DataFrame | None = None, href: str = "href", site: str = SITE) -> DataFrame:
    """Links to a deprecated act point to the one at the end of its chain (``was`` keeps the old id); those of a cycle stay.

    Where ``articles`` (doc_id, article, anchor) are given, a link whose text names an article goes to that article of the
    new act; anchors of the old act mean nothing there, so other fragments go. rows: ``href`` and, for this, text.
    """
    joined = rows.withColumn("old_id", doc_of(F.col(href))).join(closed_remap(remap), "old_id", "left")
    to = F.concat(F.lit(site), "new_id")
    if articles is not None:
        number = F.nullif(F.regexp_extract("text", rf"{IU}{ART}\s+({NUM})", 1), F.lit(""))
        there = articles.groupBy(F.col("doc_id").alias("__of"), F.col("article").alias("__article")).agg(F.min("anchor").alias("__anchor"))
        joined = joined.withColumn("__n", number).join(there, (F.col("new_id") == F.col("__of")) & (F.col("__n") == F.col("__article")), "left")
        to = F.concat(to, F.coalesce(F.concat(F.lit("#"), "__anchor"), F.lit("")))
    moved = F.col("new_id").isNotNull()
    return joined.withColumn(href, F.when(moved, to).otherwise(F.col(href))).withColumn("was", F.when(moved, F.col("old_id"))).drop("old_id", "new_id", "__n", "__of", "__article", "__anchor")
