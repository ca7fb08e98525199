"""References in running text: phrase rules found in one Arrow pass, looked up by joins, folded by priority, written as links.

A pass over the texts (``find``) returns what each rule matches as offsets, with the keys that each link of a match may
point to, best first. Keys meet the anchors of their document in an equi-join on (doc_key, key); then every text folds
its own few matches: a match counts if its target is known and it overlaps none that a rule before it took. All state
(current article and point, what follows a text) comes from windows over a document.

Null texts match nothing; documents without maps get no links; repeated keys of a map count once (the least anchor);
empty tables give empty results.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.overlaps import cut_out, with_links, without_overlaps
from ..functions.text import ORDINALS, blank, collapse, escape
from ..sources.html import kept_nodes, serialize
from ..sources.shared import bucketed, written
from .anchors import article_anchors, chapter_anchors, ids_from_names, part_anchors, subpoint_anchors
from .dom import around, attr, element_texts, eligible_text, first_inside, heading_texts, in_note, inside_link, links, without_noise

NUM = r"\d+(?:-\d+)?"
ART = r"стат(?:ья|ьи|ье|ью|ьёй|ьей|ьями|ьям|ьях|ей)"
PUNKT = r"(?<!под)пункт(?:а|е|у|ом|ами|ам|ах|ов|ы)?"
SUB = r"подпункт(?:а|е|у|ом|ами|ам|ах|ов|ы)?"
PART = r"част(?:ь|и|ью|ей|ями|ям|ях)"
CHAPTER = r"глав(?:а|ы|е|у|ой|ами|ах)"
SEP = r"\s*(?:,|;|\bи\b|\bили\b|[-–—])\s*"
SELF = r"настоящ(?:ей|его|ему|им|ем)"
PNUM = rf"{NUM}\s*\)"
_LETTER = r"[^\W\d_]"
_STEMS = "|".join(sorted(ORDINALS, key=len, reverse=True))
_ORDINAL = rf"(?:{_STEMS})(?:ая|ой|ую|ый|ого|ому|ым|ом|ий|ья|ьей|ью|ье|ьего|ьему|ьим|ьем|ые|ых|ыми|ьи|ьих|ьими)\b"
#: No digit follows, and no full stop with a capital (that would be a heading).
_TAIL = r"(?![\d-])(?!\.\s*(?-i:[A-ZА-ЯЁ]))"


def _p(body: str) -> re.Pattern:
    return re.compile(rf"(?<![^\W_]){body}", re.I)


_LIST = rf"(?P<list>{PNUM}(?:{SEP}{PNUM})*)"
#: The rules in the order in which they take text; what their groups mean is in ``_links``.
RULES: dict[str, re.Pattern] = {
    "chapter": _p(rf"(?P<unit>{CHAPTER}\s+(?P<n>{NUM}))(?=\s+{SELF}\s+(?:кодекс|част))"),
    "subpoint": _p(rf"(?P<word>{SUB}\s+){_LIST},?\s+(?P<point>{PUNKT}\s+(?P<p>{NUM}))(?:\s*,\s*{PUNKT}\s+{NUM})*\s+(?P<art>{ART}\s+(?P<a>{NUM})){_TAIL}"),
    "point_article": _p(rf"{PUNKT}\s+{NUM}\)?(?:{SEP}{NUM}\))*(?:\s+{PART}\s+[\w-]+)?\s+{ART}\s+(?P<a>{NUM}){_TAIL}"),
    "points_article": _p(rf"{PUNKT}\s+{NUM}(?:{SEP}{NUM})*(?:\s+{PART}\s+[\w-]+)?\s+{ART}\s+(?P<a>{NUM}){_TAIL}"),
    "subpoints_article": _p(rf"{SUB}\s+{PNUM}(?:{SEP}{PNUM})*(?:\s+{PUNKT}\s+{NUM})?\s+{ART}\s+(?P<a>{NUM}){_TAIL}"),
    "articles": _p(rf"(?P<word>{ART}\s+)(?P<a>{NUM})(?P<rest>(?:{SEP}{NUM})+){_TAIL}"),
    "article": _p(rf"{ART}\s+(?P<a>{NUM}){_TAIL}"),
    "self_point": _p(rf"(?P<unit>{PUNKT}\s+(?P<n>{NUM}))\s+{SELF}\s+стат\w*"),
    "self_points": _p(rf"(?P<word>{PUNKT}\s+)(?P<bare>{NUM}(?:{SEP}{NUM})+)\s+{SELF}\s+стат\w*"),
    "self_dashed_part": _p(rf"(?P<unit>{PART}\s+(?P<n>\d+-\d+))"),
    "self_ordinal_part": _p(rf"(?P<unit>{PART}\s+(?P<ordinal>{_ORDINAL}))(?=\s+{SELF}\s+(?:стат|пункт))"),
    "self_dashed": _p(rf"(?P<unit>(?P<n>\d+-\d+))\s+{SELF}\s+стат\w*"),
    "self_parts": _p(rf"(?P<unit>(?P<n>\d+-\d+))(?=(?:\s*(?:,|и|или)\s*(?:{_ORDINAL}|\d+-\d+))+\s+{SELF}\s+стат)"),
    "same_part_subpoints": _p(rf"(?P<word>{PUNKT}\s+){_LIST}\s+{SELF}\s+част\w*"),
    "same_point_subpoints": _p(rf"(?P<word>{SUB}\s+){_LIST}(?:\s+{PART}\s+\S+)?\s+{SELF}\s+пункт\w*"),
    "self_subpoint": _p(rf"(?P<word>{SUB}\s+){_LIST}\s+(?P<point>{PUNKT}\s+(?P<p>{NUM}))\s+{SELF}\s+(?:стат|част|пункт)\w*"),
}
#: Stems without which a rule cannot match: looked for before its pattern is.
NEEDS = {
    "chapter": ("глав", "настоящ"), "subpoint": ("подпункт", "стат"), "point_article": ("пункт", "стат"), "points_article": ("пункт", "стат"), "subpoints_article": ("подпункт", "стат"), "articles": ("стат",), "article": ("стат",),
    "self_point": ("пункт", "настоящ"), "self_points": ("пункт", "настоящ"), "self_dashed_part": ("част",), "self_ordinal_part": ("част", "настоящ"), "self_dashed": ("настоящ",), "self_parts": ("настоящ",),
    "same_part_subpoints": ("пункт", "настоящ"), "same_point_subpoints": ("подпункт", "настоящ"), "self_subpoint": ("подпункт", "настоящ"),
}
#: A bare number behind a separator that no digit precedes, where articles are spoken of.
_BARE = re.compile(rf"(?:,\s*|;\s*|\s+и\s+)(?P<n>{NUM})(?=\s|,|;|\(| –| -|$)", re.I)
#: What follows a number that is a date or a term (fixed values).
_DATE = re.compile(r"\s+(?:янв|фев|мар|апр|мая|июн|июл|авг|сен|окт|ноя|дек|год|лет|месяц|раб|кален|процент)", re.I)
_POINT = re.compile(rf"(?:под)?пункт(?:ами|ом|а|е|у)?\s+{NUM}\)", re.I)
#: Characters before a bare number in which a point makes it a subpoint's.
AROUND = 100
_DASH = re.compile(rf"\s*[-–—]\s*({NUM})")

MATCH = "rule string, s int, e int, mode string, require string, links array<struct<s:int,e:int,keys:array<string>>>"
_LINK = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("keys", pa.list_(pa.string()))])
_MATCH = pa.struct([("rule", pa.string()), ("s", pa.int32()), ("e", pa.int32()), ("mode", pa.string()), ("require", pa.string()), ("links", pa.list_(_LINK))])
Match = tuple[str, int, int, str, str | None, list[tuple[int, int, list[str]]]]


def _listed(m: re.Match, group: str, keys: Callable[[str], list[str]], number: str = rf"({NUM})\s*\)") -> list[tuple[int, int, list[str]]]:
    """A link for each number of a list; the first takes the word in front of it along."""
    out, at = [], m.start(group)
    for k, x in enumerate(re.finditer(number, m[group])):
        out.append((m.start("word") if k == 0 else at + x.start(), at + x.end(), keys(x[1])))
    return out


def _links(rule: str, m: re.Match, article: str, part: str, detailed: bool) -> Match | None:
    """What a match of ``rule`` would link: (rule, start, end, mode, required key, links)."""
    g, whole = m.groupdict(), [(m.start(), m.end())]
    if rule == "chapter":
        return rule, m.start(), m.end(), "any", None, [(*m.span("unit"), [f"c:{g['n']}"])]
    if rule == "subpoint" and detailed:
        a, p = g["a"], g["p"]
        own = _listed(m, "list", lambda n: [f"s:{a}_{p}_{n}", f"s:{a}_{n}", f"a:{a}"])
        return rule, m.start(), m.end(), "any", f"a:{a}", [*own, (*m.span("point"), [f"s:{a}_{p}", f"a:{a}"]), (*m.span("art"), [f"a:{a}"])]
    if rule == "articles":
        only = _DASH.fullmatch(g["rest"])
        if only:
            named = f"a:{g['a']}-{only[1]}"  # an article of its own, or a range that counts by its start
            absent = "-" not in only[1] and int(only[1]) < int(g["a"].split("-")[0])
            return rule, m.start(), m.end(), "any", None, [(*whole[0], [named] if absent else [named, f"a:{g['a']}"])]
        if _DASH.match(g["rest"]):
            return rule, m.start(), m.end(), "any", None, [(*whole[0], [f"a:{g['a']}"])]
        at = m.start("rest")
        return rule, m.start(), m.end(), "any", None, [(m.start("word"), m.end("a"), [f"a:{g['a']}"]), *((at + x.start(), at + x.end(), [f"a:{x[0]}"]) for x in re.finditer(NUM, g["rest"]))]
    if "a" in g:
        return rule, m.start(), m.end(), "any", None, [(*whole[0], [f"a:{g['a']}"])]
    if rule == "self_points":
        return rule, m.start(), m.end(), "any", None, _listed(m, "bare", lambda n: [f"p:{article}_{n}"], f"({NUM})")
    if rule in ("same_part_subpoints", "same_point_subpoints"):
        return rule, m.start(), m.end(), "always", None, _listed(m, "list", lambda n: [f"s:{article}_{part}_{n}", f"s:{article}_{n}"])
    if rule == "self_subpoint":
        p = g["p"]
        return rule, m.start(), m.end(), "always", None, [*_listed(m, "list", lambda n: [f"s:{article}_{p}_{n}", f"s:{article}_{n}"]), (*m.span("point"), [f"s:{article}_{p}"])]
    number = g.get("n") or str(next(v for k, v in sorted(ORDINALS.items(), key=lambda x: -len(x[0])) if g["ordinal"].lower().startswith(k)))
    return rule, m.start(), m.end(), "any", None, [(*m.span("unit"), [f"p:{article}_{number}"])]


def matches_in(text: str | None, article: str | None, part: str | None, bare: bool, detailed: bool) -> list[Match]:
    """Matches of all rules, in the order of the rules; ``article`` and ``part`` are the text's own, ``bare`` whether its block speaks of articles."""
    out: list[Match] = []
    low = (text or "").lower()
    if not any(x in low for x in ("стат", "пункт", "част", "глав", "настоящ")) and not bare:
        return out
    for rule, pattern in RULES.items():
        if not all(x in low for x in NEEDS[rule]):
            continue
        own, same = rule.startswith("self_"), rule.startswith("same_")
        if (own and not article) or (same and not (article and part)) or ((same or rule == "self_subpoint") and not detailed):
            continue
        out += [x for m in pattern.finditer(text) if (x := _links(rule, m, article or "", part or "", detailed))]
    if bare or "стать" in low:
        for m in _BARE.finditer(text):
            s, e = m.span("n")
            if _DATE.match(text, e) or (m.start() and text[m.start() - 1].isdigit()):
                continue
            last = None
            for last in _POINT.finditer(text, max(0, s - AROUND), s):
                pass
            if last and "стать" not in low[last.end() : s] and not re.match(r"\s+части", low[last.end() :]):
                continue
            out.append(("bare", s, e, "any", None, [(s, e, [f"a:{m['n']}"])]))
    return out


# Units that a text ends with, in front of a link to an article

_ENDS_SUB = re.compile(rf"(?P<word>{SUB}\s+)(?P<list>{PNUM}(?:(?:\s*,\s*|\s*[–—-]\s*|\s+и\s+){PNUM})*)\s*$", re.I)
_ENDS_POINT = re.compile(rf"(?:,\s*|^\s*)(?P<unit>{PUNKT}\s+(?P<n>{NUM}))\s*$", re.I)
_ENDS_PART = re.compile(rf"(?P<unit>{PART}\s+(?P<n>\d+-\d+))\s*$", re.I)
_ENDS_BOTH = re.compile(rf"(?P<word>{SUB}\s+)(?P<list>{PNUM}(?:(?:\s*,\s*|\s+и\s+){PNUM})*)\s+(?P<point>{PUNKT}\s+(?P<p>{NUM}))\s*$", re.I)
#: Siblings within which a link to an article is looked for, and the next link to be widened.
NEAR, NEXT = 5, 4


def trailing_in(text: str | None, ahead: str | None, point: str | None, near: str | None) -> list[Match]:
    """What ``text`` ends with: subpoints of the article ``ahead`` (and its ``point``), or points and parts of the article ``near``."""
    text = text or ""
    if ahead and (m := _ENDS_SUB.search(text)):
        first = re.search(NUM, m["list"])[0]
        deep = [f"s:{ahead}_{point}_{first}"] if point else []

        def keys(n: str) -> list[str]:
            return [*([f"s:{ahead}_{point}_{n}"] if point else []), f"s:{ahead}_{n}", f"s:{ahead}_1_{n}"]

        return [("ends_subpoint", m.start(), m.end(), "first", None, _listed(m, "list", keys))] if deep or first else []
    if near and (m := _ENDS_POINT.search(text)):
        return [("ends_point", m.start(), m.end(), "any", f"a:{near}", [(*m.span("unit"), [f"s:{near}_{m['n']}", f"a:{near}"])])]
    if near and (m := _ENDS_PART.search(text)):
        return [("ends_part", m.start(), m.end(), "any", f"a:{near}", [(*m.span("unit"), [f"p:{near}_{m['n']}", f"s:{near}_{m['n']}", f"a:{near}"])])]
    if near and (m := _ENDS_BOTH.search(text)):
        own = _listed(m, "list", lambda n: [f"s:{near}_{m['p']}_{n}", f"s:{near}_{n}", f"a:{near}"])
        return [("ends_subpoint_point", m.start(), m.end(), "any", f"a:{near}", [*own, (*m.span("point"), [f"s:{near}_{m['p']}", f"a:{near}"])])]
    return []


def _found(rows: DataFrame, fn: Callable[..., list[Match]], *columns: str) -> DataFrame:
    """``rows`` (doc_key, node_id, text, …) with matches: what ``fn`` of ``columns`` returns; rows without one go."""
    keep = rows.columns
    at = [keep.index(c) for c in columns]
    names = ("rule", "s", "e", "mode", "require", "links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fn(*(b.column(i)[k].as_py() for i in at)) for k in range(b.num_rows)]
            hit = pa.array([bool(x) for x in found], pa.bool_())
            made = [[dict(zip(names, (*m[:5], [dict(zip(("s", "e", "keys"), x, strict=True)) for x in m[5]]), strict=True)) for m in ms] for ms in found if ms]
            yield pa.RecordBatch.from_arrays([*b.filter(hit).columns, pa.array(made, pa.list_(_MATCH))], [*keep, "matches"])

    kind = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    # The patterns cost more than moving the texts: they are dealt by node, so that few or long documents use all cores.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "doc_key", "node_id").mapInArrow(run, f"{kind}, matches array<struct<{', '.join(':'.join(x.split(' ', 1)) for x in re.split(r', (?=(?:s|e|mode|require|links) )', MATCH))}>>")


def accepted(found: DataFrame, maps: DataFrame) -> DataFrame:
    """``found`` with ``links`` (array of s, e, anchor, key, rule, whole) of the matches that count, in the order of the text.

    Also ``refused``: matches whose mode is first and whose first link has no target.
    """
    found = written(found, "matches")
    asked = F.array_distinct(F.flatten(F.transform("matches", lambda m: F.concat(F.flatten(F.transform(m["links"], lambda x: x["keys"])), F.array_compact(F.array(m["require"]))))))
    keys = found.select("doc_key", "node_id", F.explode(asked).alias("key"))
    known = keys.join(maps, ["doc_key", "key"]).groupBy("doc_key", "node_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "anchor"))).alias("known"))
    rows = found.join(known, ["doc_key", "node_id"], "left").withColumn("known", F.coalesce("known", F.create_map().cast("map<string,string>")))

    rows = rows.withColumn("wholes", cut_out(F.col("text"), F.col("matches")))

    def resolved(m: Column, i: Column) -> Column:
        def link(x: Column) -> Column:
            key = F.try_element_at(F.filter(x["keys"], lambda k: F.map_contains_key("known", k)), F.lit(1))
            whole = F.get("wholes", i)
            return F.struct(x["s"].alias("s"), x["e"].alias("e"), F.element_at("known", key).alias("anchor"), key.alias("key"), m["rule"].alias("rule"), whole.alias("whole"))

        return F.struct(m["s"].alias("s"), m["e"].alias("e"), m["rule"].alias("rule"), m["mode"].alias("mode"), m["require"].alias("require"), F.transform(m["links"], link).alias("links"))

    rows = rows.withColumn("matches", F.transform("matches", resolved))

    def counts(m: Column) -> Column:
        hit = F.exists(m["links"], lambda x: x["anchor"].isNotNull())
        good = F.when(m["mode"] == "always", True).when(m["mode"] == "first", m["links"][0]["anchor"].isNotNull()).otherwise(hit)
        return good & (m["require"].isNull() | F.map_contains_key("known", F.coalesce(m["require"], F.lit(""))))

    good = F.filter("matches", counts)
    rows = rows.withColumn("good", good)
    pieces = F.filter(F.flatten(F.transform(without_overlaps(F.col("good")), lambda m: m["links"])), lambda x: x["anchor"].isNotNull())
    refused = F.filter("matches", lambda m: (m["mode"] == "first") & m["links"][0]["anchor"].isNull())
    return rows.withColumn("links", F.array_sort(pieces)).withColumn("refused", refused).drop("matches", "known", "good", "wholes")


def rendered(text: Column, found: Column, doc: str = "") -> Column:
    """The markup of ``text`` with its links; everything else escaped."""
    return with_links(text, found, F.transform(found, lambda x: F.concat(F.lit(f"{doc}#"), x["anchor"])))


# Context, maps and passes


def context(nodes: DataFrame, asking: DataFrame | None = None) -> DataFrame:
    """(doc_key, node_id, article, part, bare) of all texts (article and part only of those ``asking``, if given).

    The article is that of the nearest heading before: an h3 around the text, or the last h3 or paragraph with an
    anchored bold heading among the elder siblings of an element around it, the innermost element first; what stands
    outside the innermost body, article or html but in front of it is not looked at. The part is that of the paragraph
    around the text: the number it begins with, the middle one of its own id (``z5_2_1``), or else the id's or number of
    the last elder sibling that has one; a heading in between ends the search. ``bare`` is whether the text's block
    speaks of articles.
    """
    key = ["doc_key", "node_id"]
    texts = nodes.where("kind = 'text'")
    asking = texts if asking is None else asking
    heard = ["h3", "p", "b"]
    said = element_texts(nodes, nodes.where(F.col("tag").isin(heard)).select(*key, "end_id"), heard)
    some = lambda pattern: F.nullif(F.regexp_extract("text_raw", pattern, 1), F.lit(""))
    said = said.select(*key, some(rf"(?iuU)Статья\s+({NUM})").alias("named"), F.col("text_raw").rlike(r"(?U)^\s*Статья\s+\d").alias("heads"), some(rf"(?U)^\s*({NUM})\.\s+\S").alias("number"))
    rows = nodes.select(*key, "parent_id", "end_id", "sib_pos", "tag", "attrs").join(said, key, "left")
    rows = rows.withColumn("anchored", first_inside((F.col("tag") == "a") & attr("name").isNotNull(), F.lit(True)))
    rows = rows.withColumn("bold", first_inside(F.col("tag") == "b", F.struct("named", "heads", "anchored")))
    is_p = F.col("tag") == "p"
    heading = F.when(F.col("tag") == "h3", F.col("named")).when(is_p & F.col("bold.anchored"), F.col("bold.named"))
    own = F.nullif(F.regexp_extract(attr("id"), rf"^z{NUM}_({NUM})_{NUM}$", 1), F.lit(""))
    stop = F.col("tag").isin("h1", "h2", "h3", "h4") | (is_p & F.coalesce("bold.heads", F.lit(False)))
    part = F.when(stop, F.struct(F.lit(None).cast("string").alias("v"))).when(is_p & F.coalesce(own, F.col("number")).isNotNull(), F.struct(F.coalesce(own, F.col("number")).alias("v")))
    w = Window.partitionBy("doc_key", "parent_id").orderBy("sib_pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.where("tag is not null").select(
        *key, "end_id", "tag",
        F.coalesce(F.when(F.col("tag") == "h3", F.col("named")), F.last(heading, True).over(w)).alias("article"),
        F.when(is_p, F.coalesce("number", own, F.last(part, True).over(w)["v"])).alias("part"),
    )
    rows = bucketed(rows, "places", "doc_key", "node_id")
    articles = rows.where(F.col("article").isNotNull() | F.col("tag").isin("body", "article", "html")).select(*key, "end_id", "article")
    parts = rows.where(F.col("tag").isin("p", "body", "article")).select(*key, "end_id", "part")
    asking = asking.select(*key)
    got = [around(nodes, asking, marks, nearest=True).select(*key, F.col(f"mark.{name}").alias(name)) for name, marks in (("article", articles), ("part", parts))]
    bare = F.max(F.lower("text").contains("стать")).over(Window.partitionBy("doc_key", "block_id"))
    return texts.withColumn("bare", bare).select(*key, "bare").join(got[0], key, "left").join(got[1], key, "left").select(*key, "article", "part", "bare")


#: An article of the act itself, also where markup parts the words from the number.
_SWEEP = re.compile(rf"(?<![^\W_]){ART}\s+(?P<n>{NUM})(?!\d)(?=\s+настоящ(?:его|ей|им|ему))", re.I)
#: Stands for a text that no link may be put into: no rule matches across it.
_CLOSED = "\ufffc"


def swept_in(texts: list[str]) -> list[list[tuple[int, int, str]]]:
    """For each of a block's texts, in order, what ``_SWEEP`` finds in all of them together: (start, end, article) of its share, no white space at its ends."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    ends = list(itertools.accumulate(map(len, texts)))
    for m in _SWEEP.finditer("".join(texts)):
        for k in range(bisect.bisect_right(ends, m.start()), bisect.bisect_left(ends, m.end()) + 1):
            begin = ends[k] - len(texts[k])
            s, e = max(m.start(), begin), min(m.end(), ends[k])
            share = texts[k][s - begin : e - begin]
            if share.strip():
                out[k].append((e - begin - len(share.lstrip()), s - begin + len(share.rstrip()), m["n"]))
    return out


def _swept(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc_key, node_id, swept) of the ``texts`` with a share in articles that are found in whole blocks; other texts part a block."""
    open_ = texts.select("doc_key", "node_id", F.lit(True).alias("open"))
    said = nodes.where("kind = 'text'").select("doc_key", "node_id", "block_id", "text", (blank(F.col("text")) & ~inside_link()).alias("gap")).join(open_, ["doc_key", "node_id"], "left")
    rows = said.groupBy("doc_key", "block_id").agg(F.array_sort(F.collect_list(F.struct("node_id", F.when(F.coalesce("open", "gap"), F.col("text")).otherwise(_CLOSED).alias("text")))).alias("ts"))  # one block's own
    whole = F.lower(F.array_join(F.transform("ts", lambda t: t["text"]), ""))
    rows = rows.where(whole.contains("стат") & whole.contains("настоящ")).select("doc_key", "ts")
    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("n", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, at, found = [], [], []
            for doc, ts in zip(b.column(0), b.column(1), strict=True):
                ts = ts.as_py()
                for t, shares in zip(ts, swept_in([t["text"] for t in ts]), strict=True):
                    if shares:
                        docs.append(doc.as_py()), at.append(t["node_id"]), found.append([dict(zip("sen", x, strict=True)) for x in shares])
            yield pa.RecordBatch.from_pydict({"doc_key": pa.array(docs, pa.string()), "node_id": pa.array(at, pa.int32()), "swept": pa.array(found, kind)})

    return rows.mapInArrow(run, "doc_key string, node_id int, swept array<struct<s:int,e:int,n:string>>")


def _with_swept(text: str | None, article: str | None, part: str | None, bare: bool, detailed: bool, swept: list[dict] | None) -> list[Match]:
    more = [("sweep", x["s"], x["e"], "any", None, [(x["s"], x["e"], [f"a:{x['n']}"])]) for x in swept or []]
    return matches_in(text, article, part, bare, detailed) + more


def link_keys(articles: DataFrame | None = None, subpoints: DataFrame | None = None, parts: DataFrame | None = None, chapters: DataFrame | None = None) -> DataFrame:
    """(doc_key, key, anchor) of the maps (doc_key, key, anchor) that are given; keys tell the maps apart by a letter."""
    named = [(n, m) for n, m in zip("aspc", (articles, subpoints, parts, chapters), strict=True) if m is not None]
    rows = None
    for n, m in named:
        one = m.select("doc_key", F.concat(F.lit(f"{n}:"), F.col("key").cast("string")).alias("key"), "anchor")
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("doc_key", "key").agg(F.min("anchor").alias("anchor"))


def act_keys(nodes: DataFrame) -> DataFrame:
    """``link_keys`` of the documents' own anchors."""
    parts = part_anchors(nodes).select("doc_key", F.concat_ws("_", "article", "part").alias("key"), "anchor")
    return link_keys(article_anchors(nodes).select("doc_key", F.col("article").alias("key"), "anchor"), subpoint_anchors(nodes).select("doc_key", "key", "anchor"), parts, chapter_anchors(nodes).select("doc_key", F.col("chapter").alias("key"), "anchor"))


def find_references(nodes: DataFrame, maps: DataFrame, include_notes: bool = False, bare: bool = True, sweep: bool = False) -> DataFrame:
    """Texts with references: (doc_key, node_id, text, article, part, links, …); ``maps`` is a ``link_keys`` table.

    With ``sweep`` articles of the act itself are also found across the texts of a block, so that «статьи <i>5</i>
    настоящего Кодекса» is linked, each text its own share, where no rule before took it.
    """
    # A share of a phrase may be a single digit; the rules themselves look at no text under three characters.
    texts = without_noise(nodes).where(eligible_text(1 if sweep else 3)).join(heading_texts(nodes), ["doc_key", "node_id"], "left_anti")
    if not include_notes:
        texts = texts.join(in_note(nodes), ["doc_key", "node_id"], "left_anti")
    texts = bucketed(texts.select("doc_key", "node_id", "text"), "texts", "doc_key", "node_id")
    has = maps.groupBy("doc_key").agg(F.max(F.col("key").startswith("s:")).alias("detailed"))
    low = F.lower("text")  # only rules with these stems ask for the article or the part
    rows = texts.join(context(nodes, texts.where(low.contains("настоящ") | low.contains("част"))), ["doc_key", "node_id"], "left").join(has, "doc_key")
    rows = rows.withColumn("bare", F.coalesce("bare", F.lit(False)) & F.lit(bare) & (F.length(collapse(F.col("text"))) >= 3))
    if sweep:
        rows = rows.join(_swept(nodes, texts), ["doc_key", "node_id"], "left")
        found = _found(rows, _with_swept, "text", "article", "part", "bare", "detailed", "swept").drop("swept")
    else:
        found = _found(rows, matches_in, "text", "article", "part", "bare", "detailed")
    return accepted(found, maps).where(F.size("links") > 0)


def references(found: DataFrame, doc: str = "") -> DataFrame:
    """One row a link: (doc_key, node_id, ord, rule, original, whole, start, end, article, anchor, href, context)."""
    spread = found.withColumn("__around", F.transform("links", lambda x: F.struct(F.greatest(F.lit(0), x["s"] - 40).alias("s"), (x["e"] + 40).alias("e"))))
    spread = spread.withColumn("said", cut_out(F.col("text"), F.col("links"))).withColumn("near", cut_out(F.col("text"), F.col("__around")))
    each = spread.select("doc_key", "node_id", F.posexplode(F.arrays_zip("links", "said", "near")).alias("ord", "z")).select("doc_key", "node_id", "ord", F.col("z.links").alias("x"), F.col("z.said").alias("said"), F.col("z.near").alias("near"))
    around, said = collapse(F.col("near")), F.col("said")
    article = F.when(~F.col("x.key").startswith("c:"), F.regexp_extract("x.key", r"^[asp]:(\d+(?:-\d+)?)", 1))
    return each.select("doc_key", "node_id", "ord", F.col("x.rule").alias("rule"), said.alias("original"), F.col("x.whole").alias("whole"), F.col("x.s").alias("start"), F.col("x.e").alias("end"), article.alias("article"), F.col("x.anchor").alias("anchor"), F.concat(F.lit(f"{doc}#"), "x.anchor").alias("href"), around.alias("context"))


def linked_nodes(nodes: DataFrame, found: DataFrame, doc: str = "") -> DataFrame:
    """``nodes`` with ``render`` set where references were found: the text with its links, everything else escaped."""
    shown = found.select("doc_key", "node_id", rendered(F.col("text"), F.col("links"), doc).alias("render"))
    return nodes.join(shown, ["doc_key", "node_id"], "left")


def trailing_units(nodes: DataFrame, maps: DataFrame) -> DataFrame:
    """Texts that end with units of an article linked after them, with links and refused; also next_id, the link that may be widened."""
    w = Window.partitionBy("doc_key", "parent_id").orderBy(F.desc("sib_pos")).rowsBetween(Window.unboundedPreceding, -1)
    said = links(nodes).select("doc_key", "node_id", "href", F.col("text").alias("said"))
    rows = nodes.where("kind <> 'comment'").join(said, ["doc_key", "node_id"], "left")
    is_a, is_text = F.col("said").isNotNull(), F.col("kind") == "text"
    some = lambda c: F.nullif(c, F.lit(""))
    of = lambda c, p: some(F.regexp_extract(c, rf"(?iuU){p}", 1))
    speaks = is_a & F.lower("said").contains("стать")
    by_text = of("text", rf"стать\w+\s+({NUM})")
    article = F.when(speaks, F.coalesce(of("said", rf"стать\w*\s+({NUM})"), of("href", rf"#z({NUM})$"))).when(is_text, F.coalesce(by_text, F.when(F.col("text").rlike(r"(?iuU)настоящей\s+стать"), F.lit("self"))))
    point = F.when(is_a & ~speaks, of("said", rf"пункт\w*\s+({NUM})")).when(is_text, of("text", rf"пункт\w*\s+({NUM})"))
    last = F.when(speaks, of("said", rf"({NUM})\s*$"))
    at = lambda value: F.last(F.when(value.isNotNull(), F.struct(F.col("sib_pos").alias("at"), value.alias("v"))), True).over(w)
    significant = F.when(is_a | (is_text & F.col("text").rlike(r"(?U)\S")), F.when(is_a, F.col("node_id")).otherwise(-1))
    rows = rows.select("doc_key", "node_id", "kind", "tags", "sib_pos", "text", at(article).alias("ahead"), at(point).alias("point"), at(last).alias("near"), at(significant).alias("next"))
    own = rows.where((F.col("kind") == "text") & ~inside_link()).join(in_note(nodes), ["doc_key", "node_id"], "left_anti").join(context(nodes, rows.where("ahead.v = 'self'")).select("doc_key", "node_id", "article"), ["doc_key", "node_id"], "left")
    ahead = F.when(F.col("ahead.v") == "self", F.col("article")).otherwise(F.col("ahead.v"))
    close = lambda c, n: F.col(f"{c}.at") - F.col("sib_pos") <= n
    own = own.select(
        "doc_key", "node_id", "text", ahead.alias("ahead"), F.when(F.col("point.at") <= F.col("ahead.at"), F.col("point.v")).alias("point"), F.when(close("near", NEAR), F.col("near.v")).alias("near"),
        F.when(close("next", NEXT) & (F.col("next.v") >= 0), F.col("next.v")).alias("next_id"),
    )
    return accepted(_found(own, trailing_in, "text", "ahead", "point", "near"), maps)


def with_trailing(nodes: DataFrame, found: DataFrame, doc: str = "") -> DataFrame:
    """``nodes`` with what ``trailing_units`` found: links in the texts; a unit without a target moves into the link after it."""
    moved = (F.size("links") == 0) & (F.size("refused") > 0) & F.col("next_id").isNotNull()
    first = F.col("refused")[0]["s"]
    shown = found.where((F.size("links") > 0) | moved).select("doc_key", "node_id", F.when(moved, escape(F.substring(F.col("text"), F.lit(1), first))).otherwise(rendered(F.col("text"), F.col("links"), doc)).alias("render"))
    lead = found.where(moved).select("doc_key", F.col("next_id").alias("node_id"), F.substring(F.col("text"), first + 1, F.length("text")).alias("lead"))
    return nodes.join(shown, ["doc_key", "node_id"], "left").join(lead, ["doc_key", "node_id"], "left")


def linked_pages(pages: DataFrame, maps: DataFrame | None = None, doc: str = "", include_notes: bool = False, sweep: bool = False) -> DataFrame:
    """(doc_key, html): ``pages`` with all references linked: the rules, then units in front of links, then ids for named anchors.

    ``maps`` is a ``link_keys`` table; without one the documents' own anchors serve.
    """
    nodes = kept_nodes(pages, "doc_key", "html")
    maps = written(act_keys(nodes) if maps is None else maps, "link-keys")
    once = kept_nodes(serialize(linked_nodes(nodes, find_references(nodes, maps, include_notes, sweep=sweep), doc)), "doc_key", "html")
    twice = with_trailing(once, trailing_units(once, maps), doc)
    return serialize(ids_from_names(twice))


def top_changes(changes: DataFrame, n: int = 10) -> DataFrame:
    """The articles linked to most often."""
    return changes.groupBy("article").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "article").limit(n)
