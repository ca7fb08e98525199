"""Small acts written out by hand, one of each a supplier, with what every operator must make of them.

A case is a name, a page and the rows expected of it. ``{n}`` in a page and in its rows is the supplier's key, ``{long}``
a passage of some thousand characters. The rows are the SQL side: they come from reading the page, not from running
an operator. Every query runs all cases of its list for every row of the whole table.
"""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LONG, TIMES, END = "слово ", 400, "конец"


class Case(NamedTuple):
    name: str
    html: str
    rows: list[tuple[Any, ...]]


def _filled(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("{n}"), F.col("n")), F.lit("{long}"), F.concat(F.repeat(F.lit(LONG), TIMES), F.lit(END)))


def pages(spark: SparkSession, sf_dir: str, cases: list[Case]) -> DataFrame:
    """(doc_key, html) of all cases for all suppliers."""
    each = F.array(*(F.struct(F.lit(c.name).alias("name"), F.lit(c.html).alias("html")) for c in cases))
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("string").alias("n"), F.explode(each).alias("c"))
    return rows.select(F.concat_ws("-", "n", "c.name").alias("doc_key"), _filled(F.col("c.html")).alias("html"))


def table(spark: SparkSession, sf_dir: str, columns: str, rows: list[tuple[Any, ...]]) -> DataFrame:
    """``rows`` with ``columns`` (a schema) for all suppliers, strings filled."""
    few = F.broadcast(spark.createDataFrame(rows, columns).withColumn("__one", F.lit(1)))
    own = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("string").alias("n"), F.lit(1).alias("__one"))
    got = own.join(few, "__one").drop("__one")
    return got.select(*(_filled(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in few.drop("__one").dtypes))


def _value(x: Any) -> str:
    if x is None:
        return "NULL"
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)


def sql(cases: list[Case], columns: str, key: bool = True) -> str:
    """SQL of the expected rows: doc_key (if ``key``) and ``columns`` (names with DuckDB types) for all suppliers."""
    named = [c.split() for c in columns.split(", ")]
    values = ", ".join("(" + ", ".join(_value(x) for x in (c.name, *row)) + ")" for c in cases for row in c.rows)
    filled = [f"replace(replace({n}, '{{n}}', s_suppkey::VARCHAR), '{{long}}', repeat('{LONG}', {TIMES}) || '{END}') AS {n}" if t == "VARCHAR" else f"{n}::{t} AS {n}" for n, t in named]
    head = ["s_suppkey || '-' || __case AS doc_key"] if key else []
    return f"SELECT {', '.join([*head, *filled])} FROM supplier CROSS JOIN (VALUES {values}) v(__case, {', '.join(n for n, _ in named)})"


# Finding and linking references

_ACT = (
    '<html><body><h2 id="c3">Глава 3. Общее</h2><h3 id="z200">Статья 7-1. Вторая</h3><p id="z201">1. Текст.</p><h3 id="z300">Статья 30{n}. Третья</h3><p>Иное.</p>'
    '<h3 id="z100">Статья 5. Первая</h3><p id="z104">2. Пункт два.</p><p id="z105">2-1. Пункт два-один.</p><p id="z101">1. Пункт один.</p><p id="z102">1) подпункт один;</p><p id="z103">2) подпункт два;</p>'
)


def _linked(name: str, body: str, *links: tuple[str, str]) -> Case:
    return Case(name, f"{_ACT}<p>{body}</p></body></html>", [(k, text, href) for k, (text, href) in enumerate(links)])


LINKED = [
    _linked("chapter", "как в главе 3 настоящего Кодекса", ("главе 3", "#c3")),
    _linked("chapter_unknown", "как в главе 4 настоящего Кодекса"),
    _linked("chapter_other", "как в главе 3 закона"),
    _linked("subpoint", "подпунктами 1), 2) пункта 1 статьи 5 закона", ("подпунктами 1)", "#z102"), ("2)", "#z103"), ("пункта 1", "#z101"), ("статьи 5", "#z100")),
    _linked("subpoint_falls_back", "подпунктом 9) пункта 8 статьи 5 закона", ("подпунктом 9)", "#z100"), ("пункта 8", "#z100"), ("статьи 5", "#z100")),
    _linked("subpoint_unknown", "подпунктом 1) пункта 1 статьи 77 закона"),
    _linked("point_article", "по пункту 1 статьи 30{n} закона", ("пункту 1 статьи 30{n}", "#z300")),
    _linked("point_part_article", "по пункту 1 части первой статьи 30{n} закона", ("пункту 1 части первой статьи 30{n}", "#z300")),
    _linked("points_article", "в пунктах 1, 2 статьи 30{n} и далее", ("пунктах 1, 2 статьи 30{n}", "#z300")),
    _linked("points_unknown", "в пунктах 1, 2 статьи 77 и далее"),
    _linked("subpoints_article", "в подпунктах 1), 2) статьи 30{n} закона", ("подпунктах 1), 2) статьи 30{n}", "#z300")),
    _linked("articles", "статьями 5, 12 и 30{n} закона", ("статьями 5", "#z100"), ("30{n}", "#z300")),
    _linked("articles_range", "статьями 5-9 закона", ("статьями 5-9", "#z100")),
    _linked("articles_of_its_own", "статья 7-1 закона", ("статья 7-1", "#z200")),
    _linked("articles_absent", "статьёй 5-2 закона"),
    _linked("article", "согласно статье 30{n} закона", ("статье 30{n}", "#z300")),
    _linked("article_heading", "см. статья 30{n}. Заголовок"),
    _linked("article_unknown", "согласно статье 88 закона"),
    _linked("self_point", "пунктом 2 настоящей статьи", ("пунктом 2", "#z104")),
    _linked("self_point_unknown", "пунктом 6 настоящей статьи"),
    _linked("self_points", "пунктами 1, 2 и 8 настоящей статьи", ("пунктами 1", "#z101"), ("2", "#z104")),
    _linked("self_dashed_part", "частью 2-1 закона", ("частью 2-1", "#z105")),
    _linked("self_ordinal_part", "частью второй настоящей статьи", ("частью второй", "#z104")),
    _linked("self_ordinal_unknown", "частью седьмой настоящей статьи"),
    _linked("self_dashed", "согласно 2-1 настоящей статьи", ("2-1", "#z105")),
    _linked("self_parts", "частями первой, 2-1 или второй настоящей статьи", ("2-1", "#z105")),
    _linked("same_part_subpoints", "в пунктах 1), 2) настоящей части", ("пунктах 1)", "#z102"), ("2)", "#z103")),
    _linked("same_point_subpoints", "подпунктами 1) и 2) настоящего пункта", ("подпунктами 1)", "#z102"), ("2)", "#z103")),
    _linked("self_subpoint", "подпунктом 2) пункта 1 настоящей статьи", ("подпунктом 2)", "#z103"), ("пункта 1", "#z101")),
    _linked("bare", "в статье 88 (часть), 30{n} закона", ("30{n}", "#z300")),
    _linked("bare_date", "в статье 88 (часть), 5 января"),
    _linked("bare_fraction", "в статье 88 о 6, 5 закона"),
    _linked("bare_point", "в статье 88, пункта 3) (часть), 5 закона"),
    _linked("bare_by_block", "статья <b>закона</b> (часть), 5 далее", ("5", "#z100")),
    _linked("bare_without", "иное <b>закона</b> (часть), 5 далее"),
    _linked("note_text", "Сноска. Статья 5 закона"),
    _linked("note_span", '<span class="note">по статье 5 закона</span>'),
    _linked("note_before", "Примечание. <b>Иное</b> по статье 5 закона"),
    _linked("in_link", '<a href="#q">статья 5 закона</a>', ("статья 5 закона", "#q")),
    _linked("in_bold_heading", "<b>Статья 5 закона</b>"),
    _linked("escaped", "a &lt; b &amp; c, по статье 5 &lt;закона&gt;", ("статье 5", "#z100")),
    _linked("ends_subpoint", 'подпунктом 2) <a href="#z101">пункта 1</a> <a href="#z100">статьи 5</a>', ("подпунктом 2)", "#z103"), ("пункта 1", "#z101"), ("статьи 5", "#z100")),
    _linked("ends_subpoint_self", 'подпунктом 2) <a href="#z101">пункта 1</a> настоящей статьи', ("подпунктом 2)", "#z103"), ("пункта 1", "#z101")),
    _linked("ends_subpoint_widens", 'подпунктом 9) <a href="https://example.org/docs/K1#z1">статьи 3</a>', ("подпунктом 9) статьи 3", "https://example.org/docs/K1#z1")),
    _linked("ends_point", 'нормы, пунктом 2 <a href="#z100">статьи 5</a>', ("пунктом 2", "#z104"), ("статьи 5", "#z100")),
    _linked("ends_part", 'нормы части 3-1 <a href="#z100">статьи 5</a>', ("части 3-1", "#z100"), ("статьи 5", "#z100")),
    _linked("ends_subpoint_point", 'по подпунктам 1), 2) пункта 1 <a href="#z100">статьи 5</a>', ("подпунктам 1)", "#z102"), ("2)", "#z103"), ("пункта 1", "#z101"), ("статьи 5", "#z100")),
    _linked("ends_without_link", "нормы, пунктом 2 статьи"),
    # The article and the part that a text stands in: what a body says behind the paragraph that ``_linked`` opens.
    _linked("article_by_anchored_bold", 'иное</p><p><b><a name="z300"></a>Статья 30{n}. Имя</b></p><p>пунктом 2 настоящей статьи'),
    _linked("article_by_plain_bold", "иное</p><p><b>Статья 30{n}. Имя</b></p><p>пунктом 2 настоящей статьи", ("пунктом 2", "#z104")),
    _linked("article_inside_its_heading", "иное</p><h3><i>Статья 30{n}</i></h3><p>пунктом 2 настоящей статьи"),
    _linked("article_of_the_inner_element", "иное</p><div><h3>Статья 30{n}. Имя</h3><p>иное</p></div><p>пунктом 2 настоящей статьи", ("пунктом 2", "#z104")),
    _linked("article_outside_the_div", "иное</p><div><p>пунктом 2 настоящей статьи</p></div><p>", ("пунктом 2", "#z104")),
    _linked("article_beyond_an_article", "иное</p><div><article><p>пунктом 2 настоящей статьи</p></article></div><p>"),
    _linked("part_by_its_number", "2. Иное</p><p>1. в подпунктах 1), 2) настоящего пункта", ("подпунктах 1)", "#z102"), ("2)", "#z103")),
    _linked("part_of_an_id", 'иное</p><p id="z5_1_7">иное</p><p>подпунктами 1) и 2) настоящего пункта', ("подпунктами 1)", "#z102"), ("2)", "#z103")),
    _linked("part_ends_at_heading", "иное</p><h4>Заголовок</h4><p>подпунктами 1) и 2) настоящего пункта"),
    _linked("part_ends_at_bold_heading", "иное</p><p><b>Статья 30{n}. Имя</b></p><p>подпунктами 1) и 2) настоящего пункта"),
    _linked("part_of_no_paragraph", "иное</p>подпунктами 1) и 2) настоящего пункта<p>"),
]
#: The same acts where articles are looked for across the texts of a block.
SWEPT = [
    _linked("across_markup", "по статье <i>5</i> настоящего Кодекса", ("статье", "#z100"), ("5", "#z100")),
    _linked("number_and_all_apart", "по <b>статье</b> <i>30{n}</i> настоящего Кодекса", ("статье", "#z300"), ("30{n}", "#z300")),
    _linked("unknown_article", "по статье <i>88</i> настоящего Кодекса"),
    _linked("of_another_act", "по статье <i>5</i> закона"),
    _linked("parted_by_a_link", 'по статье <a href="#q">5</a> настоящего Кодекса', ("5", "#q")),
    _linked("other_block", "по статье</p><p>5 настоящего Кодекса"),
    _linked("taken_before", "по статье 5 настоящего <i>Кодекса</i>", ("статье 5", "#z100")),
]

# Headings and structured pages: pos, kind, type, number, anchor, parent_pos

_SECTIONS = (
    '<html><head><title>t</title></head><body><nav>до</nav><article><h2 id="a1">ОБЩАЯ ЧАСТЬ</h2><h3 id="a2">РАЗДЕЛ II. Общие</h3><h3 id="a3">ПОДРАЗДЕЛ 1. Под</h3><h3>Глава 1. Гл</h3><h3>Параграф 2. Пар</h3>'
    '<h4>Подглава 3. Пг</h4><p><b><a name="z{n}"></a>Статья 1. Имя</b></p><p>Текст <i>и</i> <a href="#z{n}">ссылка &lt;{n}&gt;</a></p>текст вне<h3 id="a4">ОСОБЕННАЯ ЧАСТЬ РАЗДЕЛ 3. Иное Глава 4-1. Ещё</h3>'
    '<h3 id="a5">СТАТЬИ 5. Имя</h3><table id="t1"><tr><td>1</td></tr></table><h3 id="a6">РАЗДЕЛ 7 <a name="zc8"></a>Глава 8. Восьмая</h3><h3 id="a9">ОСНОВНЫЕ ПРАВИЛА Глава 9. Девятая</h3>'
    '<h3 id="b1">Часть 2. Вторая</h3><h3 id="b2">Просто заголовок</h3><div>Глава 10. не заголовок</div></article><p>после</p></body></html>'
)
SECTIONS = [
    Case(
        "all",
        _SECTIONS,
        [
            (0, "structural", "part", None, "a1", None), (1, "structural", "section", "2", "a2", 0), (2, "structural", "subsection", "1", "a3", 1), (3, "structural", "chapter", "1", None, 2),
            (4, "structural", "paragraph", "2", None, 3), (5, "structural", "subchapter", "3", None, 4), (6, "structural", "article", "1", "z{n}", 5), (7, "content", None, None, None, 6), (8, "content", None, None, None, 6),
            (9, "structural", "part", None, "a4", None), (10, "virtual", "section", "3", None, 9), (11, "virtual", "chapter", "4-1", None, 10), (12, "structural", "article", "5", "a5", 11), (13, "content", None, None, "t1", 12),
            (14, "structural", "section", "7", "a6", 9), (15, "structural", "chapter", "8", "zc8", 14), (16, "content", None, None, "a9", 15), (17, "structural", "chapter", "9", "a9_chapter9", 14),
            (18, "structural", "part", "2", "b1", None), (19, "content", None, None, "b2", 18), (20, "content", None, None, None, 18),
        ],
    ),
    Case("longest", "<article>коротко</article><article><h3>Глава {n}. Длинная</h3></article>", [(0, "structural", "chapter", "{n}", None, None)]),
    Case("none", "<p>Глава 1. Без статьи</p>", []),
]
#: Wrappers of the page that is written: ord, type, number, id, around (the number or label of the wrapper around it).
WRAPPERS = [
    Case(
        "all",
        _SECTIONS,
        [
            (0, "часть", None, "w_a1", None), (1, "раздел", "2", "w_a2", "часть"), (2, "подраздел", "1", "w_a3", "раздел"), (3, "глава", "1", None, "подраздел"), (4, "параграф", "2", None, "глава"), (5, "подглава", "3", None, "параграф"),
            (6, "статья", "1", "w_z{n}", "подглава"), (7, "часть", None, "w_a4", None), (8, "раздел", "3", None, "часть"), (9, "глава", "4-1", None, "раздел"), (10, "статья", "5", "w_a5", "глава"),
            (11, "раздел", "7", "w_a6", "часть"), (12, "глава", "8", "w_zc8", "раздел"), (13, "глава", "9", "w_a9_chapter9", "раздел"), (14, "часть", "2", "w_b1", None),
        ],
    ),
]
#: What else must still be there: tag, own id or name or href, how often.
KEPT = [
    Case("all", _SECTIONS, [("a", "#z{n}", 1), ("a", "z{n}", 1), ("a", "zc8", 1), ("table", "t1", 1), ("td", None, 1), ("i", None, 1), ("nav", None, 1), ("title", None, 1), ("h3", "a6", 1), ("h3", "a9", 1), ("h3", "a9_chapter9", 1), ("span", None, 2), ("h4", None, 1)]),
]

# Merging of neighbouring links: ord, kind, text, keep, dropped

def _p(body: str) -> str:
    return f"<html><body><p>{body}</p></body></html>"


def _a(href: str, text: str) -> str:
    return f'<a href="{href}">{text}</a>'


MERGES = [
    Case("forward", _p(f"см. {_a('#p1', 'пункт 1')} статьи {{n}} закона"), [(0, "forward", "пункт 1 статьи {n}", "#p1", None)]),
    Case("forward_markup", _p('<a href="#p1"><b>пункт</b> 1</a> статьи {n}'), [(0, "forward", "пункт 1 статьи {n}", "#p1", None)]),
    Case("backward", _p(f"по подпункту 3) пункта 2 {_a('#z{n}', 'статьи {n}')}"), [(0, "backward", "подпункту 3) пункта 2 статьи {n}", "#z{n}", None)]),
    Case("backward_qualifier", _p(f"по частью второй {_a('#p3', 'пункта 3')}"), [(0, "backward", "частью второй пункта 3", "#p3", None)]),
    Case("merge", _p(f"{_a('#p1', 'пункт 1')} {_a('#z{n}', 'статьи {n}')} закона"), [(0, "merge", "пункт 1 статьи {n}", "#p1", "#z{n}")]),
    Case("range_plain", _p(f"статей {_a('#z5', '5')}-9{{n}} закона"), [(0, "range", "5-9{n}", "#z5", None)]),
    Case("range_link", _p(f"статей {_a('#z5', '5')} – {_a('#z{n}', '{n}')} закона"), [(0, "range", "5 – {n}", "#z5", "#z{n}")]),
    Case("complex", _p(f"{_a('#p1', 'пункт 1')} {_a('#p2', 'пункт 2')} {_a('#z{n}', 'статьи {n}')}"), [(0, "complex", "пункт 2 статьи {n}", "#p2", None)]),
    # One merge makes the next possible: the part goes to the point, then both take the article.
    Case("again", _p(f"по частью второй {_a('#p3', 'пункта 3')} статьи {{n}} закона"), [(0, "backward", "частью второй пункта 3", "#p3", None), (1, "forward", "частью второй пункта 3 статьи {n}", "#p3", None)]),
    Case("nothing", _p(f"{_a('#z{n}', 'статьи {n}')} и {_a('#q', 'иное')} закона"), []),
]
#: The same pages after merging: ord, text, href of the links that are left.
MERGED = [
    Case(c.name, c.html, [(k, t, h) for k, (t, h) in enumerate(links)])
    for c, links in zip(
        MERGES,
        [
            [("пункт 1 статьи {n}", "#p1")], [("пункт 1 статьи {n}", "#p1")], [("подпункту 3) пункта 2 статьи {n}", "#z{n}")], [("частью второй пункта 3", "#p3")], [("пункт 1 статьи {n}", "#p1")], [("5-9{n}", "#z5")],
            [("5 – {n}", "#z5")], [("пункт 1", "#p1"), ("пункт 2", "#p2"), ("статьи {n}", "#z{n}")], [("частью второй пункта 3 статьи {n}", "#p3")], [("статьи {n}", "#z{n}"), ("иное", "#q")],
        ],
        strict=True,
    )
]
#: Chains: text, keep, terminal, dropped (how many).
_OUT = "https://example.org/docs/K150000000{n}#z"
CHAINED = [
    Case("link", _p(f"{_a('#p1', 'пунктами 1')}, {_a('#p2', '2')} и {_a('#p3', '3')} {_a('#z{n}', 'статьи {n}')}"), [("пунктами 1, 2 и 3 статьи {n}", "#p1", "link", 3)]),
    Case("plain", _p(f"{_a('#p1', 'частями первой')} и {_a('#p2', 'второй')} статьи {{n}} закона"), [("частями первой и второй статьи {n}", "#p1", "plain", 1)]),
    Case("external", _p(f"{_a(_OUT + '1', 'пунктами 1')} и {_a(_OUT + '2', '2')} {_a(_OUT + '3', 'статьи {n}')}"), [("пунктами 1 и 2 статьи {n}", _OUT + "1", "link", 2)]),
    Case("external_plain", _p(f"{_a(_OUT + '1', 'пунктами 1')} и {_a(_OUT + '2', '2')} статьи {{n}}"), []),
    Case("mixed", _p(f"{_a('#p1', 'пунктами 1')} и {_a(_OUT + '2', '2')} {_a('#z{n}', 'статьи {n}')}"), []),
    Case("one_unit", _p(f"{_a('#p1', 'пункт 1')} {_a('#z{n}', 'статьи {n}')}"), []),
    Case("other_word", _p(f"{_a('#p1', 'пунктами 1')} кроме {_a('#p2', '2')} {_a('#z{n}', 'статьи {n}')}"), []),
    Case("bare_head", _p(f"{_a('#p1', '1')} и {_a('#p2', '2')} {_a('#z{n}', 'статьи {n}')}"), []),
]

# Predicates over nodes

NOTES = [  # text, narrow, wide
    Case("span", '<p><span class="a note">в {n}</span> вне</p>', [("в {n}", True, True), (" вне", False, False)]),
    Case("red", '<p><font color="#FF0000">Примечание ИЗПИ! {n}</font></p>', [("Примечание ИЗПИ! {n}", True, True)]),
    Case("red_only", '<p><font color="#ff0000">иное {n}</font></p>', [("иное {n}", False, False)]),
    Case("own", "<p>Сноска. К статье {n}</p>", [("Сноска. К статье {n}", False, True)]),
    Case("sibling", "<p><i>Сноска. К {n}</i> после <b>и в</b></p>", [("Сноска. К {n}", False, True), (" после ", False, True), ("и в", False, False)]),
    Case("block", "<p>до {n} <i>Сноска. x</i></p>", [("до {n} ", False, True), ("Сноска. x", False, True)]),
    Case("div", "<div>до {n} <i>Сноска. x</i></div>", [("до {n} ", False, False), ("Сноска. x", False, True)]),
    Case("long_block", "<p>{long}<i>Сноска. x</i></p>", [("{long}", False, False), ("Сноска. x", False, True)]),
    Case("none", "<p>просто {n}</p>", [("просто {n}", False, False)]),
]
TEXTS = [  # text, noise_free, in_link, eligible, in_heading
    Case(
        "all",
        '<head><title>имя {n}</title><style>a{}</style></head><body><script>var {n};</script><p>текст {n} <a href="#x">связь <b>{n}</b></a> ой</p><template><i>образец</i></template><h2>заголовок</h2>'
        '<p><b>Статья 1. Раз</b><b><a name="q"></a>жирный</b><b>просто</b></p><b>Статья 2. x<p>внутри</p></b></body>',
        [
            ("имя {n}", True, False, False, False), ("a{}", False, False, False, False), ("var {n};", False, False, False, False), ("текст {n} ", True, False, True, False), ("связь ", True, True, False, False), ("{n}", True, True, False, False),
            (" ой", True, False, False, False), ("образец", False, False, True, False), ("заголовок", True, False, True, True), ("Статья 1. Раз", True, False, True, True), ("жирный", True, False, True, True), ("просто", True, False, True, False),
            ("Статья 2. x", True, False, True, True), ("внутри", True, False, True, False),
        ],
    ),
]
LINES = [  # ord, text
    Case("all", '<p>один <a href="#x">связь</a> два {n}<br>три</p><script>нет</script><ul><li>четыре<li>пять <b>и</b></ul> шесть <!-- нет -->', [(0, "один ⟦L⟧ два {n}"), (1, "три"), (2, "четыре"), (3, "пять и шесть")]),
    Case("blank", "<p> <br> </p>", []),
]
AROUND = [  # text of the link, what stands before (text or tag), what after, the blanks between
    Case("all", '<p>текст {n} <b>x</b> <a href="#1">1</a>  <a href="#2">2</a>!</p>', [("1", "b", "a", " "), ("2", "a", "!", "  ")]),
    Case("alone", '<p> <a href="#1">{n}</a></p>', [("{n}", None, None, " ")]),
]
_HOSTS = '<a href="#o">вне</a><div data-type="глава" data-number="2"><a href="#c">глава</a><div data-type="статья" data-number="{n}"><p><a href="#i">в статье</a></p><div data-type="x"><a href="#d">глубже</a></div></div></div>'
HOSTS = [Case("all", _HOSTS, [("вне", False, None), ("глава", True, None), ("в статье", True, "{n}"), ("глубже", True, "{n}")])]  # text, in_scope, article
ANCHORS = [  # tag, anchor
    Case("all", '<h3 id="own{n}"><a name="x"></a>a</h3><p><a id="i{n}" name="m"></a>b</p><h4><a id="only{n}"></a>c</h4><h5><a name="k{n}">d</a></h5><h6>e</h6>', [("h3", "own{n}"), ("p", "i{n}"), ("h4", "only{n}"), ("h5", "k{n}")]),
]
IDS = [  # id, of_links (whether it counts where names count on links only)
    Case("all", '<p id="p{n}" name="pn"></p><a name="a{n}" id="ai"></a><i name="in"></i>', [("p{n}", True), ("pn", False), ("a{n}", True), ("ai", True), ("in", False)]),
]
BEFORE = [  # text of the link, prev_text (20 characters)
    Case("all", '<p>{n} очень  длинное начало\n <i>и конец</i> <a href="#1">1</a>, <a href="#2">2</a></p>', [("1", "инное начало и конец"), ("2", "ое начало и конец 1,")]),
]

# Anchor maps

METHODS = [  # article, anchor, method
    Case("all", '<p><a name="z1"></a>Статья 1. Раз</p><p><a name="z4"></a><b>Статья 4. Четыре</b></p><h3 id="z2">Статья 2{n}. Два</h3><p id="q3">Статья 3. Три</p><div id="z2">Статья 9. Занято</div><p><b>Статья 5. Пять</b></p><p id="q1">Статья 1. Снова</p><p><b>Статья 6-1.</b> Шесть</p><p id="q7">до Статья 7. Не в начале</p>',
         [("1", "z1", 1), ("4", "z4", 1), ("2{n}", "z2", 2), ("3", "q3", 3), ("5", "z5h", 4), ("6-1", "z6-1h", 4)]),
]
SYNTHETIC = [  # id, text of the bold text
    Case("all", "<p><b>Статья 5{n}. A &lt; B</b> x</p><p><b>Иное</b></p>", [("z5{n}h", "Статья 5{n}. A < B")]),
]
DETECTED = [  # article, anchor
    Case("all", '<p><b><a name="z1" id="i1"></a>Статья 1. Раз</b></p><h3 id="z2">Статья 2{n}. Два</h3><h3>Статья 3. Без</h3><p><b>Статья 4. Без</b></p><p><b><a id="z5"></a>Статья 5. Пять</b></p><p><a name="z6"></a>Статья 6. Не жирно</p>', [("1", "z1"), ("2{n}", "z2"), ("5", "z5")]),
]
POINTS = [  # key, anchor
    Case("all", '<h3 id="z2">Статья 2{n}. Два</h3><p>1. Пункт</p><p>1) под</p><p id="s2">2) под с id</p><p id="p9">2. Второй</p><p><span class="note">3. не пункт</span></p><h3>Статья 3. Три</h3><p>1) прямой</p><p>1.1. не пункт</p><p>1) снова</p>',
         [("2{n}_1", "z2{n}_p1"), ("2{n}_1_1", "z2{n}_1_1"), ("2{n}_1_2", "s2"), ("2{n}_2", "p9"), ("3_1", "z3_1")]),
]
WRITTEN_POINTS = [  # id of an inner anchor, what its paragraph says
    Case("all", "<h3>Статья 2{n}. Два</h3><p>1. A &lt; B</p><p id='x'>2. с id</p>", [("z2{n}_p1", "1. A < B")]),
]
PARTS = [  # article, part, anchor
    Case("all", '<h3>Статья 1{n}. Раз</h3><p id="a">1. Первый</p><p id="b">1. Снова</p><p id="c">1-1. Дробный</p><p id="d">1-1. Снова</p><p>2. Без id</p>', [("1{n}", "1", "a"), ("1{n}", "1-1", "d")]),
]
CHAPTERS = [  # chapter, anchor
    Case("all", '<p><b><a name="b1"></a>Глава 1. Жирная</b></p><h3 id="h1">Глава 1. Раз</h3><h2 id="h2">ГЛАВА 2{n}. Два</h2><p><b><a name="b3"></a>Глава 3-1. Три</b></p><h3>Глава 4. Без</h3>', [("1", "h1"), ("2{n}", "h2"), ("3-1", "b3")]),
]
NAMED_IDS = [  # name, id
    Case("all", '<a name="a{n}"></a><a name="a{n}"></a><a name="b"></a><p id="b"></p><a name="c" id="d"></a>', [("a{n}", "a{n}"), ("a{n}", None), ("b", None), ("c", "d")]),
]
NUMBERED = [  # id, number
    Case("all", '<h3 id="z1">Статья 1{n}. Раз</h3><div data-type="статья" data-number="7"><h4 id="z7">Статья 8. Иная</h4><p id="p7"></p><h4 id="q7">Иное</h4></div><p id="out"></p>', [("z1", "1{n}"), ("z7", "8"), ("p7", "7"), ("q7", "7")]),
]
EDGES = [  # id, number
    Case("all", '<p><a id="near"></a></p><div data-type="статья" data-number="{n}"><p id="far">{long}</p></div><div class="x" data-type="статья" data-number="9"></div><p id="last"></p>', [("near", "{n}")]),
]

# Chunks

_CHUNKED = (
    '<div data-type="часть" data-number="1"><h2>Часть 1</h2><div data-type="раздел" data-number="2"><div data-type="глава" data-number="3"><div class="article" data-type="статья" data-number="10{n}" id="w_z10"><h3 id="z10">Статья 10{n}. Имя</h3>'
    '<p>Вводный текст</p><p id="p1">1. Первый пункт</p><p>1) под а</p><p>1.1. вложенный</p><p>продолжение</p><p id="p2">2. Второй</p></div></div></div></div>'
    '<div data-type="статья" data-number="11"><h3>Статья 11. Старая</h3><p class="note">Статья 11 исключена</p></div>'
    '<div data-type="статья" data-number="12"><h3>Статья 12. А</h3><p>1. икс</p><p><b>Статья 13. Б</b></p><p>1. игрек</p></div>'
    '<div data-type="статья" data-number="14"><h3>Статья 14. В</h3><p>1. один<br>1) два<br>3. три</p></div>'
    '<h3>Статья 15. Г</h3><p>1. вне</p><p>ещё</p>'
    '<div data-type="статья" data-number="16"><h3>Статья 17. Д</h3><p>без пунктов</p></div>'
    '<div data-type="статья" data-number="18"><h3>Статья 18. Е</h3><p>1. список {long}</p><p>1) {long}</p><p>2) {long}</p><p>хвост</p><p>3) {long}</p><p>2. короткий</p></div>'
)
CHUNKED = [  # id, text, hier_id, unit_type, unit_number, status, split_from
    Case(
        "act",
        _CHUNKED,
        [
            ("{n}-act_ст10{n}_п1", "[intro]\nВводный текст\n\n[{n}-act | Статья 10{n}. Имя | пункт 1]\n1. Первый пункт\n1) под а\nпродолжение\n1.1. вложенный", "{n}-ACTR2G3ST10{n}P1", "пункт", "1", "active", None),
            ("{n}-act_ст10{n}_п2", "[{n}-act | Статья 10{n}. Имя | пункт 2]\n2. Второй", "{n}-ACTR2G3ST10{n}P2", "пункт", "2", "active", None),
            ("{n}-act_ст11", "[{n}-act | Статья 11. Старая | СТАТЬЯ ИСКЛЮЧЕНА]", "{n}-ACTST11", None, None, "repealed", None),
            ("{n}-act_ст12_п1", "[{n}-act | Статья 12. А | пункт 1]\n1. икс", "{n}-ACTST12P1", "пункт", "1", "active", None),
            ("{n}-act_ст13_п1", "[{n}-act | Статья 13. Б | пункт 1]\n1. игрек", "{n}-ACTST13P1", "пункт", "1", "active", None),
            ("{n}-act_ст14_п1", "[{n}-act | Статья 14. В | пункт 1]\n1. один\n1) два", "{n}-ACTST14P1", "пункт", "1", "active", None),
            ("{n}-act_ст14_п3", "[{n}-act | Статья 14. В | пункт 3]\n3. три", "{n}-ACTST14P3", "пункт", "3", "active", None),
            ("{n}-act_ст15_п1", "[{n}-act | Статья 15. Г | пункт 1]\n1. вне\nещё", "{n}-ACTST15P1", "пункт", "1", "active", None),
            ("{n}-act_ст17", "[{n}-act | Статья 17. Д]\nбез пунктов", "{n}-ACTST17", None, None, "active", None),
            ("{n}-act_ст18_п1_пп1", "[{n}-act | Статья 18. Е | подпункт 1]\n1. список {long}\n1) {long}", "{n}-ACTST18P1SP1", "подпункт", "1", "active", "{n}-act_ст18_п1"),
            ("{n}-act_ст18_п1_пп2", "[{n}-act | Статья 18. Е | подпункт 2]\n1. список {long}\n2) {long}\nхвост", "{n}-ACTST18P1SP2", "подпункт", "2", "active", "{n}-act_ст18_п1"),
            ("{n}-act_ст18_п1_пп3", "[{n}-act | Статья 18. Е | подпункт 3]\n1. список {long}\n3) {long}", "{n}-ACTST18P1SP3", "подпункт", "3", "active", "{n}-act_ст18_п1"),
            ("{n}-act_ст18_п2", "[{n}-act | Статья 18. Е | пункт 2]\n2. короткий", "{n}-ACTST18P2", "пункт", "2", "active", None),
        ],
    ),
]
DISCREPANT = [Case("act", _CHUNKED, [("number", "13", "12"), ("orphan", "15", None), ("number", "17", "16")])]  # kind, number, own_number
TREES = [Case("act", _CHUNKED, [(k, a, u, c) for k, (a, u, c) in enumerate([("10{n}", 2, 1), ("11", None, None), ("12", 1, 0), ("13", 1, 0), ("14", 2, 1), ("17", None, None), ("18", 2, 3), ("15", 1, 0)])])]  # ord, article, units, children
TITLES = [  # text, number (bold), number (not bold), title
    Case(
        "all",
        "",
        [
            ("Статья 5{n}. Имя", "5{n}", "5{n}", "Имя"), ("Cтатья 6-1 . Латинская", "6-1", "6-1", "Латинская"), ("Ϲтатья 7. Греческая", "7", "7", "Греческая"), ("8. Очень длинное название, в котором больше сорока знаков", "8", None, "Очень длинное название, в котором больше сорока знаков"),
            ("9. Короткое", None, None, "Короткое"), ("10. со строчной буквы, хотя и очень длинное название статьи", None, None, "со строчной буквы, хотя и очень длинное название статьи"), ("Глава 1. Иное", None, None, "Глава 1. Иное"), ("Статья 11 без точки", None, None, "Статья 11 без точки"),
        ],
    ),
]
UNIT_WORDS = [  # code, article, special, word
    Case("all", "", [("ugolovniy", "1{n}", False, "часть"), ("upk", "5", None, "часть"), ("koap", "241", False, "пункт"), ("koap", "242", False, "часть"), ("koap", "242-1", None, "часть"), ("koap", "7", True, "часть"), ("nalog", "300", True, "пункт"), ("koap", None, None, "пункт")]),
]

# Audits

_CONTENT = '<div data-type="статья" data-number="7"><h3 id="z7">Статья 7. Имя</h3><p id="p1">{0}</p></div>'


def _content(body: str) -> str:
    return _CONTENT.replace("{0}", body)


UNLINKED = [  # class, match, context, editorial
    Case("article", _content("согласно статье 5{n} и далее"), [("article", "статье 5{n}", "согласно статье 5{n} и далее", False)]),
    Case("article_remark", _content("Сноска. Статья 5{n} с изменениями"), [("article", "Статья 5{n}", "Сноска. Статья 5{n} с изменениями", True)]),
    Case("article_from", _content("Статья 5{n} вводится не сразу"), [("article", "Статья 5{n}", "Статья 5{n} вводится не сразу", True)]),
    Case("two", _content("по статье 1 и по статьям 2, {n}"), [("article", "статье 1", "по статье 1 и по статьям 2, {n}", False), ("article", "статьям 2", "по статье 1 и по статьям 2, {n}", False)]),
    Case("self", _content("нормы настоящего Кодекса {n}"), [("self", "настоящего Кодекса", "нормы настоящего Кодекса {n}", False)]),
    Case("code", _content("по Налоговому кодексу {n}"), [("code", "Налоговому кодексу", "по Налоговому кодексу {n}", False)]),
    Case("law", _content("Закон Республики Казахстан от 5 мая {n}"), [("law", "Закон Республики Казахстан от 5", "Закон Республики Казахстан от 5 мая {n}", False)]),
    Case("law_remark", _content("Закон РК от 5 мая (вводится в действие {n})"), [("law", "Закон РК от 5", "Закон РК от 5 мая (вводится в действие {n})", True)]),
    Case("constitution", _content("по Конституции и Конституционному Суду {n}"), [("constitution", "Конституции", "по Конституции и Конституционному Суду {n}", False)]),
    Case("linked", _content('по <a href="#z7">статье 7</a> {n}'), []),
    Case("outside", "<p>по статье 5{n}</p>", []),
]
COVERAGE = [  # class, n
    Case("all", _content('по статье 1, статье 2, настоящему закону, <a href="#z7">статье 7</a>, <a href="https://example.org/docs/K150000000{n}">x</a>, <a href="/q">y</a>') + '<a href="#out">вне</a>', [("article", 2), ("self", 1), ("linked:internal", 1), ("linked:external", 1), ("linked:nav", 1)]),
]
_ACT2 = (
    '<div data-type="статья" data-number="1{n}"><h3 id="z1">Статья 1{n}. Раз</h3><p id="p1">текст</p><p>{0}</p></div><p><a id="mark"></a></p><div data-type="статья" data-number="2"><h3 id="z2">Статья 2. Два</h3><p id="p2">текст</p></div>'
    '<div data-type="статья" data-number="3-1"><h3 id="z3">Статья 3-1. Три</h3><p id="p3">текст</p></div>'
)


def _verdict(name: str, body: str, *row: Any) -> Case:
    """``body`` inside the act's content, whose anchors pN are z7N here."""
    return Case(name, f'<div data-type="глава">{_ACT2.replace("{0}", body)}</div>'.replace('id="p', 'id="z7').replace('"#p', '"#z7'), [row] if row else [])


VERDICTS = [  # kind, claimed, article, verdict, inherited
    _verdict("ok", '<a href="#z2">статье 2</a>', "ARTICLE", "2", "2", "OK", False),
    _verdict("inherited", '<a href="#z1">статье 1{n}</a>', "ARTICLE", "1{n}", "1{n}", "OK", True),
    _verdict("wrong", '<a href="#p1">статье 2</a>', "ARTICLE", "2", "1{n}", "OK", False),
    _verdict("wrong_target", '<a href="#p2">статье 1{n}</a>', "ARTICLE", "1{n}", "2", "WRONG_TARGET", False),
    _verdict("wrong_sub", '<a href="#p2">статье 3-1</a>', "ARTICLE", "3-1", "2", "OK", False),
    _verdict("wrong_sub_far", '<a href="#p1">статье 3-1</a>', "ARTICLE", "3-1", "1{n}", "WRONG_SUB", False),
    _verdict("range", '<a href="#z2">статье 2-5</a>', "ARTICLE", "2-5", "2", "OK", False),
    _verdict("other_anchor", '<a href="#q">статье 2</a><i id="q"></i>'),
    Case("outside", _ACT2.replace("{0}", "") + '<p><a href="#z2">статье 2</a></p>', []),
    Case("titled", '<div data-type="статья" data-number="8"><h3 id="z5">Статья 5{n}. Имя</h3><p><a href="#z5">настоящей статьи</a></p></div>', [("SELF", None, "5{n}", "SELF_OK", False)]),
    _verdict("broken", '<a href="#z99">статье 2</a>', "ARTICLE", "2", None, "BROKEN", False),
    _verdict("self", '<a href="#p1">настоящей статьи</a>', "SELF", None, "1{n}", "SELF_OK", False),
    _verdict("self_wrong", '<a href="#p3">настоящей статьи</a>', "SELF", None, "3-1", "SELF_WRONG", False),
    _verdict("bare", 'по статье <a href="#z2">2</a>', "ARTICLE", "2", "2", "OK", False),
    _verdict("nonart", '<a href="#p1">пункту 3</a>', "NONART", None, "1{n}", "NONART", False),
    _verdict("outward", '<a href="https://example.org/docs/K1500000001#z1">статье 1</a>'),
]
INDEPENDENT = [  # n, target, verdict
    Case("match", _ACT2.replace("{0}", '<a href="#z2">статье 2</a>'), [("2", "2", "match")]),
    Case("inner", _ACT2.replace("{0}", '<a href="#p1">статье 1{n}</a>'), [("1{n}", "1{n}", "match")]),
    Case("range", _ACT2.replace("{0}", '<a href="#z2">статье 2-5</a>'), [("2-5", "2", "range_base")]),
    Case("mismatch", _ACT2.replace("{0}", '<a href="#p3">статье 2</a>'), [("2", "3-1", "mismatch")]),
    Case("unresolved", _ACT2.replace("{0}", '<a href="#nowhere">статье 2</a>'), [("2", None, "unresolved")]),
    Case("boundary", _ACT2.replace("{0}", '<a href="#q">статье 2</a><i id="q"></i>'), [("2", "1{n}", "boundary")]),
]
HINTED = [  # hint, expected, actual
    Case("wrong", _content('<a href="https://example.org/docs/K1500000001">Налогового кодекса {n}</a>'), [("налогов", "K1500000002", "K1500000001")]),
    Case("longest", _content('<a href="https://example.org/docs/K1500000001">Трудового и социально-трудового {n}</a>'), [("социально-трудов", "K1500000003", "K1500000001")]),
    Case("right", _content('<a href="https://example.org/docs/K1500000002">Налогового кодекса {n}</a>'), []),
    Case("before", _content('Налогового кодекса <a href="https://example.org/docs/K1500000001">5</a> {n}'), [("налогов", "K1500000002", "K1500000001")]),
    Case("unknown", _content('<a href="https://example.org/docs/K1500000009">Налогового кодекса {n}</a>'), []),
]
NAMES = [  # text, expected (joined)
    Case("all", "", [("Уголовно-исполнительный кодекс {n}", "D2"), ("Уголовный кодекс", "D1"), ("кодекс о рынке труда", "D3,D4"), ("рынок", None), ("КРАТКО {n}", "D3,D4"), (None, None)]),
]
_SIX = "https://example.org/docs/"
SIX = [  # check, n, contexts (joined)
    Case("nested", _p('<a href="#z1">a<a href="#z1">b{n}</a></a>') + '<i id="z1"></i>', [("nested", 1, "b{n}")]),
    Case("empty", _p('<a href="#">x{n}</a><a href="">y</a>') + '<nav><a href="#">z</a></nav>', [("empty", 2, "x{n}|y")]),
    Case("split", _p('по статье <a href="#z1">5{n}</a> и статьями <a href="#z1">6</a>') + '<i id="z1"></i>', [("split", 1, "статье 5{n}"), ("list", 1, "статьями 6")]),
    Case("archive", _p(f'<a href="{_SIX}K1500000001/archive/{{n}}">a</a>'), [("archive", 1, _SIX + "K1500000001/archive/{n}")]),
    Case("own", _p(f'<a href="{_SIX}K1500000077/info">a{{n}}</a>'), [("own", 1, _SIX + "K1500000077/info")]),
    Case("odd", _p(f'<a href="{_SIX}K1500000001#p{{n}}">a</a>'), [("odd", 1, _SIX + "K1500000001#p{n}")]),
    Case("elsewhere", _p('<a href="https://example.com/{n}">a</a>'), [("elsewhere", 1, "https://example.com/{n}")]),
    Case("dangling", _p('<a href="#z9{n}">a</a><a href="#q">b</a>'), [("dangling", 1, "#z9{n}")]),
    Case("many", _p('<a href="#z1">a</a><a href="#z2">b</a><a href="#z3">c</a><a href="#z4{n}">d</a>'), [("dangling", 4, "#z1|#z2|#z3")]),
    Case("unparsed", "только текст {n}", [("unparsed", 1, "")]),
    Case("clean", _p(f'<a href="#z1" id="z1">a</a><a href="{_SIX}K1500000001#z{{n}}">b</a>'), []),
]
GATES = [  # gate, n
    Case("clean", _content('<a href="#z7">a{n}</a>'), [("broken", 0), ("not_canonical", 0), ("full_self", 0)]),
    Case("broken", _content('<a href="#z8">a{n}</a><a href="#q">b</a>'), [("broken", 1), ("not_canonical", 0), ("full_self", 0)]),
    Case("not_canonical", _content(f'<a href="/docs/K1500000001#z1">a{{n}}</a><a href="{_SIX}K1500000001#z1">b</a><a href="{_SIX}K1500000001#q">c</a>'), [("broken", 0), ("not_canonical", 2), ("full_self", 0)]),
    Case("full_self", _content(f'<a href="{_SIX}K1500000077#z7">a{{n}}</a>') + f'<a href="{_SIX}K1500000077">вне</a>', [("broken", 0), ("not_canonical", 0), ("full_self", 1)]),
]
RETARGETED = [  # ord, href
    Case("all", '<h3 id="z5h">Статья 5{n}. Имя</h3><h3 id="z6">Статья 6. Имя</h3><p><a href="#z1">статье 5{n}</a> <a href="#z1">статье 5{n}</a> <a href="#z2">статья 6</a> <a href="#z2">статья 77</a> <a href="#z2">пункт 1 статьи 6</a> <a href="/x">статья 6</a></p>',
         [(0, "#z5h"), (1, "#z1"), (2, "#z6"), (3, "#z2"), (4, "#z2"), (5, "/x")]),
]
DROPPED = [Case("all", '<i id="z5"></i><i id="6"></i><a href="#5">a</a><a href="#6">b</a><a href="#7{n}">c</a><a href="#z5">d</a>', [(0, "#z5"), (1, "#6"), (2, "#7{n}"), (3, "#z5")])]  # ord, href
ODD = [  # href
    Case("all", _p(f'<a href="{_SIX}K1500000001/history">1</a><a href="{_SIX}K1500000001?x={{n}}">2</a><a href="{_SIX}K1500000001/01.02.2003">3</a><a href="{_SIX}K1500000001#z1">4</a><a href="/search?x">5</a>'), [(_SIX + "K1500000001/history",), (_SIX + "K1500000001?x={n}",), (_SIX + "K1500000001/01.02.2003",)]),
]
MEANT = [  # text, prev, articles (joined, in order)
    Case("all", "", [("5{n}", "", "5{n}"), ("статьи 6", "", "6"), ("пункт 1", "по статьям 7-1, 8", "7-1"), ("9", "статьи 9", "9"), ("статьи 10", "статьи 11", "10,11"), ("текст", "{long}статьи 5", "5"), ("текст", "статьи 5 {long}", ""), ("текст", None, "")]),
]
PHRASED = [  # ord, phrase, doc_id
    Case("all", _p('по Закону о  рынке\nтруда {n}, закону О РЫНКЕ, <a href="#x">закону о рынке</a> и закону о рынкеX'), [(0, "Закону о  рынке\nтруда", "D1"), (1, "закону О РЫНКЕ", "D2")]),
    Case("across", _p("труда закону о рынке труда {n}"), [(0, "закону о рынке труда", "D1")]),
]
PHRASED_LINKS = [Case(c.name, c.html, rows) for c, rows in zip(PHRASED, [[(0, "Закону о рынке труда", _SIX + "D1"), (1, "закону О РЫНКЕ", _SIX + "D2"), (2, "закону о рынке", "#x")], [(0, "закону о рынке труда", _SIX + "D1")]], strict=True)]
PARTIAL = [  # phrase, link_text
    Case("part", _p('по закону о рынке <a href="#x">труда</a> {n}'), [("закону о рынке труда", "труда")]),
    Case("whole", _p('по <a href="#x">закону о рынке труда</a> {n}'), []),
    Case("other", _p('по закону о рынке <a href="#x">иное</a> {n}'), []),
]
OVERRIDES = [("1", "пункт 5{n} закона", "закона", "K1", "z1", None), ("2", "<b>правил</b>", "правил", "", "z2", None), ("3", "по кодексу", "кодексу", "K3", None, "метка"), ("4", "уже <a>там", "там", "K4", None, None)]
OVERRIDDEN = [  # html
    Case("all", "<p>пункт 5{n} закона, <b>правил</b>, пункт 5{n} закона; по кодексу; уже <a>там</a></p>", [(f'<p>пункт 5{{n}} <a href="{_SIX}K1#z1">закона</a>, <b><a href="#z2">правил</a></b>, пункт 5{{n}} закона; по кодексу; уже <a>там</a></p>',)]),
    Case("marked", "<p>метка: по кодексу {n}</p>", [(f'<p>метка: по <a href="{_SIX}K3">кодексу</a> {{n}}</p>',)]),
]
