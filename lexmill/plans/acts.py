"""Acts written from the driver tables, so that every expected result follows from the tables by plain SQL.

One act a customer: every order is an article (numbered by its rank), every fifth opens a chapter, every line item is
a point. One page of references a supplier: every line item is a phrase of a kind chosen by its line number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Articles that the reference pages' acts have.
KNOWN = 40


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def act_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, html): the raw acts."""
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").withColumn("n", rank)
    item = F.concat(F.lit("<p>"), "l_linenumber", F.lit(". Товар "), "l_partkey", F.lit("</p>"))
    lines = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", item.alias("h")))).alias("ps"))
    chapter = F.when(F.col("n") % 5 == 1, F.concat(F.lit('<h2 id="c'), ((F.col("n") + 4) / 5).cast("int"), F.lit('">Глава '), ((F.col("n") + 4) / 5).cast("int"), F.lit(". Раздел заказов</h2>"))).otherwise("")
    body = F.concat(chapter, F.lit('<h3 id="z'), "o_orderkey", F.lit('">Статья '), "n", F.lit(". Заказ</h3>"), F.coalesce(F.array_join(F.transform("ps", lambda p: p["h"]), ""), F.lit("")))
    rows = orders.join(lines, "o_orderkey", "left").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("n", body.alias("h")))).alias("hs"))
    html = F.concat(F.lit("<html><head><title>x</title></head><body><article>"), F.array_join(F.transform("hs", lambda h: h["h"]), ""), F.lit("</article></body></html>"))
    return rows.select(F.col("o_custkey").cast("string").alias("doc_key"), html.alias("html"))


def reference_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, html): one paragraph a line item, with a reference of a kind by its line number."""
    a, b, n = F.col("l_quantity").cast("int").cast("string"), (F.col("l_partkey") % 50 + 1).cast("string"), F.col("l_linenumber")
    k = n.cast("string")
    phrase = (
        F.when(n == 1, F.concat(F.lit("согласно пункту "), k, F.lit(" статьи "), a, F.lit(" закона")))
        .when(n == 2, F.concat(F.lit("указано в статьях "), a, F.lit(", "), b, F.lit(" закона")))
        .when(n == 3, F.concat(F.lit("нарушение статьи "), a, F.lit(" закона")))
        .when(n == 4, F.concat(F.lit("в подпункте "), k, F.lit(") пункта 2 статьи "), a, F.lit(" закона")))
        .when(n == 5, F.concat(F.lit("как следует из главы "), k, F.lit(" настоящего Кодекса")))
        .when(n == 6, F.concat(F.lit("см. статья "), a, F.lit(". Заголовок")))
        .otherwise(F.concat(F.lit("ПУНКТАМИ 1, 2 СТАТЬИ "), a, F.lit(" закона")))
    )
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("doc_key"), F.struct("l_orderkey", "l_linenumber", F.concat(F.lit("<p>"), phrase, F.lit("</p>")).alias("h")).alias("p"))
    return rows.groupBy("doc_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["h"]), "").alias("html"))


def reference_maps(pages: DataFrame) -> DataFrame:
    """(doc_key, key, anchor): each page's act has articles 1 to ``KNOWN``, point 2's fourth subpoint in even ones, and chapter 5."""
    number = F.sequence(F.lit(1), F.lit(KNOWN))
    articles = F.transform(number, lambda i: F.struct(F.concat(F.lit("a:"), i).alias("key"), F.concat(F.lit("z"), i).alias("anchor")))
    subpoints = F.transform(F.filter(number, lambda i: i % 2 == 0), lambda i: F.struct(F.concat(F.lit("s:"), i, F.lit("_2_4")).alias("key"), F.concat(F.lit("z"), i, F.lit("_2_4")).alias("anchor")))
    chapter = F.array(F.struct(F.lit("c:5").alias("key"), F.lit("c5").alias("anchor")))
    return pages.select("doc_key", F.explode(F.concat(articles, subpoints, chapter)).alias("x")).select("doc_key", "x.key", "x.anchor")


def chain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, html): one paragraph a line item with neighbouring links; which of them make a chain follows from the line."""
    a, n = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")

    def link(text: str, href: object) -> object:
        return F.concat(F.lit('<a href="'), href, F.lit('">'), text if not isinstance(text, str) else F.lit(text), F.lit("</a>"))

    inner = lambda k: F.concat(F.lit(f"#p{k}_"), a)
    art, out = F.concat(F.lit("статьи "), a), F.lit("https://example.org/docs/K1500000377#z9")
    markup = (
        F.when(n == 1, F.concat(link("пунктами 1", inner(1)), F.lit(" и "), link("2", inner(2)), F.lit(" "), link(art, inner(0)), F.lit(" кодекса")))
        .when(n == 2, F.concat(link("пункт 1", inner(1)), F.lit(" "), link(art, inner(0)), F.lit(" кодекса")))
        .when(n == 3, F.concat(link("пункт 1", inner(1)), F.lit(", "), link("2", out), F.lit("; "), link(art, inner(0))))
        .when(n == 4, F.concat(link("частями первой", inner(1)), F.lit(", "), link("второй", inner(2)), F.lit(" "), art, F.lit(" настоящего Кодекса")))
        .otherwise(F.concat(F.lit("текст "), link(art, inner(0))))
    )
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("doc_key"), F.struct("l_orderkey", "l_linenumber", F.concat(F.lit("<p>"), markup, F.lit("</p>")).alias("h")).alias("p"))
    return rows.groupBy("doc_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["h"]), "").alias("html"))


def hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, ord, href, text, prev_text): links of all shapes, one an event."""
    e = F.col("event_id")
    doc = F.concat(F.lit("K15000"), F.lpad((F.col("user_id") % 7).cast("string"), 5, "0"))
    number = (e % 9 + 1).cast("string")
    href = (
        F.when(e % 6 == 0, F.concat(F.lit("https://example.org/docs/"), doc, F.lit("#z"), number))
        .when(e % 12 == 1, F.concat(F.lit("https://example.org/rus/docs/"), doc, F.lit("#"), number))
        .when(e % 6 == 1, F.concat(F.lit("/rus/docs/"), doc, F.lit("#"), number))
        .when(e % 6 == 2, F.concat(F.lit("http://example.com/docs/"), doc))
        .when(e % 6 == 3, F.concat(F.lit("#z"), number))
        .when(e % 6 == 4, F.concat(F.lit("https://example.org/docs/"), doc, F.lit("/history")))
        .otherwise(F.concat(F.lit("/search/"), number))
    )
    return _read(spark, sf_dir, "events").select((F.col("user_id") % 3).cast("string").alias("doc_key"), e.alias("ord"), href.alias("href"), F.concat(F.lit("статьи "), (e % 4 + 1).cast("string")).alias("text"), F.lit("").alias("prev_text"))


def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, id): ids that the documents of ``hrefs`` have: of the numbers 1 to 9 those that three doesn't divide with a z, 3 and 6 without."""
    number = F.col("event_id") % 9 + 1
    id_ = F.when(number % 3 != 0, F.concat(F.lit("z"), number)).when(number < 9, number.cast("string"))
    return _read(spark, sf_dir, "events").select((F.col("user_id") % 3).cast("string").alias("doc_key"), id_.alias("id")).where("id is not null").distinct()


def verdict_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, html): one act a supplier, one article a line number, in it a link for every line item; what it claims and where it points follow from the order."""
    n, k = F.col("l_linenumber").cast("string"), F.col("l_orderkey") % 6
    next_ = (F.col("l_linenumber") % 7 + 1).cast("string")

    def link(href: Column, text: Column) -> Column:
        return F.concat(F.lit('<p>см. <a href="#'), href, F.lit('">'), text, F.lit("</a></p>"))

    own = F.concat(F.lit("z"), n)
    said = (
        F.when(k == 0, link(own, F.concat(F.lit("статьи "), n))).when(k == 1, link(F.concat(F.lit("z"), next_), F.concat(F.lit("статьи "), n))).when(k == 2, link(F.lit("z99"), F.lit("статьи 3")))
        .when(k == 3, link(own, F.lit("настоящей статьи"))).when(k == 4, link(F.concat(F.lit("z"), next_), F.lit("пункта 2"))).otherwise(link(F.lit("p1"), F.lit("статьи 1")))
    )
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("doc_key"), n.alias("n"), F.struct("l_orderkey", said.alias("h")).alias("p"))
    parts = rows.groupBy("doc_key", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["h"]), "").alias("h"))
    div = F.concat(F.lit('<div data-type="статья" data-number="0"><h3 id="z'), "n", F.lit('">Статья '), "n", F.lit(". Имя</h3>"), "h", F.lit("</div>"))
    body = parts.groupBy("doc_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", div.alias("h")))), lambda p: p["h"]), "").alias("h"))
    return body.select("doc_key", F.concat("h", F.lit('<p><a href="#z1">статьи 9</a></p>')).alias("html"))
