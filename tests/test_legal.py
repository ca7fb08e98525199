"""The operators on small Russian acts written for these tests, and their queries against SQL."""

import collections
import random
import time

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexmill.functions import overlaps, phrases, sequences
from lexmill.functions.text import ROMAN, ordinal, roman
from lexmill.operators import anchors, audit, chunks, dom, references, spans, structure
from lexmill.plans import cases
from lexmill.plans.sql import SQL
from lexmill.sources import html, registry, shared, sinks

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()
SMALL = "/root/testdata/sf0.001"


def _nodes(spark, pages):
    return html.parse_nodes(spark.createDataFrame(list(pages.items()), "k string, h string"), "k", "h")


def _plain(v):
    if hasattr(v, "item"):
        v = v.item()
    return None if v is None or v != v else int(v) if isinstance(v, float) and v == int(v) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    import __spark_entry__

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    rows = want.fetchall()
    got = __spark_entry__.queries()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    count = lambda rs: collections.Counter(tuple(_plain(v) for v in r) for r in rs)
    assert count(tuple(r) for r in got.select(*columns).collect()) == count(rows)


def test_empty_tables(spark):
    """Every case query's operators on no page at all."""
    nodes = _nodes(spark, {"a": "<p>x</p>"}).where("false")
    maps = references.act_keys(nodes)
    assert structure.structured_html(nodes).count() == 0 and structure.structured(nodes).count() == 0 and maps.count() == 0
    assert references.references(references.find_references(nodes, maps)).count() == 0 and references.trailing_units(nodes, maps).count() == 0
    assert spans.merged_spans(nodes).count() == 0 and spans.chains(spans.siblings(nodes)).count() == 0
    assert audit.six_checks(nodes).count() == 0 and audit.correctness(nodes).count() == 0 and audit.unlinked(nodes).count() == 0
    assert [df.count() for df in chunks.parse_articles(nodes, nodes.select(F.col("doc_key").alias("code"), F.lit("d").alias("doc_id")))] == [0, 0]


def test_null_and_odd_pages(spark):
    pages = {"null": None, "empty": "", "text": "nur Text", "open": "<p>a<p>b<p>c <b>d<i>e", "signs": "<p>ab\u0001cd\u0002ef по статье 5 <a href='#q\"x'>&lt;</a></p><h3 id='z5'>Статья 5. Имя</h3>"}
    rows = spark.createDataFrame(list(pages.items()), "doc_key string, html string")
    nodes = html.parse_nodes(rows, "doc_key", "html").cache()
    assert {r["doc_key"]: r["n"] for r in nodes.groupBy("doc_key").agg(F.max("depth").alias("n")).collect()} == {"text": 0, "open": 3, "signs": 2}
    done = {r["doc_key"]: r["html"] for r in references.linked_pages(rows).collect()}
    assert done["signs"] == '<p>ab\u0001cd\u0002ef по <a href="#z5">статье 5</a> <a href="#q&quot;x">&lt;</a></p><h3 id="z5">Статья 5. Имя</h3>'
    assert done["text"] == "nur Text" and done["open"] == "<p>a</p><p>b</p><p>c <b>d<i>e</i></b></p>"


def test_references_without_semicolon(spark):
    """Cut character references stay as they are, in texts, attributes, scripts and comments, also behind the first slice; whole ones are read."""
    cut = "a &amp; b &amp</p> &copy 2 &notit; &lt;x&gt &#38; &#38 &#x27; &ampx; AT&T"
    pages = {"a": f'<p title="q&amp;r&copy=1&lt">{cut}<script>x &amp;& y&amp</script><!-- &amp -->\ufdd0', "b": "x" * html.BATCH_CHARS + "&amp<i>y&amp;</i>"}
    rows = collections.defaultdict(list)
    for r in _nodes(spark, pages).where("kind <> 'element' or tag = 'p'").orderBy("doc_key", "node_id").collect():
        rows[r["doc_key"]].append(r["attrs"] if r["kind"] == "element" else r["text"])
    assert rows["a"] == [{"title": "q&r&copy=1&lt"}, "a & b &amp", " &copy 2 &notit; <x&gt & &#38 ' &ampx; AT&T", "x &amp;& y&amp", " &amp ", "\ufdd0"]
    assert rows["b"] == ["x" * html.BATCH_CHARS + "&amp", "y&"]


def test_kept_tables_have_their_size_and_order(spark):
    """Rows that take next to nothing in a file are not joined through the driver for that, and buckets aren't sorted again."""
    n = 300_000
    rows = spark.range(n).select((F.col("id") % 50).cast("string").alias("doc_key"), F.col("id").cast("int").alias("node_id"), F.lit("p").alias("tag"))
    plain, sorted_ = shared.written(rows, "rows"), shared.bucketed(rows, "rows", "doc_key", "node_id")
    for kept in (plain, sorted_):
        own = kept.where("tag = 'p'").select("doc_key", "node_id")
        assert own._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() >= 20 * n
        assert kept.dtypes == rows.dtypes and kept.count() == n
    met = sorted_.join(sorted_.where("node_id % 2 = 0").select("doc_key", "node_id", F.lit(1).alias("even")), ["doc_key", "node_id"], "left")
    plan = met.withColumn("k", F.count("even").over(Window.partitionBy("doc_key").orderBy("node_id")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Window" in plan and not any(x in plan for x in ("Sort [", "Exchange"))


def test_what_is_read_several_times_is_kept(spark):
    """Sections are read as they were written, and the content root is chosen without gathering any text."""
    pages = {"a": "<article><p>x</p></article><article><h3>Статья 1. Имя</h3><p>y</p></article><article></article>", "b": "<article></article>", "c": "<p>x</p>"}
    nodes = html.kept_nodes(spark.createDataFrame(list(pages.items()), "k string, h string"), "k", "h")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rows, root = structure.structured(nodes), dom.content_root(nodes)
    assert "Window" not in plan(rows) and "Join" not in plan(rows) and "collect_list" not in plan(root)
    assert {tuple(r) for r in root.collect()} == {("a", 3), ("b", 0)}
    assert [(r["doc_key"], r["type"], r["number"]) for r in rows.orderBy("doc_key", "pos").collect()] == [("a", "article", "1"), ("a", None, None)]


def test_many_open_paragraphs(spark):
    """Unclosed paragraphs don't nest, so a page of many costs no more than its length."""
    n = 20_000
    nodes = _nodes(spark, {"a": "<p>x " * n, "b": "<ul>" + "<li>y" * n, "c": "<table>" + "<tr><td>1<td>2" * n}).cache()
    assert nodes.count() == 2 * n + 2 * n + 1 + 5 * n + 1 and nodes.agg(F.max("depth")).first()[0] <= 3
    assert dom.before(nodes.where("doc_key = 'a'"), 20).count() == 2 * n


def test_preceding_text_looks_no_further_than_it_must(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for doc in range(30):
        said = ""
        for k in range(40):
            text = rng.choice(["", " ", "  \n", "слово", "a  b ", " конец. ", None])
            kind = "text" if text is not None else "element"
            want[doc, k] = " ".join(said.split())[-12:]
            rows.append((str(doc), 0, k, kind, text))
            said += text or ""
    table = spark.createDataFrame(rows, "doc_key string, parent_id int, sib_pos int, kind string, text string")
    assert {(int(r["doc_key"]), r["sib_pos"]): r["prev_text"] for r in dom.before(table, 12).collect()} == want


def test_phrases_of_any_number(spark):
    """A dictionary beyond a block takes several passes and loses nothing; longest first, none across another."""
    own = [(f"phrase number {i} of many", f"D{i}") for i in range(10_050)]
    texts = spark.createDataFrame([(i, f"see Phrase  number {i}\nof many, not phrase number {i} of manyx") for i in (0, 7, 9_999, 10_049)] + [(-1, None), (-2, "")], "id int, text string")
    wanted = spark.createDataFrame(own, "phrase string, doc_id string")
    found = spans.phrase_hits(spans.phrase_links(texts, wanted), "id").collect()
    assert sorted((r["id"], r["ord"], r["doc_id"]) for r in found) == [(i, 0, f"D{i}") for i in (0, 7, 9_999, 10_049)]
    spread = phrases.phrase_spans(texts, wanted.withColumnRenamed("doc_id", "value"), block=500)
    assert {r["id"]: [x["value"] for x in r["spans"]] for r in spread.collect()} == {0: ["D0"], 7: ["D7"], 9_999: ["D9999"], 10_049: ["D10049"], -1: [], -2: []}
    hints = spark.createDataFrame([(f"h{i}", f"E{i}") for i in range(10_050)], "hint string, expected string")
    rows = spark.createDataFrame([(1, "..h1004x"), (2, "H10049"), (3, "none")], "id int, text string")
    assert {(r["id"], r["hint"], r["expected"]) for r in audit.longest_hint(rows, hints).collect()} == {(1, "h1004", "E1004"), (2, "h10049", "E10049")}


def test_merges_settle(spark):
    """Merging again changes nothing, and texts stay."""
    pages = {c.name: c.html.replace("{n}", "3") for c in cases.MERGES + cases.CHAINED}
    nodes = _nodes(spark, pages).cache()
    for change in (spans.merged_spans, spans.merged_chains):
        once = html.parse_nodes(html.serialize(change(nodes)), "doc_key", "html").cache()
        twice = html.serialize(change(once))
        assert {tuple(r) for r in html.serialize(once).collect()} == {tuple(r) for r in twice.collect()}
        said = lambda df: {r["doc_key"]: r["sha"] for r in spans.text_hash(df.where("kind = 'text'").groupBy("doc_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_id", "text"))), lambda x: x["text"]), "").alias("text"))).collect()}
        assert said(once) == said(nodes)


def test_profile_of_what_is_written(spark):
    """What is gathered while pages are written is what a parse of them tells, for edits, renders, odd signs and nested links."""
    pages = {c.name: c.html.replace("{n}", "3") for c in cases.MERGES + cases.CHAINED + cases.LINKED}
    pages |= {"odd": "<p id='q' name=\"a&quot;b\">1 &lt; 2 &amp;amp; id=\"z9\" <a href='#q'>x <a href='#none'>y</a></a><a href='#none'>z</a> <a href=''>e</a><a>n</a><br id='z4'>по статье 5<!-- c --></p><h3 id='z5'>Статья 5. Имя</h3><script>a<b</script>", "bare": "nur Text", "void": "<br>"}
    nodes = html.kept_nodes(spark.createDataFrame(list(pages.items()), "doc_key string, html string"), "doc_key", "html")
    rows = lambda df: {r["doc_key"]: tuple(r) for r in df.drop("html").collect()}
    found = shared.written(references.find_references(nodes, references.act_keys(nodes)), "found")
    made = [shared.written(audit.profiled(form, pages=True), "made") for form in (nodes, spans.merged_spans(nodes), spans.merged_chains(nodes), references.linked_nodes(nodes, found))]
    for form in made:
        assert rows(form) == rows(audit.profiled(html.parse_nodes(form, "doc_key", "html")))
    old, new = made[0].drop("html"), made[-1].drop("html")
    own = old.where("doc_key = 'odd'").first()
    assert (own["nested"], own["hung"], own["n"]) == (1, 2, 4)
    added = references.references(found).groupBy("doc_key").agg(F.collect_list(F.concat(F.lit("#"), "anchor")).alias("added"))
    bad = lambda df: {(r["doc_key"], r["gate"]) for r in df.where("not ok").collect()}
    assert added.count() > 1 and bad(audit.compared(old, new, added=added)) == {("odd", "nested")}
    assert bad(audit.compared(old, new)) == {("odd", "nested")} | {(r["doc_key"], "hrefs") for r in added.collect()}
    # A document that one form lacks has lost its text and its links; one without either is the same.
    lost = bad(audit.compared(old, new.where("doc_key not in ('odd', 'bare', 'void')"), added=added.where("doc_key <> 'odd'")))
    assert lost == {("odd", "text"), ("odd", "hrefs"), ("bare", "text")}


def _cells(rng, n):
    said = ["пункт 1", "2", "статьи 5", "статье 7-1", "подпункту 3)", "второй", "", " ", ", ", " и ", " – ", "–4", " статьи 9 закона", "пункт 3 ", "части второй пункта 4 ", "слово"]
    out = []
    for i in range(n):
        kind = rng.choice(["a", "a", "text", "text", "other"]) if not out or out[-1]["kind"] != "text" else rng.choice(["a", "a", "a", "other"])
        text = rng.choice(said)
        out.append({"node_id": i, "kind": kind, "text": text, "href": f"#h{i}" if kind == "a" else None, "lead": "", "tail": "", "gone": False, "was": text})
    return out


def test_worklist_against_looking_again_from_the_start():
    rng = random.Random(8)
    for _ in range(400):
        cells = _cells(rng, rng.randrange(2, 14))
        plain = [dict(c) for c in cells]
        log, seen = [], -1
        while True:
            row = spans._Row(plain)
            tries = ((i, spans.edit_at(row, i)) for i in range(seen + 1, len(plain)) if i in row.live and plain[i]["kind"] == "a")
            found = next((e for _, e in tries if e), None)
            if found is None:
                break
            kind, i, j, n = found
            if kind == "complex":
                log.append((kind, "".join(c["text"] for c in plain[j : i + 1] if not c["gone"]), plain[j]["href"], None))
                seen = i
                continue
            one = [plain[i]]
            more = spans.settle([c for c in one])  # one cell alone is settled
            assert more == []
            if kind == "backward":
                cut = len(plain[j]["text"]) - n
                plain[i]["text"], plain[j]["text"] = plain[j]["text"][cut:] + plain[i]["text"], plain[j]["text"][:cut]
            elif n:
                plain[i]["text"], plain[j]["text"] = plain[i]["text"] + plain[j]["text"][:n], plain[j]["text"][n:]
            else:
                plain[i]["text"] += "".join(c["text"] for c in plain[i + 1 : j + 1] if not c["gone"])
                for c in plain[i + 1 : j + 1]:
                    c["gone"] = True
            log.append((kind, plain[i]["text"], plain[i]["href"], None if n else plain[j]["href"]))
            seen = max((k for k in range(i) if plain[k]["kind"] == "a"), default=0) - 1
        assert spans.settle(cells) == log
        assert [(c["text"], c["gone"]) for c in cells] == [(c["text"], c["gone"]) for c in plain]


def test_many_links_of_one_parent():
    """100,000 links under one parent are merged in a time that grows with their number."""
    took = []
    for n in (25_000, 100_000):
        cells = []
        for i in range(n // 2):
            for kind, text in (("a", f"пункт {i}"), ("text", " "), ("a", f"статьи {i}"), ("text", ", ")):
                cells.append({"node_id": len(cells), "kind": kind, "text": text, "href": "#" if kind == "a" else None, "lead": "", "tail": "", "gone": False, "was": text})
        began = time.time()
        log = spans.settle(cells)
        took.append(time.time() - began)
        assert len(log) == n // 2 and {x[0] for x in log} == {"merge"}
    assert took[1] < 12 * took[0] + 2


def test_many_places_in_one_text(spark):
    """20,000 hits in a text of 4 million characters: found, kept apart, cut out and linked (the session of the tests has 1 GB)."""
    rng = random.Random(3)
    for _ in range(200):
        places = [(s, s + rng.randrange(1, 9)) for s in (rng.randrange(40) for _ in range(rng.randrange(1, 30)))]
        taken, want = [], []
        for k, (s, e) in enumerate(places):
            if not any(a < e and b > s for a, b in taken):
                taken.append((s, e)), want.append(k)
        import numpy as np

        assert overlaps._fitting(np.array([p[0] for p in places]), np.array([p[1] for p in places])) == want
    n = 20_000
    text = ("слово " * 30 + "Закону о рынке труда, ") * n
    rows = spark.createDataFrame([("big", text), ("none", None), ("empty", ""), ("small", "a < закону о рынке труда > b")], "id string, text string")
    wanted = spark.createDataFrame([("закону о рынке труда", "D1"), ("закону о рынке", "D2"), ("рынке труда", "D3")], "phrase string, doc_id string")
    began = time.time()
    found = spans.phrase_links(rows, wanted, 6)
    counts = {r["id"]: (r["n"], r["k"]) for r in spans.phrase_hits(found, "id").groupBy("id").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("k")).collect()}
    assert counts == {"big": (n, 1), "small": (1, 1)}
    shown = {r["id"]: (r["n"], r["t"]) for r in found.select("id", spans.phrase_markup(F.col("text"), F.col("links")).alias("m")).select("id", F.length("m").alias("n"), F.when(F.length("m") < 200, F.col("m")).alias("t")).collect()}
    assert shown["big"][0] == len(text) + n * len('<a href="https://example.org/docs/D1"></a>') and shown["small"][1] == 'a &lt; <a href="https://example.org/docs/D1">закону о рынке труда</a> &gt; b'
    assert shown["none"] == (None, None) and shown["empty"] == (0, "")
    assert time.time() - began < 120


def test_deep_nesting(spark):
    """Elements nested 10,000 deep cost no more than their number, and every question about what is around is answered."""
    n = 10_000
    pages = {"deep": "<div>" * n + '<p>Сноска. <a name="z1">x</a></p>' + "</div>" * n, "typed": '<div data-type="статья" data-number="1"><span>' * 40 + '<a href="#q">y</a>' + "</span></div>" * 40}
    nodes = _nodes(spark, pages).cache()
    assert nodes.where("doc_key = 'deep' and depth > 9000").count() > 990
    began = time.time()
    assert dom.in_note(nodes).count() >= 1 and dom.heading_texts(nodes).count() == 0
    assert {r["doc_key"]: r["host"] for r in dom.host(nodes).join(nodes.where("tag = 'a'").select("doc_key", "node_id"), ["doc_key", "node_id"]).collect()} == {"typed": 78}
    assert dom.anchor_ids(nodes).where("doc_key = 'deep'").agg(F.count("*").alias("n"), F.min("anchor").alias("a")).first() == (n + 1, "z1")
    pairs = dom.around(nodes, nodes.where("tag = 'a' and doc_key = 'typed'").select("doc_key", "node_id"), nodes.where("tag = 'span'").select("doc_key", "node_id", "end_id"))
    assert pairs.select("mark.node_id").distinct().count() == 40
    assert time.time() - began < 90


def test_kept_nodes_are_not_shuffled_again(spark, tmp_path):
    """Windows, groups and joins by document over a kept table have no exchange but broadcasts."""
    nodes = html.kept_nodes(spark.createDataFrame([(str(k), f"<article><h3 id='z{k}'>Статья {k}. Имя</h3><p>1. Раз</p></article>") for k in range(40)], "doc_key string, html string"), "doc_key", "html")
    assert nodes.count() == 40 * 5 and nodes.select("doc_key").distinct().count() == 40
    for df in (dom.element_texts(nodes, nodes.where("tag = 'p'").select("doc_key", "node_id", "end_id")), dom.anchor_ids(nodes), dom.host(nodes), dom.in_scope(nodes), dom.links(nodes), chunks.segments_of(nodes)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert [x for x in plan.split("\n") if "Exchange" in x and "Broadcast" not in x] == []


def test_pages_of_one_key(spark):
    """Repeated rows are one page; other pages under the same key get keys of their own; null keys stay."""
    rows = [("a", "<p>x</p>"), ("a", "<p>x</p>"), ("a", "<p>y</p>"), ("b", None), ("b", None), ("c", "z"), (None, "n"), (None, "n"), (None, "m")]
    got = sorted(((r["doc_key"], r["html"]) for r in html.told_apart(spark.createDataFrame(rows, "k string, h string"), "k", "h").collect()), key=str)
    assert len(got) == 6 and {k for k, _ in got} == {"a", "a~2", "b", "c", None, "~2"} and sorted(h or "" for _, h in got) == ["", "<p>x</p>", "<p>y</p>", "m", "n", "z"]


def test_remap_closure(spark):
    """Chains of any length, forks, self-references and cycles with what leads into them."""
    pairs = [(f"D{i}", f"D{i + 1}") for i in range(700)] + [("X", "Y"), ("Y", "Z"), ("Z", "Y"), ("S", "S"), ("F", "G2"), ("F", "G1"), (None, "a"), ("b", None)]
    got = {r["old_id"]: r["new_id"] for r in spans.closed_remap(spark.createDataFrame(pairs, "old_id string, new_id string")).collect()}
    assert got == {**{f"D{i}": "D700" for i in range(700)}, "X": None, "Y": None, "Z": None, "S": None, "F": "G1"}
    assert spans.closed_remap(spark.createDataFrame([], "old_id string, new_id string")).count() == 0


def test_sequence_diff(spark):
    """A longest common subsequence by the table of all prefixes, and what is left by text."""
    rng = random.Random(6)
    for _ in range(3000):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = sequences.common(a, b)
        assert len(found) == best[-1][-1] and all(a[i] == b[j] for i, j in found) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
    kind = "doc_key string, ord int, href string, text string"
    old = [("d", k, f"#z{k}", f"статья {k}") for k in range(50)] + [("gone", 0, "#a", None), ("same", 0, "#x", "y")]
    new = [("d", k, f"#z{k + 1 if k == 7 else k}", f"статья {k}") for k in range(50) if k != 20] + [("d", 99, "#n", "neu"), ("fresh", 0, None, "b"), ("same", 5, "#x", "y")]
    got = audit.sequence_diff(spark.createDataFrame(old, kind), spark.createDataFrame(new, kind))
    assert {tuple(r) for r in got.collect()} == {
        ("d", "retarget", 7, 7, "#z7", "#z8", "статья 7"), ("d", "only_old", 20, None, "#z20", None, "статья 20"), ("d", "only_new", None, 99, None, "#n", "neu"),
        ("gone", "only_old", 0, None, "#a", None, ""), ("fresh", "only_new", None, 0, None, "", "b"),
    }
    assert audit.sequence_diff(spark.createDataFrame([], kind), spark.createDataFrame([], kind)).count() == 0
    import __spark_entry__

    pages = html.kept_nodes(spark.read.parquet(f"{SMALL}/pages.parquet"), "page_id", "html")
    links_ = collections.defaultdict(list)
    for r in dom.links(pages).orderBy("doc_key", "node_id").collect():
        links_[r["doc_key"]].append((r["href"], r["text"]))
    want = collections.Counter()
    for key, old_ in links_.items():
        new_ = []
        for n, (href, text) in enumerate(old_, 1):
            if n % 5 != 3:
                new_.append((href + "#moved" if n % 7 == 2 else href, text))
            if n % 11 == 4:
                new_.append(("/new", "neu"))
        want.update((key, kind_) for kind_, _, _ in sequences.aligned(old_, new_))
    assert collections.Counter((r["doc_key"], r["kind"]) for r in __spark_entry__.queries()["link_sequences"](spark, SMALL).collect()) == want


def test_numbers(spark):
    assert [k for k, v in ROMAN.items() if v in (4, 9, 14, 25, 30)] == ["IV", "IX", "XIV", "XXV", "XXX"] and len(ROMAN) == 26
    got = spark.createDataFrame([("IV",), ("xxx",), ("XXVI",), (None,)], "r string").select(roman(F.col("r"))).collect()
    assert [r[0] for r in got] == [4, 30, 0, 0]
    got = spark.createDataFrame([("первой",), ("двадцатая",), ("третьего",), ("слово",), (None,)], "w string").select(ordinal(F.col("w"))).collect()
    assert [r[0] for r in got] == [1, 20, 3, None, None]


def test_reverse_and_canonical(spark):
    kind = "code string, key string, anchor string"
    back = anchors.reverse_anchors(spark.createDataFrame([("x", "40", "z9")], kind), spark.createDataFrame([("x", "3_1", "z9"), ("x", "2_2", "z4")], kind))
    assert {r["anchor"]: r["article"] for r in back.collect()} == {"z9": "40", "z4": "2"}
    site = "https://example.net/acts/docs/"
    own, other = "K1500000011", "K1400000022"
    want = {
        f"{site}{own}#z5": "#z5", f"{site}{own}#z5_1-2": "#z5_1-2", f"https://mirror.example/rus/docs/{own}#7": "#z7", f"{site}{own}#8": "#8", f"{site}{own}#9": f"{site}{own}#9", f"{site}{own}": "#",
        f"/docs/{own}": f"/docs/{own}", f"/docs/{own}#z5": f"/docs/{own}#z5", f"{site}{own}/history": f"{site}{own}/history", f"{site}{own}_": f"{site}{own}_", f"{site}{own}#p7": f"{site}{own}#p7",
        f"/docs/{other}#12": f"{site}{other}", f"/docs/{other}#p7": f"{site}{other}", f"/docs/{other}_/history": f"{site}{other}_", f"http://x.example/rus/docs/{other}?d=1#z4": f"{site}{other}#z4", "/x": "/x", "#5": "#5", None: None,
    }
    rows = spark.createDataFrame([("d", k) for k in want], "doc_key string, href string").withColumn("was", F.col("href"))
    targets = spark.createDataFrame([("d", "z7"), ("d", "7"), ("d", "8"), ("e", "z9"), ("e", "9")], "doc_key string, id string")
    assert {r["was"]: r["href"] for r in spans.canonical(rows, targets, F.lit(own), site).collect()} == want


def test_swept_shares():
    """Shares of an article that several texts of a block name together; a closed text parts them."""
    found = references.swept_in
    assert found(["по ", "статье", " ", "30", " настоящего Кодекса"]) == [[], [(0, 6, "30")], [], [(0, 2, "30")], []]
    assert found(["по статье ", "5", " настоящего"]) == [[(3, 9, "5")], [(0, 1, "5")], []]
    assert found(["по статье 5 настоящего"]) == [[(3, 11, "5")]] and found([]) == [] and found(["", ""]) == [[], []]
    assert found(["статье ", "\ufffc", " 5 настоящего"]) == [[], [], []] and found(["надстатье 5", " настоящего"]) == [[], []]


def test_context_of_texts(spark):
    """Article and part of every text of odd pages; texts at the top of a page have neither."""
    pages = {
        "top": "вне<h3>Статья 4. Имя</h3>вне",
        "nested": '<div><h3>Статья 4. Имя</h3><p id="z4_2_1">а</p><ul><li><p>б</p></li></ul></div><p>в</p>',
        "heading": "<h3>Статья 4. Имя</h3><p>3. а</p><p>б</p><h2>Глава</h2><p>в</p>",
        "dashes": "<h3>СТАТЬЯ 4-1. Имя</h3><p><b>2-1.</b> а</p><p>1.5 б</p>",
        "anchored": '<p><b><a name="z9"></a>Статья 9. Имя</b></p><p>а</p>',
    }
    got = {(r["doc_key"], r["text"].strip()): (r["article"], r["part"]) for r in references.context(_nodes(spark, pages)).join(_nodes(spark, pages).select("doc_key", "node_id", "text"), ["doc_key", "node_id"]).collect()}
    want = {
        ("top", "вне"): (None, None), ("nested", "а"): ("4", "2"), ("nested", "б"): ("4", None), ("nested", "в"): (None, None), ("heading", "3. а"): ("4", "3"), ("heading", "б"): ("4", "3"), ("heading", "в"): ("4", None),
        ("dashes", "а"): ("4-1", "2-1"), ("dashes", "1.5 б"): ("4-1", "2-1"), ("anchored", "а"): ("9", None),
    }
    assert {k: got[k] for k in want} == want


def test_chunks_of_parts(spark):
    kind = "doc_key string, inst string, code string, doc_id string, article string, title string, unit_type string, status string, code_part string, section string, chapter string, paragraph string, partial boolean, orphan boolean"
    articles = [("a", "1", "koap", "K1", "7", "Т", "часть", "active", "2", None, "3", None, False, False), ("a", "3", "x", "K1", "9", "Б", "пункт", "active", None, None, None, None, True, True)]
    rows = [("a", "1", 0, None, "1. Раз"), ("a", "1", 1, None, "1. Снова"), ("a", "3", 0, None, "только текст")]
    segments = spark.createDataFrame(rows, "doc_key string, inst string, pos int, anchor string, text string")
    made = chunks.chunks(spark.createDataFrame(articles, kind), segments).orderBy("inst", "ord").collect()
    assert [(r["id"], r["meta"]["hier_id"], r["meta"]["hier_dup_seq"], r["meta"]["orphan_pickup"]) for r in made] == [("koap_ст7_ч1", "KOAPCH2G3ST7P1", None, None), ("koap_ст7_ч1~2", "KOAPCH2G3ST7P1~2", 2, None), ("x_ст9", "XST9", None, True)]
    part = '<div data-type="часть"><h2>ОСОБЕННАЯ ЧАСТЬ</h2><div data-type="статья" data-number="5"><h3>Статья 5. Имя</h3><p>1. Раз</p></div></div>'
    found = chunks.parse_articles(_nodes(spark, {"koap": part}), spark.createDataFrame([("koap", "K1")], "code string, doc_id string"))[0].collect()
    assert [(r["article"], r["code_part"], r["unit_type"]) for r in found] == [("5", "2", "часть")]


def test_round_trip_and_heads(spark, tmp_path):
    page = '<html><head></head><body><p class="x">a &amp; b<br>c<!-- n --><a href="/q?a=1&amp;b=2">t</a><p>open</body></html>'
    nodes = _nodes(spark, {"a": page}).cache()
    assert html.serialize(nodes).first()["html"] == page.replace("</a><p>open</body>", "</a></p><p>open</p></body>")
    assert spark.range(1).select(sinks.with_head(F.lit("<head>x<head>"), "!")).first()[0] == "<head>!x<head>"
    (tmp_path / "article_map_x.json").write_text('{"1": "z1", "2": "z2h"}', encoding="utf-8")
    assert {tuple(r) for r in registry.anchor_maps(spark, str(tmp_path / "article_map_*.json")).collect()} == {("x", "1", "z1"), ("x", "2", "z2h")}


def test_stream(spark, tmp_path):
    from lexmill.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<p>x</p>", encoding="utf-8")
    for _ in range(2):
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination(60)
        (tmp_path / "in" / "b.html").write_text("<p>y</p>", encoding="utf-8")
    assert {(r["doc_key"], r["text"]) for r in spark.read.parquet(str(tmp_path / "out")).where("kind = 'text'").collect()} == {("a", "x"), ("b", "y")}
