"""Filter audit, structure repair and source mix against DuckDB, brute force and their own promises."""

import collections
import hashlib
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lexmill.llm import filteraudit, mixing, turnrepair
from lexmill.llm.queries import SQL

PROSE = " ".join(f"word{i * 7919 % 401}" for i in range(400))
DOCS = [
    (1, PROSE, "en", "s1"), (1, PROSE, "en", "s1"), (2, PROSE, "de", "s2"), (3, None, None, None), (4, "", "en", "s1"), (5, " \n\t ", "de", None), (None, PROSE, "fr", "s3"), (None, None, None, "s3"),
    (6, PROSE * 40, "en", "s4"), (7, "LOUD #1 | loud", None, "s5"), (8, "\x1c\x85 a\x0bb", "", "Ä"), (9, "A" * 11 + " b" * 100, "en", "ä"), (10, "LOUD #1 | loud", "en", "\U0001f600"), (11, "x", "en", "￮"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, None, 1), (6, 1, None), (None, 1, 1), (99, 1, 1), (7, 1, 1), (10, 0, 1)]


def rows_of(df, columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def duck(name, **tables):
    con = duckdb.connect()
    for table, (kind, rows) in tables.items():
        con.sql(f"CREATE TABLE {table} ({kind})")
        if rows:
            con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    got = con.sql(SQL[name])
    return collections.Counter(got.fetchall()), got.columns


def clashing(df, *names):
    return df.select("*", *(F.lit("x").alias(n) for n in names))


def test_filter_audit(spark):
    kinds = "doc_id long, text string, lang string, source string", "doc_id long, quality int, toxic int"
    for docs, labels in ((DOCS, LABELS), ([], [])):
        own, said = spark.createDataFrame(docs, kinds[0]), spark.createDataFrame(labels, kinds[1])
        want, columns = duck("op11_filter_audit", documents=("doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR", docs), labels=("doc_id BIGINT, quality INT, toxic INT", labels))
        got = filteraudit.filter_audit(clashing(own, "part", "A", "E", "n", "t", "w", "sha", "good"), clashing(said, "good", "first", "n", "part"))
        assert rows_of(got, columns) == want
        assert len(want) == 600 * len({d[2] or "" for d in docs})


def test_filter_audit_shares_states(spark, monkeypatch):
    """Every set of filters is a state once, whatever the orders, and what was persisted is let go."""
    rows = spark.createDataFrame([("p", k & 1 > 0, k & 2 > 0, k & 4 > 0, k) for k in range(8)], "part string, x boolean, y boolean, z boolean, n long")
    held = []
    kind = type(rows)
    monkeypatch.setattr(kind, "persist", lambda self, level, f=kind.persist: held.append(f(self, level)) or held[-1])
    edges = filteraudit.removals(rows, {f: F.col(f) for f in "xyz"}, {"many": F.col("n") > 3})
    got = {(r["state"], r["filter"]): (r["survivors"], r["removed"], r["many"]) for r in edges.collect()}
    want = {}
    for size in range(3):
        for state in itertools.combinations("xyz", size):
            alive = [k for k in range(8) if not any(k & 1 << "xyz".index(f) for f in state)]
            for f in set("xyz") - set(state):
                gone = [k for k in alive if k & 1 << "xyz".index(f)]
                want["".join(state), f] = (sum(alive), sum(gone), sum(k for k in gone if k > 3))
    assert got == want
    assert len(held) == 7 and not any(df.is_cached for df in held)


def brute_repair(turns):
    """The cheapest edits of (role, text) turns by trying all, as (cost, audit, repaired)."""
    seen, fixed = set(), []
    for role, text in turns:
        blank = not text.strip(turnrepair.BLANKS)
        fixed.append((role, text, blank or (role, text) in seen, text.rstrip(turnrepair.BLANKS)[-1:] not in ("!", "?", ".")))
        seen.add((role, text))
    best = None

    def walk(k, last, cost, audit, done):
        nonlocal best
        if best and cost > best[0]:
            return
        if k == len(fixed) and last in ("", "a") and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, done)
        for role in ("user", "assistant"):
            if len(done) < len(turns) + 2 and last + role[0] in ("u", "su", "au", "ua"):
                walk(k, role[0], cost + 5, audit + "I", [*done, f"{role}:"])
        if k < len(fixed):
            role, text, goes, late = fixed[k]
            walk(k + 1, last, cost + 2, audit + "D", done)
            if not goes:
                if role and last + role[0] in ("s", "u", "su", "au", "ua"):
                    walk(k + 1, role[0], cost + 5 * late, audit + "K", [*done, f"{role}:{text}"])
                for new in ("user", "assistant"):
                    if last + new[0] in ("u", "su", "au", "ua"):
                        walk(k + 1, new[0], cost + 1 + 5 * late, audit + "R", [*done, f"{new}:{text}"])

    walk(0, "", 0, "", [])
    return best


def test_repair_by_trying_all(spark):
    rng = random.Random(5)
    talks = {}
    for conv in range(150):
        talks[conv] = [(rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", "unknown"]), rng.choice(["Yes.", "No!", "Why?", "so", " ", "", f"t{rng.randrange(99)}.", "end. \n"])) for _ in range(rng.randrange(1, 7))]
    rows = spark.createDataFrame([(c, t, *x) for c, turns in talks.items() for t, x in enumerate(turns)], "conv_id long, turn long, role string, text string")
    told = turnrepair.turns(rows)
    found = turnrepair.audits(turnrepair.coded(told)).cache()
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in found.collect()}
    done = collections.defaultdict(list)
    for r in turnrepair.repaired(rows, found).orderBy("conv_id", "ord").collect():
        done[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for conv, turns in talks.items():
        cost, audit, lines = brute_repair(turns)
        assert (got[conv], done[conv]) == ((cost, audit), lines), turns
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in turnrepair.structure_audit(rows).collect()}
    assert hashes == {c: hashlib.sha256("\n".join(done[c]).encode()).hexdigest() for c in talks}


TALKS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 1, "assistant", "Hi."), (1, 2, None, None), (1, None, "user", "What?"), (1, None, "assistant", "x"), (1, 9, "assistant", "Yes. \x0b"),
    (2, None, "user", "a."), (2, None, "assistant", "b"), (None, 1, "user", "Hi."), (None, None, None, None), (None, 7, "assistant", "No"), (3, 1, "user", "\x85"), (3, 2, "assistant", "d."), (4, 0, "user", "a" * 100_000 + "."), (5, -3, "user", ""),
]


def test_damaged_talks(spark):
    more = [(c, t, ["user", "assistant"][t % 2], f"turn {t}.") for c in range(40, 70) for t in range(3)] + [(77, 5, "user", "same.")] * 40
    kind = "conv_id long, turn long, role string, text string"
    for rows in (TALKS + more, []):
        got = turnrepair.damage_audit(clashing(spark.createDataFrame(rows, kind), "sha", "n", "part", "codes", "audit", "cost", "k", "blank"))
        want, columns = duck("op12_turn_repair", conversations=("conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", rows))
        assert rows_of(got, columns) == want


def test_long_talk_over_many_tasks(spark):
    """A conversation that range partitioning deals over many tasks is repaired as in one."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        roles = ["user", "assistant", "assistant", "user", "system", "assistant", "user"]
        rows = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(*map(F.lit, roles)), (F.col("id") % 7 + 1).cast("int")).alias("role"), F.concat(F.lit("t"), F.col("id") % 2500, F.when(F.col("id") % 5 > 0, ".").otherwise("")).alias("text"))
        parts = turnrepair.coded(turnrepair.turns(rows)).cache()
        assert parts.count() > 3
        (row,) = turnrepair.audits(parts).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        (one,) = turnrepair.audits(turnrepair.coded(turnrepair.turns(rows))).collect()
        assert (row["audit"], row["cost"], row["illegal"]) == (one["audit"], one["cost"], one["illegal"]) and len(row["audit"].replace("I", "")) == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_source_mix(spark):
    kind = "doc_id long, text string, lang string, source string"
    unique = list({(d[0], d[1], d[3]): d for d in DOCS}.values())
    for docs in (unique, []):
        got = mixing.mixed(clashing(spark.createDataFrame(docs, kind), "size", "h", "n", "of", "range", "bucket", "edge", "target", "salt"))
        want, columns = duck("op13_source_mix", documents=("doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR", docs))
        assert rows_of(got, columns) == want
    assert mixing.mixed(spark.createDataFrame([(1, None, "en", "s"), (2, "", "en", None)], kind)).where("taken <> 0 or target <> 0").count() == 0


def test_source_mix_of_equal_rows_and_many_sources(spark):
    """Equal rows are split by count, targets are met within a document, and fill up as one by one resharing does."""
    same = [(7, "one two three", "en", "a")] * 10_000
    other = [(k, "w " * (k % 50), "en", f"s{k % 900:04d}") for k in range(9000)]
    docs = spark.createDataFrame(same + other, "doc_id long, text string, lang string, source string")
    got = mixing.mixed(docs).cache()
    assert got.count() == 19_000 and rows_of(got, got.columns) == rows_of(mixing.mixed(docs.repartition(13)), got.columns)
    sizes = collections.Counter()
    for _, text, _, source in same + other:
        sizes[source] += len(text.split())
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    held: dict[str, float] = {}
    while True:
        left, free = sum(sizes.values()) - sum(held.values()), [s for s in sizes if s not in held]
        over = [s for s in free if left * weights[s] / sum(weights[x] for x in free) > 3 * sizes[s]]
        if not over:
            break
        held |= {s: 3 * sizes[s] for s in over}
    want = held | {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect():
        s = r["source"]
        assert r["size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and abs(r["taken"] - want[s]) <= 25 and r["over"] <= 0
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_source_mix_is_native(spark, monkeypatch):
    """No stage of the plan is Python."""
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")
    docs.write.mode("overwrite").parquet(path := mixing.cut(docs, "docs").inputFiles()[0].rsplit("/", 1)[0] + "-again")
    plans = []
    monkeypatch.setattr(mixing, "cut", lambda df, name, f=mixing.cut: plans.append(df._jdf.queryExecution().toString()) or f(df, name))
    plans.append(mixing.mixed(spark.read.parquet(path))._jdf.queryExecution().toString())
    assert len(plans) > 8 and not any(word in plan for plan in plans for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
