"""Conversation structure repair: the cheapest edits that make the turns of a conversation alternate.

Turns are kept, given the role user or assistant, or deleted, and empty turns are inserted, until the roles' initials
read ``(s?(ua)+)?``. Which turns are retained is a dynamic program: deletions are a prefix sum that all states share, so a
gap between two retained turns costs nothing but what their pair of roles makes it insert, and a running minimum a state
(nothing yet, s, u or a retained last) stands for all turns that the next retained one may follow. Equal costs are
decided by the audit (the edits' initials, ASCII-least): the states' audits differ and none begins another, so their
order alone decides and is carried on as four ranks. Costs relative to their least and ranks take few values, so the
steps are a small automaton that each worker fills as it goes.

Plan: turns are grouped by (conversation, turn, role, hash of the text), which counts equal ones and finds the first of
repeated ones; a range partitioning by these keys deals a long conversation over many tasks, each of which writes its
turns as one byte each; only these bytes are gathered, and as many as the audit has characters anyway. The audit then
meets the texts, sorted by conversation, in a pass that holds one batch: the repaired turns come out as rows.

Defined results: turns come by turn (null first), then role, then SHA-256 of the text; null roles and texts are one
space; a null conv_id is a conversation; equal rows are repeated turns, of which the first stays. A turn is at fault once:
blank before duplicate before truncated. Conversations without turns, and an empty table, have no rows here. Extra
columns play no part, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass, cut

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: Bits of a turn's byte: its role's initial, whether it must go, whether it is truncated.
INITIALS = {"s": 1, "u": 2, "a": 3}
GOES, OPEN = 4, 8
LEGAL = {(1, 2), (2, 3), (3, 2)}
#: What must be inserted between a state and the role that is retained next (u, a), and behind the last one.
BEFORE = {2: (0, 0, 1, 0), 3: (1, 1, 0, 1)}
BEHIND = (0, 2, 1, 0)
FAR = 1 << 60


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults by crc32 of ``conv_id:turn`` modulo 20: dropped, emptied, no end signs, repeated, role user."""
    blank = F.lit(" ")
    told = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    k = F.crc32(F.concat(told[0], F.lit(":"), told[1])) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    text = F.when(k == 1, "").when(k == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = conversations.select("conv_id", "turn", F.when(k == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("times")))).drop("col")


def _keyed(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")).withColumn("sha", F.unhex(F.sha2("text", 256)))


def _in_order() -> list[Column]:
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")]


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, sha, n, blank, open, new): equal turns as one row without its text; ``new`` if its role and text come first here."""
    said = F.rtrim("text", F.lit(BLANKS))
    flagged = _keyed(rows).select("conv_id", "turn", "role", "sha", (said == "").alias("blank"), (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("open"))
    once = cut(flagged.groupBy(*flagged.columns).agg(F.count("*").alias("n")), "turns")
    # A join on the turn as well: no conversation and no often repeated text meets in one task.
    first = once.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("sha").alias("h")).agg(F.min(F.struct(F.col("turn").isNotNull(), "turn"))["turn"].alias("t"), F.lit(True).alias("new"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("h")) & F.col("turn").eqNullSafe(F.col("t"))
    return once.join(first, same, "left").select(*once.columns, F.coalesce("new", F.lit(False)).alias("new"))


def faults(told: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) of ``turns``."""
    new = F.when(F.col("new"), 1).otherwise(0)
    return told.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"), F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - new)).alias("duplicate"), F.sum(F.when(~F.col("blank") & F.col("new") & F.col("open"), 1).otherwise(0)).cast("long").alias("truncated"),
    )


def coded(told: DataFrame) -> DataFrame:
    """(conv_id, part, codes): the turns of a conversation that one task of a range partitioning holds, a byte each."""
    initials = F.create_map(*(F.lit(x) for pair in INITIALS.items() for x in pair))
    initial = F.coalesce(F.element_at(initials, F.left("role", F.lit(1))), F.lit(0))
    code = initial + F.when(F.col("blank") | ~F.col("new"), GOES).otherwise(0) + F.when(F.col("open"), OPEN).otherwise(0)
    kind = dict(told.dtypes)["conv_id"]
    order = _in_order()
    rows = told.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", code.cast("int").alias("code"), "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, codes, of = TaskContext.get().partitionId(), None, bytearray(), pa.null()

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([own], of), pa.array([part], pa.int32()), pa.array([bytes(codes)], pa.binary())], ["conv_id", "part", "codes"])

        for b in batches:
            of = b.schema.field(0).type
            for conv, code, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if codes and conv != own:
                    yield made()
                    codes = bytearray()
                own = conv
                codes.append(code)
                codes += bytes([code | GOES]) * (n - 1)
        if codes:
            yield made()

    return arrow_pass(rows, run, f"conv_id {kind}, part int, codes binary")


@functools.lru_cache(maxsize=1 << 14)
def step(state: tuple, code: int) -> tuple[tuple, int, tuple]:
    """One turn from ``state`` (costs relative to the least, ranks of the audits): the next state, the least cost's growth, each state's (before, edits).

    Costs are relative to deleting everything so far, so that a deleted turn changes none.
    """
    costs, ranks = state
    best = [(costs[q], ranks[q], "D", q) for q in range(4)]
    if not code & GOES:
        late = TRUNCATED if code & OPEN else 0
        own = code & 3
        for q, before in BEFORE.items():
            letter, price = ("K", KEEP) if own == q else ("R", REROLE)
            for p in range(4):
                if costs[p] < FAR:
                    best[q] = min(best[q], (costs[p] + INSERT * before[p] + price + late - DELETE, ranks[p], "I" * before[p] + letter, p))
        if own == 1 and costs[0] < FAR:
            best[1] = min(best[1], (costs[0] + KEEP + late - DELETE, ranks[0], "K", 0))
    order = sorted((q for q in range(4) if best[q][0] < FAR), key=lambda q: best[q][1:3])
    least = min(x[0] for x in best)
    rank = {q: k for k, q in enumerate(order)}
    return (tuple(x[0] - least if x[0] < FAR else FAR for x in best), tuple(rank.get(q, 4) for q in range(4))), least, tuple((x[3], x[2]) for x in best)


def repaired_audit(codes: bytes) -> tuple[str, int]:
    """The audit of the cheapest edits of a conversation's turns, and their cost. Four bytes a turn are held."""
    state, total = ((0, FAR, FAR, FAR), (0, 4, 4, 4)), 0
    known: dict[tuple, int] = {}
    back: list[tuple] = []
    path = array("I")
    for code in codes:
        key = (state, code)
        k = known.get(key)
        if k is None:
            k = known[key] = len(back)
            back.append(step(state, code))
        path.append(k)
        state, grown, _ = back[k]
        total += grown
    costs, ranks = state
    q = min(range(4), key=lambda q: (costs[q] + INSERT * BEHIND[q], ranks[q]))
    total += costs[q] + INSERT * BEHIND[q] + DELETE * len(codes)
    letters = ["I" * BEHIND[q]]
    for k in reversed(path):
        q, edits = back[k][2][q]
        letters.append(edits)
    return "".join(reversed(letters)), total


def audits(parts: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit) of ``coded``: neighbours that may not follow one another, and the cheapest edits."""
    kind = dict(parts.dtypes)["conv_id"]
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "codes"))).alias("parts"))  # one a task, a byte a turn

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            illegal, costs, found = [], [], []
            for own in b.column(1).to_pylist():
                codes = b"".join(x["codes"] for x in own)
                illegal.append(sum((x & 3, y & 3) not in LEGAL for x, y in zip(codes, codes[1:])))
                audit, cost = repaired_audit(codes)
                costs.append(cost), found.append(audit)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array(found, pa.string())], ["conv_id", "illegal", "cost", "audit"])

    return arrow_pass(whole, run, f"conv_id {kind}, illegal long, cost long, audit string")


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, ord, edit, role, text): the turns that remain or are inserted, in order; a conversation's rows stay together in one task."""
    kind = dict(rows.dtypes)["conv_id"]
    none = F.lit(None)
    first = audited.select("conv_id", F.lit(0).alias("kind"), none.cast(dict(rows.dtypes)["turn"]).alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("sha"), F.col("audit").alias("text"))
    rest = _keyed(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "sha", "text")
    order = _in_order()
    met = first.unionByName(rest).repartition("conv_id").sortWithinPartitions(order[0], F.col("kind"), *order[1:]).select("conv_id", "kind", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, audit, at, n, last, tail = None, "", 0, 0, "", 0
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])

            def put(edit: str, role: str, text: str) -> None:
                nonlocal n, last
                for x, v in zip(out, (own, n, edit, role, text), strict=True):
                    x.append(v)
                n, last = n + 1, role[:1]

            def inserts() -> None:
                nonlocal at
                while at < len(audit) and audit[at] == "I":
                    put("I", "assistant" if last == "u" else "user", "")
                    at += 1

            ids = b.column(0).to_pylist()
            for k, head in enumerate(b.column(1).to_pylist()):
                if head == 0:
                    own, audit, at, n, last = ids[k], b.column(3)[k].as_py(), 0, 0, ""
                    tail = len(audit.rstrip("I"))  # what follows is inserted behind the last turn
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put("K", b.column(2)[k].as_py(), b.column(3)[k].as_py())
                elif edit == "R":
                    put("R", "assistant" if last == "u" else "user", b.column(3)[k].as_py())
                if at == tail:
                    inserts()
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.schema.field(0).type), pa.array(out[1], pa.int64()), *(pa.array(x, pa.string()) for x in out[2:])], ["conv_id", "ord", "edit", "role", "text"])

    return arrow_pass(met, run, f"conv_id {kind}, ord long, edit string, role string, text string")


def digests(done: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired``: ``role:text``, joined by newlines, one after the other."""
    kind = dict(done.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sha = None, None
        names = ["conv_id", "repaired_sha256"]
        for b in batches:
            for k, (n, role, text) in enumerate(zip(b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)):
                if n == 0:
                    if sha:
                        yield pa.RecordBatch.from_arrays([own, pa.array([sha.hexdigest()])], names)
                    own, sha = b.column(0)[k : k + 1], hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
        if sha:
            yield pa.RecordBatch.from_arrays([own, pa.array([sha.hexdigest()])], names)

    return arrow_pass(done, run, f"conv_id {kind}, repaired_sha256 string")


def structure_audit(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of ``rows``."""
    told = cut(turns(rows), "told")
    found = cut(audits(coded(told)), "audits")
    hashes = digests(repaired(rows, found))
    out = faults(told)
    for more in (found, hashes):
        more = more.withColumnRenamed("conv_id", "of")
        out = out.join(more, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    return out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())))


def damage_audit(conversations: DataFrame) -> DataFrame:
    """``structure_audit`` of ``damaged`` conversations, one row for each of the original ones: zeros and nothing where no turn is left."""
    out = structure_audit(damaged(conversations))
    every = conversations.select("conv_id").distinct()
    got = every.join(out.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    texts = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return got.select("conv_id", *zeros.values(), *(F.coalesce(c, F.lit(v)).alias(c) for c, v in texts.items()))
