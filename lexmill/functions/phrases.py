"""Phrases of a dictionary in texts: one automaton a block of the dictionary, one Arrow pass a block, no shuffle."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases whose automaton is sent to the tasks at a time (some hundred bytes each); a larger dictionary takes more passes.
BLOCK = 100_000
SPAN = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("phrase", pa.string()), ("value", pa.string())]))


def lowered(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _blocks(phrases: DataFrame, block: int) -> Iterator[list[tuple[str, str]]]:
    rows = phrases.select(F.col("phrase").cast("string"), F.col("value").cast("string")).where("length(phrase) > 0").distinct()
    n = -(-rows.count() // block) or 1
    for k in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("phrase", "value"), F.lit(n)) == k).collect()]  # ``block`` rows, on average


def phrase_spans(rows: DataFrame, phrases: DataFrame, text: str = "text", words: bool = True, block: int = BLOCK) -> DataFrame:
    """``rows`` with spans: every place (s, e, phrase, value) of every phrase, without regard to case.

    With ``words`` a phrase's white space stands for any white space and its ends must not cut a word or a number.
    Null texts have no place; of phrases that are equal but for case every one is found.
    """
    rows = rows.withColumn("spans", F.array().cast("array<struct<s:int,e:int,phrase:string,value:string>>"))
    names = rows.columns
    at, last = names.index(text), names.index("spans")
    for found in _blocks(phrases, block):
        held = rows.sparkSession.sparkContext.broadcast(found)

        def run(batches: Iterator[pa.RecordBatch], held: object = held) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(held.value, words)
            for b in batches:
                made = []
                for t, so_far in zip(b.column(at), b.column(last), strict=True):
                    found = so_far.as_py()
                    if t.is_valid and len(automaton):
                        found = found + list(_places(automaton, t.as_py(), words))
                    made.append(found)
                columns = [*b.columns]
                columns[last] = pa.array(made, SPAN)
                yield pa.RecordBatch.from_arrays(columns, names)

        rows = rows.mapInArrow(run, rows.schema)
    return rows


#: The automaton that this worker has built last, and what of: tasks of one pass share it.
_BUILT: dict[bool, tuple[list, object]] = {}


def _automaton(phrases: list[tuple[str, str]], words: bool) -> object:
    if _BUILT.get(words, (None,))[0] is not phrases:
        import ahocorasick

        automaton, by_key = ahocorasick.Automaton(), {}
        for phrase, value in phrases:
            key = " ".join(lowered(phrase).split()) if words else lowered(phrase)
            if key:
                by_key.setdefault(key, []).append((phrase, value))
        for key, own in by_key.items():
            automaton.add_word(key, (len(key), own))
        if by_key:
            automaton.make_automaton()
        _BUILT[words] = phrases, automaton
    return _BUILT[words][1]


def _places(automaton: object, text: str, words: bool) -> Iterator[dict]:
    if words:
        tokens = [m.span() for m in re.finditer(r"\S+", text)]
        plain = lowered(" ".join(text[a:b] for a, b in tokens))
    else:
        plain = lowered(text)
    k, base = 0, 0  # the token that holds the place, and where it begins in ``plain``
    for end, (size, own) in automaton.iter(plain):
        start = end - size + 1
        if words:
            if (start and plain[start - 1].isalnum()) or (end + 1 < len(plain) and plain[end + 1].isalnum()):
                continue
            while k + 1 < len(tokens) and base + tokens[k][1] - tokens[k][0] + 1 <= end:
                base += tokens[k][1] - tokens[k][0] + 1
                k += 1
            s, (i, at) = end - base + tokens[k][0] + 1, (k, base)
            while at > start:
                i -= 1
                at -= tokens[i][1] - tokens[i][0] + 1
            a = start - at + tokens[i][0]
        else:
            a, s = start, end + 1
        for phrase, value in own:
            yield {"s": a, "e": s, "phrase": phrase, "value": value}
