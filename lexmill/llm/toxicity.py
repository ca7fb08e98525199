"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicon words and stems, how near they stand to second-person words, shares of
capitals and of punctuation, and rates of obfuscated spellings. The lexicon is a fixed list joined with words, and stems
of longer words (an insult comes in many forms), that labelled rows show to be telling: counts of distinct texts, kept where they are far commoner among toxic ones; the
floor is fixed, so a language with few toxic rows is learned as well. A row that trees or calibration learn from sees
the lexicon as it is without that row's text. All of it is fitted on a bounded sample of labelled rows (``SAMPLE``),
dealt by class and weighted back to the classes' sizes; a share of it is kept back for the isotonic fit. The sample is
drawn from the labels before they meet a text, so only its ids are sent to the documents and no text is shuffled.
Trees are Spark ML's. Scoring is row by row and covers every document.

Defined results: null, empty and wordless texts have features of zero and the score that follows from them;
repeated labels and repeated rows of a document each count; labels that are null or without a document are left out;
without both classes to learn from every score is the base rate (0 if there is none); null ids are scored, never
learned from; an empty table of documents gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import arrow_pass, cut

#: Bounds: labels learned from, learned lexicon words (memory of the driver and the tasks).
SAMPLE, LEARNED = 20_000, 50_000
#: Distinct toxic texts that a learned word needs, and its least log odds.
LEAST, ODDS = 5, 2.0
THRESHOLD = 0.7
#: Letters of a stem; a longer word has one.
STEM = 5
WORD = re.compile(r"\w+")
#: What may stand for letters in obfuscated spellings.
LEET = str.maketrans("0134578@$!", "oieastbasi")
# Possessive where giving back can't help: the next character would be of the same class.
MASKED = re.compile(r"(?<!\w)\w++(?:[*@$#!.\-]++\w++)++|(?<!\w)(?:\w[ .\-]){3,}\w(?!\w)")
MIXED = re.compile(r"(?<![\w@.])(?=[^\W\d]*+\d)(?=[\d_]*+[^\W\d_])\w{3,}+(?![\w@])")
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen ihr euch tu te toi ton ta tes vous votre vos usted ustedes tú ti tus vosotros".split())
#: General insults and threats of the four languages.
FIXED = frozenset(
    "idiot idiots stupid moron morons loser losers scum trash pathetic worthless disgusting clown dumb fool imbecile kill hate "
    "dumm dummkopf trottel arschloch abschaum wertlos ekelhaft hasse idiote imbécile connard salaud débile nul ordure déteste "
    "estúpido tonto imbécil basura inútil asqueroso escoria odio payaso".split()
)
NAMES = ["fixed", "fixed_kinds", "learned", "learned_kinds", "stems", "stem_kinds", "near_you", "you", "capitals", "shouted", "punctuation", "marks", "masked", "mixed", "masked_hits", "log_words", "hits"]


def stem(word: str) -> str | None:
    """The lexicon's entry for the begin of a word; null if it has no more letters than that."""
    return f"{word[:STEM]}*" if len(word) > STEM else None


def features(text: str | None, learned: frozenset[str]) -> list[float]:
    """The dense features in the order of ``NAMES``."""
    if not text or not (ws := WORD.findall(text)):
        return [0.0] * len(NAMES)
    low = [w.lower() for w in ws]
    n = len(ws)
    at = [i for i, w in enumerate(low) if w in FIXED or w in learned]
    fixed = [low[i] for i in at if low[i] in FIXED]
    own = [low[i] for i in at if low[i] in learned]
    stems = [x for w in low if (x := stem(w)) in learned]
    you = [i for i, w in enumerate(low) if w in SECOND_PERSON]
    near = 0.0
    if at and you:
        a, y = np.array(at), np.array(you)
        k = np.searchsorted(y, a)
        gap = np.minimum(np.abs(y[np.minimum(k, len(y) - 1)] - a), np.abs(a - y[np.maximum(k - 1, 0)]))
        near = float(np.mean(1.0 / (1.0 + gap)))
    letters = sum(map(len, ws))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    capitals = int(np.count_nonzero((points - 65 < 26) | (points - 0xC0 < 31)))  # A-Z and the Latin-1 capitals
    masked = MASKED.findall(text)
    # A masked spelling counts as a hit if, restored, it is a lexicon word.
    masked_hits = sum(1 for m in masked if (w := re.sub(r"[\W_]", "", m.lower().translate(LEET))) in FIXED or w in learned)
    mixed = MIXED.findall(text)
    masked_hits += sum(1 for m in mixed if (w := m.lower().translate(LEET)) in FIXED or w in learned)
    marks = text.count("!") + text.count("?")
    return [
        len(fixed) / n, float(len(set(fixed))), len(own) / n, float(len(set(own))), len(stems) / n, float(len(set(stems))), near, len(you) / n, capitals / max(letters, 1),
        sum(1 for w in ws if len(w) > 2 and w.isupper()) / n, (len(text) - letters - text.count(" ")) / len(text), marks / n,
        len(masked) / n, len(mixed) / n, float(masked_hits), float(np.log1p(n)), float(len(at)),
    ]


def add_features(df: DataFrame, learned: frozenset[str], without: tuple[frozenset[str], frozenset[str]] | None = None) -> DataFrame:
    """``df`` with features; with ``without`` (lexicons less one clean or one toxic text), by the row's label ``toxic``."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(names.index("text"))
            if without is None:
                rows = [features(t.as_py(), learned) for t in texts]
            else:
                rows = [features(t.as_py(), without[y.as_py()]) for t, y in zip(texts, b.column(names.index("toxic")), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.list_(pa.float64()))], [*names, "features"])

    return arrow_pass(df, run, StructType([*df.schema.fields, StructField("features", ArrayType(DoubleType()))]))


def learn_lexicon(labelled: DataFrame, most: int = LEARNED) -> tuple[frozenset[str], frozenset[str], frozenset[str]]:
    """Words and stems (ending in a star) of labelled rows (text, toxic) that are far commoner among toxic ones: smoothed log odds of at least ``ODDS``.

    Distinct texts are counted (copies of one text are one), and ``LEAST`` toxic ones are needed. Also what would be
    learned with one clean text less, and with one toxic text less, that has the word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(b.column(0), b.column(1), strict=True):
                ws = set(WORD.findall((text.as_py() or "").lower()))
                for w in ws | {x for w in ws if (x := stem(w))}:
                    seen.setdefault(w, [0, 0])[toxic.as_py()] += 1
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "clean": pa.array([x[0] for x in seen.values()], pa.int64()), "toxic": pa.array([x[1] for x in seen.values()], pa.int64())})

    texts = cut(labelled.select("text", "toxic", F.xxhash64("text").alias("h")).dropDuplicates(["h", "toxic"]).select("text", "toxic"), "distinct-labelled")
    counts = arrow_pass(texts, run, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    size = texts.agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).first()
    if not size["clean"] or not size["toxic"]:
        return frozenset(), frozenset(), frozenset()

    def passes(toxic: Column, clean: Column) -> Column:
        return (toxic >= LEAST) & (F.log((toxic + 0.5) / (size["toxic"] + 1)) - F.log((clean + 0.5) / (size["clean"] + 1)) >= ODDS)

    toxic, clean = F.col("toxic"), F.col("clean")
    # Fewer clean texts only let more words pass, fewer toxic ones less.
    found = counts.select("word", "toxic", passes(toxic, clean).alias("now"), passes(toxic, F.greatest(clean - 1, F.lit(0))).alias("less_clean"), passes(toxic - 1, clean).alias("less_toxic"))
    rows = found.where("less_clean").orderBy(F.desc("toxic"), "word").limit(most).collect()
    return tuple(frozenset(r["word"] for r in rows if r[n]) for n in ("now", "less_clean", "less_toxic"))


class Scorer:
    """Lexicon, trees and calibration; ``rate`` serves where there was nothing to learn from."""

    def __init__(self, learned: frozenset[str], trees: GBTClassificationModel | None, calibration: IsotonicRegressionModel | None, rate: float) -> None:
        self.learned, self.trees, self.calibration, self.rate = learned, trees, calibration, rate

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` without text, with score (0 to 1) added."""
        rest = [c for c in df.columns if c != "text"]
        if self.trees is None:
            return df.select(*rest, F.lit(self.rate).alias("score"))
        row = F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row")  # no column name can clash with the model's
        x = add_features(df.select(row, "text"), self.learned).select("row", array_to_vector("features").alias("features"))
        raw = self.trees.transform(x).select("row", vector_to_array("probability")[1].alias("features"))
        return self.calibration.transform(raw).select("row.*", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "prediction")).alias("score"))


def deal(marks: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most about ``sample`` of the labels (doc_id, toxic: 0 or 1) with weight, those with the least hash of the id.

    Half are of either class, more where the other has fewer; a weight is the number of rows that one stands for.
    """
    size = marks.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    toxic = size["toxic"] or 0
    clean = size["n"] - toxic
    share = {1: min(1.0, max(sample / 2, sample - clean) / max(toxic, 1)), 0: min(1.0, max(sample / 2, sample - toxic) / max(clean, 1))}
    of_class = lambda x: F.when(F.col("toxic") == 1, F.lit(x[1])).otherwise(F.lit(x[0]))
    dealt = marks.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < of_class({y: int(p * (1 << 30)) for y, p in share.items()}))
    return dealt.withColumn("weight", of_class({y: 1.0 / p for y, p in share.items()}))


def fit(documents: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Learn from ``documents`` (doc_id, text) and ``marks`` (doc_id and toxic, 0 or 1), a sample of at most about ``sample`` labels."""
    few = cut(deal(marks.select("doc_id", F.col("toxic").cast("int").alias("toxic")), sample), "sampled-labels")
    # At most about ``sample`` ids and weights: the one broadcast, whatever the tables' sizes.
    rows = cut(documents.select("doc_id", "text").join(F.broadcast(few), "doc_id"), "labelled-sample")
    size = rows.agg(F.sum("weight").alias("n"), F.sum(F.col("toxic") * F.col("weight")).alias("toxic")).first()
    n, toxic = size["n"] or 0.0, size["toxic"] or 0.0
    if not toxic or toxic == n:
        return Scorer(frozenset(), None, None, toxic / n if n else 0.0)
    learned, *without = learn_lexicon(rows)
    part = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(3)).alias("part")
    x = cut(add_features(rows.select("text", "toxic", part, "weight"), learned, tuple(without)).select(array_to_vector("features").alias("features"), "toxic", "part", "weight"), "toxic-features")
    train, kept_back = x.where("part < 2"), x.where("part = 2")
    if train.select("toxic").distinct().count() < 2 or kept_back.isEmpty():
        return Scorer(frozenset(), None, None, toxic / n)
    trees = GBTClassifier(labelCol="toxic", weightCol="weight", maxIter=20, maxDepth=4, stepSize=0.2, maxBins=64, minInstancesPerNode=5, seed=11).fit(train)
    raw = trees.transform(kept_back).select(vector_to_array("probability")[1].alias("features"), F.col("toxic").cast("double").alias("label"), "weight")
    return Scorer(learned, trees, IsotonicRegression(weightCol="weight").fit(raw), toxic / n)


HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 3 = 1"


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learned from labels of rows that are not held out."""
    marks = labels.where(f"toxic in (0, 1) and not ({HELD_OUT})").select("doc_id", "toxic")
    rows = documents.select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "text")
    return fit(documents, marks).score(rows).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
