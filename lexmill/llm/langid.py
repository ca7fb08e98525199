"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies of hashed 1- to 3-grams are counted over all documents that may be learned from. The weights
are fitted by follow-the-regularised-leader with elastic-net penalties (proximal, per-coordinate rates) on a bounded
sample of them (``SAMPLE`` distinct texts of each language, those with the least hash), then a temperature is fitted on
rows of the sample kept back. Whole texts become n-gram counts in the tasks, so a row of the sample has at most ``DIM``
entries however long its text. Every language that has a text with a letter is learned; the weights take ``DIM``
numbers for each. Prediction is row by row in Arrow batches, over whole texts.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties go to the language that
sorts first; with no row to learn from every text is ``und``; null languages are never learned; repeated texts of a
language are learned once and count in the frequencies each; columns of the input that are named like the added ones
are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import arrow_pass

#: Hashed features, n-gram lengths, characters handled at a time.
DIM, GRAMS, PIECE = 1 << 15, (1, 2, 3), 1 << 18
#: Bounds of what is learned from: distinct texts of each language and of all, n-gram entries of all; one text of each
#: language is always taken.
SAMPLE, SAMPLE_ROWS, SAMPLE_ENTRIES = 1500, 8000, 1 << 24
UNKNOWN = "und"
#: The elastic net: what a sum of gradients must exceed for a weight, and the shrinkage of weights.
L1, L2 = 0.1, 1e-3


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed character n-grams of the whole lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros(DIM, np.int64)
    longest = max(GRAMS)
    for at in range(0, len(points), PIECE):
        part = points[at : at + PIECE + longest - 1].astype(np.uint64)
        for n in GRAMS:
            m = min(PIECE, len(part) - n + 1)
            if m <= 0:
                break
            h = np.full(m, n, np.uint64)
            for i in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + part[i : i + m]
            counts += np.bincount((h * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(49)).astype(np.int64), minlength=DIM)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def document_frequencies(labelled: DataFrame) -> tuple[np.ndarray, int]:
    """Document frequency of every hashed n-gram and the number of rows, over all rows of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(DIM + 1, np.int64), 0
        for b in batches:
            for t in b.column(0):
                df[:DIM] += gram_counts(t.as_py()) > 0
                rows += 1
        df[DIM] = rows
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(used, pa.int32()), "n": pa.array(df[used], pa.int64())})

    total = np.zeros(DIM + 1, np.int64)
    for r in arrow_pass(labelled.select("text"), run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():  # DIM + 1 rows at most
        total[r["feature"]] = r["n"]
    return total[:DIM], int(total[DIM])


def learning_rows(labelled: DataFrame, sample: int) -> list[tuple[np.ndarray, np.ndarray, str]]:
    """(n-grams, counts, lang) of the sample, in the order of its hashes."""
    h = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 40))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}  # one row a language
    if not sizes:
        return []
    each, entries = max(1, min(sample, SAMPLE_ROWS // len(sizes))), max(1, SAMPLE_ENTRIES // len(sizes))
    known = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, (1.5 * each + 20) / n) * (1 << 40)))])
    # A share by hash with room to spare, so that no sort of all rows is needed.
    some = labelled.where(h < F.element_at(known, F.col("lang"))).groupBy("lang", "text").count().select("lang", "text", h.alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, counts = [], []
            for t in b.column(1):
                found = gram_counts(t.as_py())  # DIM counts of one text at a time
                used = np.flatnonzero(found)
                at.append(used.astype("<u2").tobytes()), counts.append(found[used].astype("<u4").tobytes())
            columns = [b.column(0), b.column(2), pa.array(at, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "h", "at", "counts"])

    rows = arrow_pass(some, run, "lang string, h long, at binary, counts binary")
    w = Window.partitionBy("lang").orderBy("h", F.length("at"), F.xxhash64("at", "counts"))  # the share of a language: some thousand rows
    ranked = rows.withColumn("k", F.row_number().over(w)).withColumn("sum", F.sum(F.length("at") / 2).over(w))
    taken = ranked.where((F.col("k") == 1) | ((F.col("k") <= each) & (F.col("sum") <= entries))).orderBy("h", "lang", "k")
    return [(np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<u4"), r["lang"]) for r in taken.select("lang", "at", "counts").collect()]


class Model:
    """Languages, idf, weights (features, languages), bias and temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray) -> None:
        self.languages, self.idf = languages, idf
        self.w = np.zeros((DIM, len(languages)))
        self.bias = np.zeros(len(languages))
        self.temperature = 1.0

    def weighted(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """TF-IDF of the n-grams ``at``, of length one."""
        x = np.log1p(counts) * self.idf[at]
        return x / max(float(np.sqrt(x @ x)), 1e-12)

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.weighted(at, counts) @ self.w[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        counts = gram_counts(text)
        at = np.flatnonzero(counts)
        p = softmax(self.logits(at, counts[at]) / self.temperature)
        k = int(np.argmax(p))
        return self.languages[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(model: Model, rows: list[tuple[np.ndarray, np.ndarray, str]], alpha: float = 0.5, beta: float = 1.0, l1: float = L1, l2: float = L2, epochs: int = 4) -> None:
    """Follow the (proximally) regularised leader: accumulated gradients with elastic-net shrinkage."""
    k = len(model.languages)
    z, n = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))
    data = [(at, model.weighted(at, counts), model.languages.index(lang)) for at, counts, lang in rows]
    rng = np.random.default_rng(7)

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            at, x, y = data[i]
            at, x = np.append(at, DIM), np.append(x, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(np.arange(DIM + 1))
    model.w, model.bias = w[:DIM], w[DIM]


def fit_temperature(model: Model, rows: list[tuple[np.ndarray, np.ndarray, str]]) -> None:
    """The temperature with the least log loss on rows kept back, from a fixed grid."""
    if not rows:
        return
    z = np.stack([model.logits(at, counts) for at, counts, _ in rows])
    y = np.array([model.languages.index(lang) for _, _, lang in rows])
    grid = np.geomspace(0.02, 20, 121)
    loss = [-np.mean(np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12))) for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from columns text and lang: ``sample`` distinct texts of each language at most (see the bounds above).

    Every fifth text of a language is kept back for the temperature, its first ones never.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", F.col("lang").cast("string").alias("lang"))
    df, n = document_frequencies(usable)
    rows = learning_rows(usable, sample)
    model = Model(sorted({lang for _, _, lang in rows}), np.log((1 + n) / (1 + df)) + 1)
    if not rows:
        return model
    seen, own, kept_back = Counter(), [], []
    for row in rows:
        seen[row[2]] += 1
        (own if seen[row[2]] % 5 else kept_back).append(row)
    fit_ftrl(model, own)
    fit_temperature(model, kept_back)
    return model


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """Add lang_pred and score (calibrated probability of that language), in place of columns of these names."""
    documents = documents.drop("lang_pred", "score")
    names = documents.columns
    held = documents.sparkSession.sparkContext.broadcast(model)  # DIM weights a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for b in batches:
            found = [own.predict(t.as_py()) for t in b.column(names.index("text"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*names, "lang_pred", "score"])

    return arrow_pass(documents, run, StructType([*documents.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"


def language_of(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from rows that are not held out.

    A null doc_id is never learned from and not held out.
    """
    model = fit(documents.where(f"not ({HELD_OUT})"), sample)
    rows = documents.select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "text")
    return predict(rows, model).drop("text")


#: Documents whose language is less sure than this go.
LEAST = 0.4


def keep_known(documents: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents whose language is found with a score of at least ``least``; others (``und`` among them) go."""
    model = fit(documents.where(f"not ({HELD_OUT})"))
    return predict(documents.select(F.struct("*").alias("__row"), "text"), model).where(F.col("score") >= least).select("__row.*")
