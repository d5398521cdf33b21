"""Language identification: TF-IDF character n-grams, sparse multinomial logistic regression, temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattgrade.llm.common import hash60

UNDECIDED = "und"


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the texts of each language that the weights are fitted on; all else covers all rows."""

    buckets: int = 1 << 14
    sizes: tuple[int, ...] = (1, 2, 3)
    sample: int = 1000
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 1e-3


_is_letter: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter, for all code points; made once in each Python worker."""
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _is_letter[0]


def ngram_counts(text: str | None, settings: Settings) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text, or None without a letter.

    Lower case; every run of other characters than letters counts as one space, so words keep their ends.
    """
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    real = letters()[points]
    if not real.any():
        return None
    keep = real.copy()
    keep[0] = True
    keep[1:] |= real[:-1]  # the first of a run of other characters stays, as a space
    x = np.where(real, points, np.uint32(32))[keep].astype(np.uint64)
    x = np.concatenate([[np.uint64(32)], x, [np.uint64(32)]])
    counts = np.zeros(settings.buckets, np.int64)
    rolling = np.zeros(len(x), np.uint64)
    shift = np.uint64(64 - (settings.buckets.bit_length() - 1))
    with np.errstate(over="ignore"):
        for n in range(1, max(settings.sizes) + 1):
            if len(x) < n:
                break
            rolling = rolling[: len(x) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + x[n - 1 :] + np.uint64(n)
            if n in settings.sizes:
                mixed = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
                counts += np.bincount((mixed >> shift).astype(np.int64), minlength=settings.buckets)
    return counts


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of the unit vector of log frequencies times inverse document frequencies."""
    at = np.flatnonzero(counts)
    value = (1.0 + np.log(counts[at])) * idf[at]
    return at, value / np.sqrt(value @ value)


def document_frequencies(docs: DataFrame, text: str, settings: Settings) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed n-gram, and all with a letter. One bucket table reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(settings.buckets + 1, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts = ngram_counts(value.as_py(), settings)
                if counts is not None:
                    found[:-1] += counts > 0
                    found[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)], ["at", "n"])

    sums = docs.select(text).mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(settings.buckets + 1, np.int64)
    for at, n in sums:
        table[at] = n
    return table[:-1], int(table[-1])


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, settings: Settings, seed: int = 7
) -> np.ndarray:
    """Weights (classes x buckets + 1 for the bias) by FTRL-proximal with elastic-net penalties.

    Each step sets the weights it needs from the sums of gradients: zero within the L1 penalty, else shrunk by L2 and
    by the adaptive rate of their bucket.
    """
    width = settings.buckets + 1
    z, n = np.zeros((classes, width)), np.zeros((classes, width))
    order = np.random.default_rng(seed)

    def weights(at: np.ndarray) -> np.ndarray:
        zi, ni = z[:, at], n[:, at]
        step = (settings.beta + np.sqrt(ni)) / settings.alpha + settings.l2
        return np.where(np.abs(zi) <= settings.l1, 0.0, -(zi - np.sign(zi) * settings.l1) / step)

    for _ in range(settings.epochs):
        for r in order.permutation(len(rows)):
            at, value, label = rows[r]
            at, value = np.append(at, width - 1), np.append(value, 1.0)
            w = weights(at)
            score = w @ value
            p = np.exp(score - score.max())
            p /= p.sum()
            p[label] -= 1.0
            gradient = p[:, None] * value[None, :]
            squared = gradient * gradient
            sigma = (np.sqrt(n[:, at] + squared) - np.sqrt(n[:, at])) / settings.alpha
            z[:, at] += gradient - sigma * w
            n[:, at] += squared
    return weights(np.arange(width))


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the smallest negative log likelihood."""

    def loss(t: float) -> float:
        s = scores / t
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels]))

    grid = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
    return float(min(grid, key=loss)) if len(labels) else 1.0


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    settings: Settings

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text, self.settings) if self.languages else None
        if counts is None:
            return UNDECIDED, 0.0
        at, value = tf_idf(counts, self.idf)
        score = (self.weights[:, at] @ value + self.weights[:, -1]) / self.temperature
        p = np.exp(score - score.max())
        best = int(np.argmax(p))  # ties go to the first language in alphabetical order
        return self.languages[best], float(p[best] / p.sum())


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings | None = None
) -> Model:
    """A model of the languages of ``docs`` with a text, a letter and a language.

    Document frequencies count every row. The weights are fitted in one task on a sample of about ``settings.sample``
    texts of each language, drawn by the hash of id and text; a fifth of them is kept for the temperature. Without
    such rows the model has no language, and every prediction is undecided.
    """
    settings = settings or Settings()
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    known = known.where("lang is not null and text is not null")
    counts = known.groupBy("lang").count()
    languages = tuple(sorted(r["lang"] for r in counts.collect()))  # as many rows as languages
    frequencies, total = document_frequencies(known, "text", settings)
    idf = np.log((1.0 + total) / (1.0 + frequencies)) + 1.0
    draw = hash60(F.concat_ws(":", F.col("doc_id").cast("string"), F.md5("text"))) / float(1 << 60)
    # The counts have a row per language.
    drawn = known.withColumn("draw", draw).join(F.broadcast(counts), "lang")
    drawn = drawn.where(F.col("draw") * F.col("count") < settings.sample).select(F.lit(0).alias("all"), "draw", "text", "lang")

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["draw", "lang", "text"])
        number = {name: i for i, name in enumerate(languages)}
        rows = []
        for body, name in zip(frame["text"], frame["lang"], strict=True):
            found = ngram_counts(body, settings)
            if found is not None:
                rows.append((*tf_idf(found, idf), number[name]))
        kept, spare = [r for i, r in enumerate(rows) if i % 5], rows[::5]
        weights = follow_the_leader(kept or rows, len(languages), settings)
        scores = np.array([weights[:, a] @ v + weights[:, -1] for a, v, _ in spare]).reshape(len(spare), len(languages))
        heat = temperature(scores, np.array([y for *_, y in spare], dtype=int))
        return pd.DataFrame({"weights": [weights.astype(np.float64).tobytes()], "temperature": [heat]})

    fitted = drawn.groupBy("all").applyInPandas(train, "weights binary, temperature double").first()
    if fitted is None:
        return Model((), idf, np.zeros((0, settings.buckets + 1)), 1.0, settings)
    weights = np.frombuffer(fitted["weights"]).reshape(len(languages), settings.buckets + 1)
    return Model(languages, idf, weights, fitted["temperature"], settings)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (the calibrated probability of the language).

    Null texts and texts without a letter are ``und`` with score 0. Repeated rows repeat; an empty table gives an
    empty table. Whole texts are read, whatever their length.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def learnable(doc_id: Column, parts: int, part: int) -> Column:
    """Rows to learn from: all but the held-out part; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts != part, F.lit(True))
