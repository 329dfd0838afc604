"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only the document is labelled. A sentence
with features x is toxic with probability sigmoid(w.x + b), and a document is
toxic unless all its sentences are clean (noisy-or). With
``S = sum over sentences of softplus(w.x + b)`` that probability is 1 - exp(-S),
and w and b maximise the likelihood of the document labels (L2-regularised, full
batch, Adam). The sentence probabilities then locate the offending sentences.

Features of a sentence are its distinct lower-cased words and their beginnings
of 3 to 6 letters (inflected forms share them). The vocabulary are the
``vocabulary`` features whose document frequencies differ most between the
classes, by a log-likelihood ratio of ``min_ratio`` or more.

Fitting uses a bounded sample of labelled rows: about ``per_class`` documents of
each class, chosen by a hash of the text and weighted back to the class sizes.
Only that sample's selected features reach the driver. Scoring reads whole texts.

A null or empty text has no sentences and score 0. Without labels of both
classes all scores are 0. Several labels of one document count as toxic if any is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import append_columns, unit_hash

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)
MEMO = 500_000


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, lower-cased words) of every sentence that has a word."""
    for m in SENTENCE.finditer(text):
        words = WORD.findall(m.group().lower())
        if words:
            yield m.start(), m.end(), words


@dataclass
class NoisyOrModel:
    index: dict[str, int]
    weights: np.ndarray
    bias: float

    def scorer(self) -> SentenceScorer:
        return SentenceScorer(self)


class SentenceScorer:
    """Scores sentences, remembering the features of words (a bounded number of them)."""

    def __init__(self, model: NoisyOrModel):
        self.index, self.weights, self.bias = model.index, model.weights.tolist(), model.bias
        self.known: dict[str, tuple[int, ...]] = {}

    def features(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MEMO:
                self.known.clear()
            found = self.known[word] = tuple(i for f in word_features(word) if (i := self.index.get(f)) is not None)
        return found

    def logit(self, words: list[str]) -> float:
        hit: set[int] = set()
        for word in words:
            found = self.known.get(word)
            if found is None:
                found = self.features(word)
            if found:
                hit.update(found)
        return self.bias + sum(self.weights[i] for i in hit)

    def text(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and (start, end, probability) of its sentences of 0.5 or more."""
        total, offending = 0.0, []
        for start, end, words in sentences(text or ""):
            z = self.logit(words)
            total += z if z > 30 else float(np.log1p(np.exp(z))) if z > -30 else 0.0
            if z >= 0:
                offending.append((start, end, 1 / (1 + float(np.exp(-z)))))
        return -float(np.expm1(-total)), offending


def document_frequencies(sample: DataFrame) -> DataFrame:
    """(feature, pos, neg): documents of each class holding the feature, counted per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for _, _, ws in sentences(text or "") for w in ws}
                seen[toxic].update({f for w in words for f in word_features(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][n] for n in names], pa.int64()), pa.array([seen[0][n] for n in names], pa.int64())], names=["feature", "pos", "neg"])

    return sample.select("text", "toxic").mapInArrow(count, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def likelihood_ratio(pos: Column, neg: Column, n_pos: int, n_neg: int) -> Column:
    """G statistic of a feature's two document frequencies."""
    share = (pos + neg) / (n_pos + n_neg)

    def part(seen: Column, total: int) -> Column:
        term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
        return term(seen, share * total) + term(total - seen, (1 - share) * total)

    return 2 * (part(pos, n_pos) + part(neg, n_neg))


def bags(sample: DataFrame, index: dict[str, int]) -> DataFrame:
    """(toxic, weight, plain, hits): number of sentences without features, and the features of the others."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = SentenceScorer(NoisyOrModel(index, np.zeros(len(index)), 0.0))
        for batch in batches:
            plain, hits = [], []
            for text in batch.column(0).to_pylist():
                found = [sorted({i for w in ws for i in scorer.features(w)}) for _, _, ws in sentences(text or "")]
                hits.append([f for f in found if f])
                plain.append(len(found) - len(hits[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(plain, pa.int32()), pa.array(hits, pa.list_(pa.list_(pa.int32())))], names=["toxic", "weight", "plain", "hits"])

    return sample.select("text", "toxic", "weight").mapInArrow(build, "toxic int, weight double, plain int, hits array<array<int>>")


def fit(rows: list, features: int, steps: int = 400, rate: float = 0.08, l2: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and bias from bags (toxic, weight, plain, hits)."""
    y = np.array([r["toxic"] for r in rows], dtype=float)
    c = np.array([r["weight"] for r in rows], dtype=float)
    c /= c.sum()
    plain = np.array([r["plain"] for r in rows], dtype=float)
    doc = np.array([d for d, r in enumerate(rows) for _ in r["hits"]], dtype=np.int64)
    sentence = np.array([s for s, f in enumerate(f for r in rows for f in r["hits"]) for _ in f], dtype=np.int64)
    feature = np.array([i for r in rows for f in r["hits"] for i in f], dtype=np.int64)
    n = len(doc)
    theta = np.zeros(features + 1)
    theta[-1] = -5.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(sentence, theta[feature], n)
        s = plain * np.logaddexp(0, theta[-1]) + np.bincount(doc, np.logaddexp(0, z), len(rows))
        clean = np.exp(-s)
        slope = c * np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        dz = slope[doc] / (1 + np.exp(-z))
        grad = np.append(np.bincount(feature, dz[sentence], features), dz.sum() + (slope * plain).sum() / (1 + np.exp(-theta[-1])))
        grad[:-1] += l2 / max(features, 1) * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 3000, vocabulary: int = 2000, min_documents: int = 4, min_ratio: float = 15.0) -> NoisyOrModel:
    """Fit on the documents of ``df`` that ``labels`` marks; the sample's ids are few and are broadcast."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect() if r["toxic"] in (0, 1)}
    if len(sizes) < 2:
        return NoisyOrModel({}, np.zeros(0), -40.0)
    share = {k: min(1.0, per_class / n) for k, n in sizes.items()}
    rate = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    chosen = marks.where(F.col("toxic").isin(0, 1) & (unit_hash(id_col, seed=4) < rate)).withColumn("weight", 1 / rate)
    sample = df.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(chosen), id_col)
    sample = sample.select("text", "toxic", "weight")
    counted = document_frequencies(sample).where(F.col("pos") + F.col("neg") >= min_documents)
    drawn = {k: max(1, round(sizes[k] * share[k])) for k in sizes}
    g = likelihood_ratio(F.least("pos", F.lit(drawn[1])), F.least("neg", F.lit(drawn[0])), drawn[1], drawn[0])
    top = counted.withColumn("g", g).where(F.col("g") >= min_ratio).sort(F.desc("g"), "feature").limit(vocabulary).collect()
    index = {r["feature"]: i for i, r in enumerate(top)}
    weights, bias = fit(bags(sample, index).collect(), len(index))
    return NoisyOrModel(index, weights, bias)


SPOTS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
ARROW_SPOTS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def score(df: DataFrame, model: NoisyOrModel, text_col: str = "text") -> DataFrame:
    """``df`` with score (noisy-or over its sentences) and toxic_spans (character ranges of the offending sentences)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    scorers: list[SentenceScorer] = []

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not scorers:
            scorers.append(shared.value.scorer())
        out = [scorers[0].text(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
        spots = [[{"start": a, "end": b, "score": p} for a, b, p in found] for _, found in out]
        return [pa.array([p for p, _ in out], pa.float64()), pa.array(spots, ARROW_SPOTS)]

    return append_columns(df, compute, [T.StructField("score", T.DoubleType()), T.StructField("toxic_spans", SPOTS)])


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of the documents whose labels training never sees."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0
