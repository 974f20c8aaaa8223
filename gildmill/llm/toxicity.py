"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is the logistic function of the weights of the words and word stems
in it; a document
is toxic unless all its sentences are harmless (noisy-or). The weights are fitted to the
documents' labels through that combination, so they also tell which sentences offend.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildmill.llm.common import (
    hash52,
    materialize,
    ship_package,
    slices,
    strings,
    whole_text,
)

THRESHOLD = 0.7
SAMPLE = 3000  # labelled documents of either label at most that a model is fitted to
SAMPLE_BYTES = 24_000_000
LEAST_DOCUMENTS = 3  # toxic ones that a feature must occur in
LEAST_RATIO = 14.0  # log-likelihood ratio, doubled, of a word that tells toxic documents apart
VOCABULARY = 20_000  # words at most; the most telling ones
ROUNDS = 250
RIDGE = 1e-6
STEMS = (4, 5)
OFFENDING = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def features(sentence: str) -> set[str]:
    """The words of a sentence, and the beginnings of its longer words (inflected forms)."""
    words = set(_WORD.findall(sentence.lower()))
    return words.union(*[[w[:n] + "-" for w in words if len(w) > n] for n in STEMS])


@dataclass
class Model:
    weights: dict[str, float]  # features of no weight are left out
    bias: float

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """Start, end and log-odds of the sentences that hold a word."""
        weight = self.weights.get
        for m in _SENTENCE.finditer(text):
            found = features(m[0])
            if found:
                yield *m.span(), sum(weight(w, 0.0) for w in found) + self.bias

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability that the text is toxic, and its offending sentences.

        A text without words scores 0.
        """
        found = list(self.sentences(text))
        if not found:
            return 0.0, []
        z = np.array([x[2] for x in found])
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        clean = -np.logaddexp(0, np.clip(z, -60, 60)).sum()
        bad = [(s, e, float(q)) for (s, e, _), q in zip(found, p, strict=True) if q >= OFFENDING]
        return float(-np.expm1(clean)), bad


def telling_words(texts: list[str], labels: np.ndarray) -> list[str]:
    """Features that toxic documents have more often than chance explains (likelihood ratio).

    Rare words that happen to stand in a toxic document would only be learned by heart.
    """
    toxic, clean = Counter(), Counter()
    for text, y in zip(texts, labels, strict=True):
        if y:
            toxic.update(features(text))
    toxic = {w: t for w, t in toxic.items() if t >= LEAST_DOCUMENTS}
    for text, y in zip(texts, labels, strict=True):
        if not y:
            clean.update(w for w in features(text) if w in toxic)
    rate = labels.mean()
    found = []
    for w, t in toxic.items():
        n = t + clean[w]
        ratio = t * np.log(t / (n * rate))
        if t < n:
            ratio += (n - t) * np.log((n - t) / (n * (1 - rate)))
        if t > n * rate and 2 * ratio >= LEAST_RATIO:
            found.append((-2 * ratio, w))
    return [w for _, w in sorted(found)[:VOCABULARY]]


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Weighted maximum likelihood with a ridge penalty, by Adam over the whole sample."""
    index = {w: i for i, w in enumerate(telling_words(texts, labels))}
    columns, sizes, counts, kept = [], [], [], []
    for i, text in enumerate(texts):
        before = len(sizes)
        for sentence in _SENTENCE.findall(text):
            if found := features(sentence):
                own = sorted(index[w] for w in found if w in index)
                columns.extend(own)
                sizes.append(len(own))
        if len(sizes) > before:
            counts.append(len(sizes) - before)
            kept.append(i)
    if not kept or not index:
        return Model({}, -30.0)
    y, c = labels[kept].astype(float), weights[kept] / weights[kept].sum()
    columns, sizes, counts = np.array(columns, int), np.array(sizes), np.array(counts)
    row = np.repeat(np.arange(len(sizes)), sizes)
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    w, b = np.zeros(len(index)), -5.0
    m, v = np.zeros(len(index) + 1), np.zeros(len(index) + 1)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(row, w[columns], minlength=len(sizes)) + b
        z = np.clip(z, -40, 40)
        p = 1 / (1 + np.exp(-z))
        clean = -np.add.reduceat(np.logaddexp(0, z), starts)  # log of "no sentence offends"
        toxic = -np.expm1(clean)
        # d loss / d z of a sentence: p (1 - y / P(toxic))
        g = c[owner] * p * (1 - y[owner] / np.maximum(toxic[owner], 1e-12))
        grad = np.append(np.bincount(columns, g[row], minlength=len(w)) + RIDGE * w, g.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        step = 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
        w, b = w - step[:-1], b - step[-1]
    strong = np.abs(w) > 1e-3
    return Model({x: float(w[i]) for x, i in index.items() if strong[i]}, float(b))


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """Fit to a bounded sample of the documents that ``labels`` (doc_id, toxic) marks.

    The sample has at most ``sample`` documents of either label, those of the lowest id hashes;
    ``sample_bytes`` bounds the bytes brought to the driver. Within it, documents are weighed so
    that the labels keep their shares among all labelled rows. Only ids and sizes are joined
    with the labels; texts are fetched for the chosen ids alone, whose number is bounded and
    which are therefore broadcast. A null label is none; an id marked both ways is toxic; rows
    that repeat an id give one text. Without rows of both labels nothing is toxic.
    """
    marked = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id")
    marked = marked.agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sizes = docs.select(
        F.col(doc_id).alias("doc_id"), F.octet_length(whole_text(text)).alias("size")
    )
    rows = materialize(
        sizes.join(marked, "doc_id").withColumn("key", hash52(F.lit("toxicity"), F.col("doc_id"))),
        "labelled",
    )
    shares = {
        r["toxic"]: (r["n"], r["mean"])
        for r in rows.groupBy("toxic")
        .agg(F.count("*").alias("n"), F.avg("size").alias("mean"))
        .collect()
    }
    if set(shares) != {0, 1}:
        return Model({}, -30.0)
    parts = []
    for toxic in (1, 0):
        room = min(sample, max(1, int(sample_bytes / 2 / max(1.0, shares[toxic][1]))))
        chosen = rows.filter(F.col("toxic") == toxic).select("doc_id", "toxic", "key")
        parts.append(chosen.orderBy("key", "doc_id").limit(room))
    chosen = materialize(parts[0].union(parts[1]).distinct(), "sample")
    picked = (
        docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic", "key")
        .agg(F.min("text").alias("text"))
        .toPandas()
        .sort_values(["key", "doc_id"], kind="stable")
    )
    y = picked["toxic"].to_numpy()
    weight = np.array([shares[int(t)][0] / max(1, (y == t).sum()) for t in y])
    return fit(picked["text"].tolist(), y, weight)


SPAN_TYPE = "array<struct<start:long,end:long,score:double>>"


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``toxicity`` (0 to 1) and ``offending`` (spans of sentences at 0.5 or more).

    Only the text is scored. Null and empty texts, and others without words, score 0; equal texts score
    alike; input columns of these names are replaced. No shuffle; the model is bounded by its
    vocabulary and goes with the task.
    """
    spark = ship_package(docs.sparkSession)
    kept = docs.drop("toxicity", "offending")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    shared = spark.sparkContext.broadcast(model)
    span = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for whole in batches:
            for batch in slices(whole, text):
                found = [scorer.score(t) for t in strings(batch.column(text))]
                spans = [[{"start": s, "end": e, "score": q} for s, e, q in x[1]] for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array([x[0] for x in found], pa.float64()),
                        pa.array(spans, span),
                    ],
                    [*batch.schema.names, "toxicity", "offending"],
                )

    return kept.mapInArrow(run, f"{schema}, toxicity double, offending {SPAN_TYPE}")


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
