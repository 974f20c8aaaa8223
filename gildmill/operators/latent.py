"""Latent semantic vectors: an encoder that is learned from the corpus itself.

The term matrix X (documents by terms, TF-IDF, rows of length one) is factored by randomised
subspace iteration: a random orthonormal start, then a few passes Z = X'(XQ), each followed by a
new orthonormal Q; the last pass also gives the small matrix Q'X'XQ, whose eigenvectors turn Q into
the leading right singular vectors. A text's vector is its row of X times these.

Texts are read twice, for the terms' frequencies and to store X as places in the vocabulary and
counts. Each pass over X reads these numbers, every task multiplies row after row and adds up its part of Z, and parts are summed by ranges of terms. A row's
terms are distinct, so its part is one product of small dense matrices. The vocabulary is a parameter of
the model, the most frequent ``terms`` words, and bounds all that the driver and a task hold:
``terms * (dimensions + EXTRA)`` numbers, 21 MB by default, whatever the size of the corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.sources.writers import materialized

TERMS = 1 << 15
DIMENSIONS = 64
EXTRA = 16  # further columns, which make the wanted ones converge
PASSES = 4
LEAST_DOCUMENTS = 2
SEED = 7
_RANGE = 1024  # terms to a part of Z
_WORD = r"[\p{L}\p{M}\p{N}]+"
_FREQUENCY = "term string, df long"
_HELD = 1 << 18  # words that a task counts before it sends them on
_MATRIX = "places array<int>, counts array<int>"
_BEYOND = re.compile("[\ud800-\udfff\U00010000-\U0010ffff]")


@dataclass(frozen=True)
class LatentModel:
    """Terms with their weights and directions (one row of V per term), most frequent first."""

    vocabulary: list[str]
    idf: np.ndarray
    directions: np.ndarray
    singular_values: np.ndarray

    def encoder(self) -> Callable[[], Callable[[list[str]], np.ndarray]]:
        """For ``encode`` and the search of stored documents."""
        vocabulary, idf, directions = self.vocabulary, self.idf, self.directions

        def load() -> Callable[[list[str]], np.ndarray]:
            place = {t: i for i, t in enumerate(vocabulary)}

            def model(texts: list[str]) -> np.ndarray:
                out = np.zeros((len(texts), directions.shape[1]), "float32")
                for i, text in enumerate(texts):
                    at, counts = _row(text, place)
                    if len(at):
                        weight = counts * idf[at]
                        out[i] = (weight / (np.linalg.norm(weight) or 1.0)) @ directions[at]
                return out

            return model

        return load

    def write(self, spark: SparkSession, path: str) -> None:
        rows = zip(range(len(self.idf)), self.vocabulary, self.idf.tolist(), self.directions.tolist())
        shape = "place int, term string, idf double, direction array<double>"
        path = path.rstrip("/")
        spark.createDataFrame(list(rows), shape).write.mode("overwrite").parquet(f"{path}/terms")
        values = spark.createDataFrame([(self.singular_values.tolist(),)], "singular_values array<double>")
        values.write.mode("overwrite").parquet(f"{path}/values")


def read_model(spark: SparkSession, path: str) -> LatentModel:
    path = path.rstrip("/")
    rows = spark.read.parquet(f"{path}/terms").orderBy("place").collect()  # the bounded vocabulary
    values = np.array(spark.read.parquet(f"{path}/values").first()[0], "float64")
    directions = np.array([r["direction"] for r in rows], "float64").reshape(len(rows), len(values))
    return LatentModel([r["term"] for r in rows], np.array([r["idf"] for r in rows]), directions, values)


def words_of(text: str) -> list[str]:
    """The words of ``terms_of`` for a text in a task."""
    import regex

    lowered = text.lower()
    if _BEYOND.search(lowered):
        return regex.findall(_WORD, lowered)
    return _basic_words().findall(lowered)


@cache
def _basic_words() -> re.Pattern:
    """``_WORD`` for the basic plane, of which ``re`` makes one lookup table."""
    import regex

    plane = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x10000))))
    found = (m.span() for m in regex.finditer(_WORD, plane[:0xD800]))
    above = (m.span() for m in regex.finditer(_WORD, plane[0xD800:]))
    runs = [*found, *((a + 0xE000, b + 0xE000) for a, b in above)]
    return re.compile("[" + "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in runs) + "]+")


def fit_latent(
    df: DataFrame,
    text_col: str,
    dimensions: int = DIMENSIONS,
    terms: int = TERMS,
    passes: int = PASSES,
    seed: int = SEED,
) -> LatentModel:
    """Learn the encoder from all texts of ``df``; null texts are left out.

    Words in fewer than two documents are no features. There are fewer dimensions where the
    vocabulary has fewer terms; without any, vectors have none.
    """
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
    frequency = texts.mapInArrow(_count_documents, _FREQUENCY).groupBy("term").agg(F.sum("df").alias("df"))
    frequency = frequency.where(F.col("term").isNull() | (F.col("df") >= LEAST_DOCUMENTS))
    known = frequency.orderBy(F.desc("df"), F.asc_nulls_first("term")).limit(terms + 1).toArrow()
    if not len(known):
        return LatentModel([], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    # no term is in more documents than there are, so their number comes first
    n, vocabulary = known["df"][0].as_py(), known["term"].to_pylist()[1:]
    df_of = known["df"].to_numpy()[1:]
    idf = np.log((n + 1.0) / (df_of + 1.0))
    width = min(dimensions + EXTRA, len(vocabulary))
    if not width:
        return LatentModel([], idf, np.zeros((0, 0)), np.zeros(0))

    z = np.random.default_rng(seed).standard_normal((len(vocabulary), width))
    with materialized(_looked_up(texts, vocabulary), "term-matrix") as matrix:
        for _ in range(passes):
            q = np.linalg.qr(z)[0]
            z = _gram_product(matrix, idf, q)
    values, vectors = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
    leading = np.argsort(-values)[: min(dimensions, width)]
    return LatentModel(vocabulary, idf, q @ vectors[:, leading], np.sqrt(np.maximum(values[leading], 0.0)))


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each word is; under null, the number of texts."""
    documents: Counter[str | None] = Counter()

    def counted() -> pa.RecordBatch:
        columns = [pa.array(documents.keys(), pa.string()), pa.array(documents.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["term", "df"])

    for batch in batches:
        for text in batch.column("text"):
            documents.update({None, *words_of(text.as_py())})
            if len(documents) >= _HELD:
                yield counted()
                documents.clear()
    if documents:
        yield counted()


def _row(text: str, place: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of a text's known words, in order: equal counts give equal vectors."""
    found = [p for p in map(place.get, words_of(text)) if p is not None]
    at = np.array(found, np.int64)
    at.sort()
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
    return at[first], np.diff(np.append(first, len(at)))


def _looked_up(texts: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Places and counts of the known terms of every text that has any."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            rows = [_row(text.as_py(), place) for text in batch.column("text")]
            rows = [(at, counts) for at, counts in rows if len(at)]
            if rows:
                bounds = pa.array(np.cumsum([0, *(len(at) for at, _ in rows)]), pa.int32())
                lists = (pa.array(np.concatenate(x), pa.int32()) for x in zip(*rows, strict=True))
                arrays = [pa.ListArray.from_arrays(bounds, x) for x in lists]
                yield pa.RecordBatch.from_arrays(arrays, ["places", "counts"])

    return texts.mapInArrow(look_up, _MATRIX)


def _add_products(z: np.ndarray, q: np.ndarray, idf: np.ndarray, batch: pa.RecordBatch) -> None:
    """z += X'(Xq) for the documents of one batch."""
    places, counts = batch.column("places"), batch.column("counts")
    place = pc.list_flatten(places).to_numpy(zero_copy_only=False)
    weight = pc.list_flatten(counts).to_numpy(zero_copy_only=False) * idf[place]
    ends = np.cumsum(pc.list_value_length(places).to_numpy(zero_copy_only=False)).tolist()
    for start, end in zip([0, *ends], ends):
        at, row = place[start:end], weight[start:end]
        square = row @ row
        if square > 0:
            z[at] += np.multiply.outer(row / square, row @ q.take(at, axis=0))


def _gram_product(matrix: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """X'(Xq), summed over all tasks by ranges of terms."""
    spark = matrix.sparkSession
    shared = spark.sparkContext.broadcast((idf, q))
    shape = "part int, data binary"

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, basis = shared.value
        z = np.zeros_like(basis)
        for batch in batches:
            _add_products(z, basis, weights, batch)
        for part in range(0, len(z), _RANGE):
            data = z[part : part + _RANGE]
            if data.any():
                yield pa.RecordBatch.from_pylist([{"part": part, "data": data.tobytes()}], _PARTS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                values = np.frombuffer(data, "float64")
                sums[part] = sums[part] + values if part in sums else values
        for part, data in sums.items():
            yield pa.RecordBatch.from_pylist([{"part": part, "data": data.tobytes()}], _PARTS)

    parts = matrix.mapInArrow(multiply, shape).repartition("part").mapInArrow(add, shape).collect()
    z = np.zeros_like(q)
    for row in parts:  # terms / _RANGE rows
        data = np.frombuffer(row["data"], "float64").reshape(-1, q.shape[1])
        z[row["part"] : row["part"] + len(data)] = data
    shared.destroy()
    return z


_PARTS = pa.schema([("part", pa.int32()), ("data", pa.binary())])
