"""The learned encoder against NumPy's factors, and as an encoder of stored documents."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from gildmill.operators import encode, latent, search
from gildmill.operators.term_index import terms_of


def dense_matrix(texts, vocabulary):
    bags = [Counter(latent.words_of(t)) for t in texts]
    df = Counter(t for bag in bags for t in bag)
    place = {t: i for i, t in enumerate(vocabulary)}
    x = np.zeros((len(texts), len(vocabulary)))
    for i, bag in enumerate(bags):
        for t, c in bag.items():
            if t in place:
                x[i, place[t]] = c * math.log((len(texts) + 1) / (df[t] + 1))
        norm = np.linalg.norm(x[i])
        x[i] /= norm or 1.0
    return x


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    model = latent.fit_latent(docs, "text", dimensions=12, terms=3000, passes=8)
    return docs, model


def test_singular_values_agree_with_numpy(fitted):
    docs, model = fitted
    texts = [r["text"] for r in docs.collect() if r["text"] is not None]
    assert len(model.vocabulary) == 3000
    x = dense_matrix(texts, model.vocabulary)
    values = np.linalg.svd(x, compute_uv=False)[:12]
    assert model.singular_values == pytest.approx(values, rel=0.01)
    v = model.directions
    assert v.T @ v == pytest.approx(np.eye(12), abs=1e-8)
    # The subspace carries as much of the matrix as the best one.
    assert np.linalg.norm(x @ v) == pytest.approx(np.linalg.norm(values), rel=0.01)


def test_vectors_are_rows_times_directions(fitted):
    docs, model = fitted
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(40).collect()]
    everything = [r["text"] for r in docs.collect() if r["text"] is not None]
    x = dense_matrix(everything, model.vocabulary)
    at = [everything.index(t) for t in texts]
    got = model.encoder()()(texts)
    assert got == pytest.approx(x[at] @ model.directions, abs=1e-5)
    assert not model.encoder()()(["", "zzzzqqq"]).any()


def test_the_vocabulary_is_the_most_frequent_terms(spark, fitted):
    docs, model = fitted
    counts = docs.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("t")).groupBy("t").count()
    df = {r["t"]: r["count"] for r in counts.collect()}
    want = sorted((t for t in df if df[t] > 1), key=lambda t: (-df[t], t))[:3000]
    assert model.vocabulary == want


def test_write_and_read(spark, fitted, tmp_path):
    _, model = fitted
    model.write(spark, str(tmp_path))
    again = latent.read_model(spark, str(tmp_path))
    assert again.vocabulary == model.vocabulary
    for a, b in ((again.idf, model.idf), (again.directions, model.directions), (again.singular_values, model.singular_values)):
        assert np.array_equal(a, b)


def test_related_texts_without_common_words_meet(spark):
    """Two words that share their neighbours lie in one direction."""
    sea = ["ship sea water", "boat sea water", "ship sea wave", "boat sea wave", "boat water wave", "ship water wave"]
    sky = ["plane sky cloud", "kite sky cloud", "plane sky wind", "kite cloud wind", "plane cloud wind", "kite sky wind"]
    rows = [(i, t) for i, t in enumerate((sea + sky) * 3)]
    df = spark.createDataFrame(rows, "id long, t string")
    model = latent.fit_latent(df, "t", dimensions=2)
    load = model.encoder()
    stored = encode.encode(spark.createDataFrame([(1, "ship"), (2, "kite"), (3, "plane"), (4, None)], "id long, t string"), "t", load)
    asked = load()(["boat"])[0]
    hits = search.nearest(stored, "id", encode.VECTOR_COLUMN, asked, 3).orderBy("rank").collect()
    assert hits[0]["id"] == 1 and hits[0]["score"] > 0.9 and hits[1]["score"] < 0.5


def test_nothing_to_learn(spark):
    for rows in ([], [(1, None)], [(1, "alone")]):
        model = latent.fit_latent(spark.createDataFrame(rows, "id long, t string"), "t")
        assert model.vocabulary == [] and model.encoder()()(["x"]).shape == (1, 0)


def test_passes_read_places_not_terms(spark, monkeypatch):
    """Terms are looked up once: what every pass reads has no strings, and rows of X times X' agree."""
    read = []
    product = latent._gram_product

    def spied(matrix, idf, q):
        read.append(matrix.dtypes)
        z = product(matrix, idf, q)
        rows = [(np.array(r["places"]), np.array(r["counts"])) for r in matrix.collect()]
        x = np.zeros((len(rows), len(idf)))
        for i, (places, counts) in enumerate(rows):
            assert (np.diff(places) > 0).all()
            x[i, places] = counts * idf[places]
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        assert z == pytest.approx(x.T @ (x @ q), abs=1e-12)
        return z

    monkeypatch.setattr(latent, "_gram_product", spied)
    rows = [(1, "b a b"), (2, "c a"), (3, None), (4, "b c c c"), (5, "d"), (6, ""), (7, "A b, B")]
    model = latent.fit_latent(spark.createDataFrame(rows, "id long, t string"), "t", passes=2)
    assert model.vocabulary == ["a", "b", "c"]
    assert model.idf == pytest.approx([math.log(7 / 4), math.log(7 / 4), math.log(7 / 3)])
    assert read == [[("places", "array<int>"), ("counts", "array<int>")]] * 2


def test_words_are_counted_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(latent, "_HELD", 3)
    batch = latent.pa.record_batch({"text": ["a b", "b c c", "b"]})
    parts = [b.to_pydict() for b in latent._count_documents(iter([batch]))]
    total = Counter()
    for part in parts:
        total.update(dict(zip(part["term"], part["df"])))
    assert len(parts) > 1 and total == {None: 3, "a": 1, "b": 3, "c": 1}


@pytest.mark.parametrize("text", ["Año 1½_x", "éa‍b", "ΟΔΟΣ İx", "a\U0001d400b \U0001f600 \U00010330c", "a￿b"])
def test_words_equal_the_class_of_the_index(text):
    regex = pytest.importorskip("regex")
    assert latent.words_of(text) == [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", text.lower()) if w]
