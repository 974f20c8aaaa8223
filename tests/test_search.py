"""Similarity search against brute force."""

from __future__ import annotations

import math
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import TESTDATA
from plans import plan_of
from pyspark.sql import functions as F

from gildmill.operators import encode, search, term_index


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]  # copies tie with row 5
    rows += [(2000, None), (2001, [1.0] * 15), (2002, [0.0] * 16), (2003, [float("nan")] * 16)]
    rows += [(2004, [None] + [1.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<float>").repartition(6)
    return rows, df.cache()


def brute(rows, query, k):
    q = np.asarray(query, "float32").astype("float64")
    scored = []
    for i, v in rows:
        if v is None or len(v) != len(q) or any(x is None for x in v):
            continue
        m = np.asarray(v, "float32").astype("float64")
        n = np.linalg.norm(m)
        if not np.isfinite(n) or n == 0:
            continue
        scored.append((-round(float(m @ q / n / np.linalg.norm(q)), 9), i))
    return [i for _, i in sorted(scored)[:k]]


@pytest.mark.parametrize("native", [False, True])
def test_nearest(vectors, native):
    rows, df = vectors
    for q in (rows[5][1], rows[77][1]):
        hits = search.nearest(df, "vec_id", "v", q, 10, native=native).orderBy("rank").collect()
        assert [h["vec_id"] for h in hits] == brute(rows, q, 10)
        assert [h["rank"] for h in hits] == list(range(1, 11))
    everything = search.nearest(df, "vec_id", "v", rows[0][1], 10_000, native=native)
    assert everything.count() == 340
    none = search.nearest(df, "vec_id", "v", rows[0][1], 5, F.col("vec_id") < 0, native=native)
    assert none.count() == 0 and "score" in none.columns
    with pytest.raises(ValueError):
        search.nearest(df, "vec_id", "v", [0.0] * 16, native=native)


@pytest.mark.parametrize("blocks", [{}, {"query_block_bytes": 700}, {"query_block_bytes": 150}])
def test_nearest_batch(spark, vectors, blocks):
    """The copies of one vector outnumber k and still tie by id, in one block or in many."""
    rows, df = vectors
    asked = [rows[i] for i in (0, 5, 9, 44, 120)] + [(-1, None)]
    queries = spark.createDataFrame(asked, "qid bigint, q array<float>")
    got = search.nearest_batch(df, queries, "vec_id", "v", "qid", "q", 7, **blocks)
    assert "Cartesian" not in plan_of(got) and "NestedLoop" not in plan_of(got)
    found: dict[int, list] = {}
    for r in got.orderBy("qid", "rank").collect():
        found.setdefault(r["qid"], []).append(r["vec_id"])
    assert found == {i: brute(rows, v, 7) for i, v in asked if v is not None}


def tokens(text):
    return [t for t in re.split(r"[\W_]+", text.lower()) if t]


def test_tfidf_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    n = len(rows)
    df = Counter(t for _, x in rows for t in set(tokens(x)))
    idf = {t: math.log((n + 1) / (c + 1)) for t, c in df.items()}

    def weights(x):
        return {t: c * idf.get(t, math.log(n + 1)) for t, c in Counter(tokens(x)).items()}

    def unit(w):
        norm = math.sqrt(sum(v * v for v in w.values()))
        return {t: v / norm for t, v in w.items()} if norm else {}

    query = rows[3][1]  # a long query: no token is cut off
    q = unit(weights(query))
    want = {i: sum(v * q.get(t, 0.0) for t, v in unit(weights(x)).items()) for i, x in rows}

    index = term_index.index_terms(docs, "text", "doc_id", str(tmp_path))
    for read in (index, term_index.read_index(spark, str(tmp_path), "doc_id")):
        got = term_index.search_terms(read, docs, query, 20).orderBy("rank").collect()
        best = sorted((-round(v, 9), i) for i, v in want.items())[:20]
        assert [r["doc_id"] for r in got] == [i for _, i in best]
        assert [r["score"] for r in got] == pytest.approx([-v for v, _ in best], abs=1e-8)


def test_tfidf_edges(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "space robots fight"), (2, "quiet river town"), (3, None), (4, "")], "id int, t string"
    )
    index = term_index.index_terms(docs, "t", "id", str(tmp_path / "a"))
    hits = term_index.search_terms(index, docs, "Robots!", 5).orderBy("rank").collect()
    assert hits[0]["id"] == 1 and hits[0]["score"] > 0
    assert [(r["id"], r["score"]) for r in hits[1:]] == [(2, 0.0), (4, 0.0)]
    only = term_index.search_terms(index, docs, "robots", 5, F.col("id") == 2).collect()
    assert [r["id"] for r in only] == [2]
    for blank in ("", "   ", None):
        with pytest.raises(ValueError):
            term_index.search_terms(index, docs, blank)
    assert term_index.search_terms(index, docs, "?!").count() == 0
    unknown = term_index.search_terms(index, docs, "zeppelin", 5).collect()
    assert {r["score"] for r in unknown} == {0.0}
    empty = term_index.index_terms(docs.limit(0), "t", "id", str(tmp_path / "b"))
    assert term_index.search_terms(empty, docs.limit(0), "robots").count() == 0


def test_batch_search_of_wide_vectors_is_quick():
    """10,000 rows of 512 numbers against 512 queries: the bound leaves room for a slow box."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(10_000, 512))
    ids = pa.array(np.arange(10_000))
    vectors = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), 512).cast(
        pa.list_(pa.float64())
    )
    unit = rows[:512] / np.linalg.norm(rows[:512], axis=1)[:, None]
    schema = pa.schema([("q", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    best = search._BestRows(ids[:512], unit, 10, schema)
    start = time.perf_counter()
    best.add(ids, vectors)
    assert time.perf_counter() - start < 2.0
    got = pa.Table.from_batches(best.batches())
    assert got.num_rows == 5120
    first = got["id"].to_numpy()[::10]
    assert (first == np.arange(512)).all()


def test_pluggable_encoder(spark):
    def load():
        return lambda texts: np.array([[len(t), 1] for t in texts])

    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "id int, t string").repartition(2)
    got = {r["id"]: r[encode.VECTOR_COLUMN] for r in encode.encode(df, "t", load).collect()}
    assert got == {1: [3.0, 1.0], 2: None, 3: [0.0, 1.0]}


def test_result_cards(spark):
    hits = spark.createDataFrame(
        [
            (1, "I, Robot", "2004-07-15", "A  cop.", "", "Alex", list("abcdef"), 3.344, 57),
            (2, None, None, None, None, None, None, None, 0),
        ],
        "rank int, title string, release_date string, overview string, tagline string, director string, "
        "top_cast array<string>, avg_rating double, rating_count bigint",
    )
    cards = [tuple(r) for r in search.result_cards(hits).orderBy("rank").collect()]
    assert cards == [
        (1, "I, Robot", "2004-07-15", "Alex", "a, b, c, d, e", "3.34 (57 ratings)", "A cop."),
        (2, "Unknown title", "Unknown date", "Unknown director", None, None, "(no overview available)"),
    ]
