"""The stored term index: pruned reads, exact ranks, hot terms."""

from __future__ import annotations

import contextlib
import io
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gildmill.operators import term_index


def rows_of(seed, n=400):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(r.choices(vocabulary, weights, k=r.randint(1, 40))), i % 3) for i in range(n)]
    return rows + [(n, rows[5][1], 2), (n + 1, "", 0), (n + 2, None, 1), (n + 3, "W1 w1, W2!", 2)]


def brute(rows, query, k, keep=lambda row: True):
    bags = {i: Counter(t.lower().replace(",", " ").replace("!", " ").split()) for i, t, _ in rows if t is not None}
    n = len(bags)
    df = Counter(t for bag in bags.values() for t in bag)
    idf = {t: math.log((n + 1) / (c + 1)) for t, c in df.items()}
    q = {t: c * idf.get(t, math.log(n + 1)) for t, c in Counter(query.split()).items()}
    q_norm = math.sqrt(sum(v * v for v in q.values()))
    scores = []
    for row in rows:
        if row[0] in bags and keep(row):
            w = {t: c * idf[t] for t, c in bags[row[0]].items()}
            norm = math.sqrt(sum(v * v for v in w.values()))
            dot = sum(w[t] * q[t] for t in w if t in q)
            scores.append((-round(dot / norm / q_norm if norm else 0.0, 9), row[0]))
    return [(i, -s) for s, i in sorted(scores)[:k]]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = rows_of(1)
    df = spark.createDataFrame(rows, "id long, t string, g int").repartition(4).cache()
    path = str(tmp_path_factory.mktemp("index"))
    return rows, df, term_index.index_terms(df, "t", "id", path, bucket_postings=200), path


@pytest.mark.parametrize(
    ("query", "k", "group"),
    [("w1", 7, None), ("w0 w1 w2", 1, 1), ("w250 w3 w3 w0", 7, None), ("w299 w298 w297 w1", 500, 2),
     ("nowhere w7", 7, 1), ("w0", 500, None)],
)
def test_ranks_equal_brute_force(stored, query, k, group):
    rows, df, index, _ = stored
    where = None if group is None else F.col("g") == group
    got = [(r["id"], r["score"]) for r in term_index.search_terms(index, df, query, k, where).orderBy("rank").collect()]
    want = brute(rows, query, k, lambda row: group is None or row[2] == group)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=2e-9)


def test_more_candidates_than_literals(stored, monkeypatch):
    monkeypatch.setattr(term_index, "LITERAL_IDS", 3)
    rows, df, index, _ = stored
    got = term_index.search_terms(index, df, "w0 w1 w40", 9).orderBy("rank").collect()
    assert [r["id"] for r in got] == [i for i, _ in brute(rows, "w0 w1 w40", 9)]


def test_no_cheap_level(stored, monkeypatch):
    """Without a threshold every level is read."""
    monkeypatch.setattr(term_index, "CHEAP_LEVEL", 0)
    rows, df, index, _ = stored
    got = term_index.search_terms(index, df, "w0 w1 w40", 9).orderBy("rank").collect()
    assert [r["id"] for r in got] == [i for i, _ in brute(rows, "w0 w1 w40", 9)]


def explained(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_terms_reach_the_scan_and_other_buckets_are_not_read(spark, stored):
    _, _, index, path = stored
    read = term_index.read_index(spark, path, "id")
    assert (read.documents, read.buckets) == (index.documents, index.buckets) and index.buckets > 8
    terms, _ = term_index._query_terms(read, "w250 w3")
    for t in terms:
        t.depth = len(t.levels)
    hits = term_index._read_levels(read, terms)
    assert "PushedFilters: [In(term, [w250,w3])" in explained(hits)
    files = hits.inputFiles()
    assert files and {f.split("bucket=")[1].split("/")[0] for f in files} <= {str(t.bucket) for t in terms}
    every = read.read("postings").inputFiles()
    assert len(files) < len(every)


def test_files_read_do_not_grow_with_the_corpus(spark, tmp_path):
    counts = []
    for n in (300, 3000):
        df = spark.createDataFrame(rows_of(n, n), "id long, t string, g int").repartition(4)
        index = term_index.index_terms(df, "t", "id", str(tmp_path / str(n)), bucket_postings=400)
        terms, _ = term_index._query_terms(index, "w250 w251")
        assert len(terms) == 2
        for t in terms:
            t.depth = len(t.levels)
        hits = term_index._read_levels(index, terms)
        rows = index.read("postings", [t.bucket for t in terms]).count()
        counts.append((len(hits.inputFiles()), rows))
    assert counts[1][0] <= counts[0][0] + 2
    assert counts[1][1] < 5 * counts[0][1]  # ten times the rows


def test_levels_hold_every_posting_and_fall_in_impact(stored):
    rows, _, index, _ = stored
    postings = Counter(r["term"] for r in index.read("postings").collect())
    tops = {}
    for r in index.read("terms").collect():
        assert sum(x["n"] for x in r["levels"]) == postings.get(r["term"], 0)
        levels = [x["top"] for x in r["levels"]]
        assert levels == sorted(levels, reverse=True)
        tops[r["term"]] = levels
    hits = index.read("postings").groupBy("term").agg(F.max("impact").alias("m")).collect()
    assert all(tops[r["term"]][0] == r["m"] for r in hits)


def test_an_early_stop_reads_less(stored):
    """A rare term decides: the common term's levels stay unread."""
    _, _, index, _ = stored
    terms, length = term_index._query_terms(index, "w290 w0")
    rare, common = sorted(terms, key=lambda t: sum(x["n"] for x in t.levels))
    assert common.weight < rare.weight
    term_index._deepen_to(terms, common.bound() * 1.5)
    assert common.depth < len(common.levels)


def test_string_ids(spark, tmp_path):
    df = spark.createDataFrame([("a", "space robots"), ("b", "river"), ("c'\"", "robots robots")], "id string, t string")
    index = term_index.index_terms(df, "t", "id", str(tmp_path))
    got = term_index.search_terms(index, df, "robots", 3).orderBy("rank").collect()
    assert [r["id"] for r in got] == ["c'\"", "a", "b"]
