"""The pipeline on the smallest tables, stage by stage, and queries against their SQL."""

from __future__ import annotations

import hashlib
from collections import Counter

import duckdb
import pytest
from conftest import TESTDATA

import corpus_pipeline
from gildmill.llm.common import materialize
from gildmill.llm.queries import ORACLES, QUERIES
from tests.llm import helpers
from tests.llm.test_operators_small import check_packing, plain_classes, plain_repeats, rows_of

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_stages_keep_the_columns_and_take_effect(spark, tables):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, FOLDER), name)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    toxic = {i for (i,) in tables.execute("SELECT doc_id FROM labels WHERE toxic = 1").fetchall()}
    harmless = {i for (i,) in tables.execute("SELECT doc_id FROM labels WHERE toxic = 0").fetchall()}
    gone = {r["doc_id"] for r in rows_of(seen["toxicity"][0])} - {r["doc_id"] for r in rows_of(seen["toxicity"][1])}
    assert not gone & harmless and gone <= toxic | (gone - harmless)  # few labels: see below
    given = [(r["doc_id"], r["text"]) for r in rows_of(seen["near_dedup"][0])]
    kept = sorted(r["doc_id"] for r in rows_of(seen["near_dedup"][1]))
    assert kept == sorted({c for _, c in plain_classes(given)})
    scanned = rows_of(seen["secret_scan"][1])
    assert len(scanned) == len(kept) and all(r["n_chars"] == len(r["text"] or "") for r in scanned)
    mixed = rows_of(seen["poisson_mix"][1])
    assert {r["doc_id"] for r in mixed} <= set(kept)
    check_packing([(r["doc_id"], r["text"]) for r in mixed], rows_of(docs))


def test_run_equals_its_stages(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_stages_take_odd_rows(spark):
    for rows in (helpers.odd_rows(), []):
        docs = helpers.docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, FOLDER))


def test_every_query_returns_a_row_per_input_row(spark, tables):
    counts = {t: tables.execute(f"SELECT count(*) FROM {t}").fetchone()[0] for t in ("documents", "pages", "embeddings")}
    of = {"op5_pq_dedup": "embeddings", "op6_warc_index": "pages"}
    for name, query in QUERIES.items():
        if name not in ("op2_poisson_mix", "op10_packing"):
            assert query(spark, FOLDER).count() == counts[of.get(name, "documents")], name


def test_mixing_equals_its_sql(spark, tables):
    got = QUERIES["op2_poisson_mix"](spark, FOLDER)
    want = tables.execute(ORACLES["op2_poisson_mix"])
    names = [d[0] for d in want.description]
    assert Counter(tuple(r[n] for n in names) for r in rows_of(got)) == Counter(want.fetchall())


def test_repeats_of_a_whole_table(spark, tables):
    docs = tables.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    texts = [t.encode() for _, t in docs]
    want = {}
    for (i, _), t, cover in zip(docs, texts, plain_repeats(texts), strict=True):
        kept = bytes(c for c, x in zip(t, cover, strict=True) if not x)
        want[i] = (sum(cover), hashlib.sha256(kept).hexdigest())
    got = rows_of(QUERIES["op3_suffix_dedup"](spark, FOLDER))
    assert {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in got} == want


def test_held_out_toxicity(spark):
    folder = f"{TESTDATA}/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = rows_of(QUERIES["op4_toxicity"](spark, folder).join(labels, "doc_id").filter("held_out"))
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    wins = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean)
    assert wins / (len(toxic) * len(clean)) > 0.9
    assert sum(t >= 0.7 for t in toxic) > 0.6 * len(toxic) and max(clean) < 0.7
