"""Odd inputs on which the corpus operators once broke."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gildmill.llm import packing, poisson_mix, slot_shards, suffix_dedup, warc_index
from gildmill.llm.common import scratch_path
from tests.llm.helpers import docs, words


@pytest.mark.parametrize("step", [2, 3, 4096])
def test_copies_are_made_a_block_at_a_time(spark, step):
    top = min(step**3, 70)
    df = spark.createDataFrame([(n, f"t{n}") for n in range(1, top + 1)], "n long, t string")
    got = Counter((r["n"], r["c"]) for r in poisson_mix.exploded(df, "n", "c", step).collect())
    assert got == {(n, c): 1 for n in range(1, top + 1) for c in range(1, n + 1)}


def test_a_rate_of_millions(spark):
    df = spark.createDataFrame([(20_000_000,)], "n long")
    got = poisson_mix.exploded(df, "n", "c").agg(F.count("*"), F.sum("c"), F.max("c")).first()
    assert tuple(got) == (20_000_000, 20_000_000 * 20_000_001 // 2, 20_000_000)
    longest = poisson_mix.exploded(df, "n", "c")
    assert "sequence(1, n" not in longest._jdf.queryExecution().optimizedPlan().toString()


def test_a_small_source_beside_a_large_one(spark):
    rows = [(i, "x" * 999, "en", "large", 1) for i in range(3000)] + [(9999, "y", "en", "small", 1)]
    got = poisson_mix.poisson_mix(docs(spark, rows)).groupBy("source").agg(F.count("*").alias("n")).collect()
    n = {r["source"]: r["n"] for r in got}
    assert abs(n["small"] * 2 - 1_500_000) < 12 * 1500 and abs(n["large"] - 1500) < 300


@pytest.mark.parametrize("kind", ["null ids", "one row repeated", "one id"])
def test_shards_stay_even(spark, kind):
    n = 20_000
    odd = {
        "null ids": lambda i: (None if i % 2 else i, f"text {i}"),
        "one row repeated": lambda i: (i, f"text {i}") if i % 3 else (7, "the same text again"),
        "one id": lambda i: (i if i % 2 else 7, f"text {i}"),
    }[kind]
    table = spark.createDataFrame([odd(i) for i in range(n)], "doc_id long, text string").repartition(6)
    table = spark.createDataFrame(table.toArrow())  # a fixed order of rows
    first, grown = slot_shards.plan_shards(table, scratch_path(spark, "map"), 8)
    got = slot_shards.write_shards(table, first, scratch_path(spark, "shards"))
    loads = [r["b"] for r in got.groupBy("shard").agg(F.sum(slot_shards.size_of("text")).alias("b")).collect()]
    assert len(loads) == 8 and max(loads) < 1.02 * sum(loads) / 8
    for r in got.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("m")).collect():
        assert r["n"] == r["d"] == r["m"] + 1
    moved = got.join(grown.select("vslot", "sub", F.col("shard").alias("to")), ["vslot", "sub"])
    loads = {r["to"]: r["b"] for r in moved.groupBy("to").agg(F.sum(slot_shards.size_of("text")).alias("b")).collect()}
    assert moved.where("to <> shard and to <> 8").count() == 0
    assert len(loads) == 9 and max(loads.values()) < 1.05 * sum(loads.values()) / 9


def test_capture_times_of_any_id(spark):
    ids = [0, 1, None, -1, 2**62, -(2**63), 2**63 - 1, 300_000_000_000]
    df = spark.createDataFrame([(i,) for i in ids], "page_id long")
    got = df.select("page_id", warc_index.capture_time(F.col("page_id")).alias("t")).collect()
    assert all(len(r["t"]) == 14 and r["t"].isdigit() for r in got)
    times = {r["page_id"]: r["t"] for r in got}
    assert times[0] == times[None] == "20240101000000" and times[1] == "20240101000001"


def test_pages_of_any_id_come_back(spark):
    html = words(4, 400)
    ids = [2**62, -(2**63), 5, None, 300_000_000_000]
    pages = spark.createDataFrame([(i, f"http://h/{i}", html) for i in ids], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc_index.archive_pages(pages).collect()}
    assert set(got) == set(ids)
    assert [i for i in got if got[i]["record_type"] == "response"] == [2**62]


def test_another_vocabulary_gives_its_own_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.cuts_words_alike(path) and packing.cuts_words_alike(public_tokenizers.path(packing.VOCABULARY))
    texts = ["Hello  World\n\n it's", "ÉÀ 中文 🙂", "", None, "<|endoftext|>"]
    table = docs(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["ids"] for r in packing.token_pieces(table, vocabulary=path, keep_ids=True).collect()}
    tokenizer = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        assert got[i] == [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END]


def test_pieces_without_ids_are_placed_once(spark):
    """Many rows with a null id and one start: each gets a place of its own, run after run."""
    rng = np.random.default_rng(2)
    rows = [(None, " ".join(words(int(i), int(rng.integers(1, 900))).split()), "en", "a", 1) for i in range(300)]
    pieces = packing.pack_documents(docs(spark, rows).repartition(7))
    placed = [(r["sequence_id"], r["offset"], r["length"]) for r in pieces.collect()]
    by_sequence = {}
    for sequence, offset, length in placed:
        by_sequence.setdefault(sequence, []).append((offset, length))
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_op3_sorts_only_suffixes_that_begin_windows(monkeypatch):
    """The last 399 bytes of a stretch begin no window: they are neither compared nor, mostly, sorted."""
    sorted_ones = []
    prefixes = suffix_dedup.common_prefixes

    def spied(data, order, depth):
        sorted_ones.append(len(order))
        return prefixes(data, order, depth)

    monkeypatch.setattr(suffix_dedup, "common_prefixes", spied)
    rng = random.Random(5)
    for length in (1, 3, 8, 20):
        for letters in ("a", "ab", "abcdefgh"):
            base = "".join(rng.choices(letters, k=60)).encode()
            cuts = [(rng.randrange(50), rng.randrange(60)) for _ in range(6)]
            pieces = [base[a : a + n] for a, n in cuts] + [b"", base[:2] * 15, bytes(base[::-1])]
            counts = [1, 1, 2] * 3
            held = Counter()
            for piece, n in zip(pieces, counts, strict=True):
                for at in range(len(piece) - length + 1):
                    held[piece[at : at + length]] += n
            got = suffix_dedup.repeated_windows(pieces, counts, length)
            assert [g.tolist() for g in got] == [
                [held[p[at : at + length]] > 1 for at in range(len(p) - length + 1)] for p in pieces
            ]
            assert sorted_ones.pop() == sum(len(g) for g in got)
