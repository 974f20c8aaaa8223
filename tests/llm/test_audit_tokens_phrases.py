"""Filter audit, token counts and phrase mining against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import pytest

from gildmill.llm import filter_audit, phrase_mining, queries, token_counts

from tests.llm.helpers import clashing, docs, empty, odd_rows, words

# ---------------------------------------------------------------- filter audit

LABELS = "doc_id long, quality int, toxic int"
LABEL_ROWS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (4, None, None), (4, 1, 0), (9, 0, 1), (9, 0, 1), (None, 1, 1), (77, 1, 1)]


def audit_rows():
    text = words(8, 130)
    extra = [
        (20, "AB CD " * 60, "en", "a", 1),
        (21, text, None, "a", 1),
        (22, text, "", "a", 1),
        (22, text, "en", "a", 1),
        (23, text + " 5$", "en", "a", 1),
        (None, text, "en", "a", 1),
        (24, "one\ttwo\x0bthree\x85four five", "en", "a", 1),
    ]
    return odd_rows() + extra


def failing(text, doc_id, rows):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    smaller = [i for i, t, *_ in rows if (t or "") == text and i is not None and doc_id is not None and i < doc_id]
    return {
        f
        for f, bad in zip(
            "ABCDE",
            (
                len(found) < 100,
                100 * len(set(found)) < 80 * len(found),
                100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                re.search("[#$%&*|]", text),
                smaller,
            ),
        )
        if bad
    }


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, lang, *_ in rows:
        parts.setdefault(lang or "", []).append((i, failing(text or "", i, rows)))
    out = {}
    for part, members in parts.items():
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = members
            gone = []
            for step, f in enumerate(order, 1):
                out_now = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                removed_by[f] += len(out_now)
                out[part, "".join(order), step] = [
                    len(left),
                    len(out_now),
                    sum(f in m[1] for m in gone),
                    sum(m[1] == {f} for m in members),
                    sum(m[0] in good for m in out_now),
                    sum(m[0] in toxic for m in out_now),
                ]
                gone += out_now
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


COLUMNS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def test_audit_equals_plain_removal(spark):
    rows = audit_rows()
    labels = spark.createDataFrame(LABEL_ROWS, LABELS)
    got = filter_audit.audit_documents(clashing(spark, rows), labels).collect()
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in got} == plain_audit(
        rows, LABEL_ROWS
    )
    assert len(got) == 600 * len({lang or "" for _, _, lang, *_ in rows})


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit_documents(empty(spark), labels).count() == 0
    got = filter_audit.audit_documents(docs(spark, [(1, None, None, None, None)]), labels).collect()
    assert len(got) == 600 and {(r["part"], r["kept"] + r["removed"]) for r in got if r["step"] == 1} == {("", 1)}


@pytest.mark.parametrize("players", [1, 3, 5])
def test_potential_gives_shapley_values(spark, players):
    from pyspark.sql import functions as F

    r = random.Random(players)
    v = [0] + [r.randint(0, 10**12) for _ in range((1 << players) - 1)]
    df = spark.createDataFrame([(v,)], "v array<long>")
    p = df.select(filter_audit.potential(F.col("v"), players)).first()[0]
    orders = list(permutations(range(players)))
    for i in range(players):
        gains = 0
        for order in orders:
            before = sum(1 << j for j in order[: order.index(i)])
            gains += v[before | 1 << i] - v[before]
        everyone = (1 << players) - 1
        assert p[everyone] - p[everyone ^ 1 << i] == gains == Fraction(gains, len(orders)) * len(orders)


# ---------------------------------------------------------------- token counts


@pytest.fixture(scope="module")
def counter():
    return token_counts.counter(token_counts.read_model())


def odd_texts():
    r = random.Random(3)
    letters = "ab é中 ▁▁  \n\t09.,()'\"<s>/ś\x00🙂\x1cÀ\r"
    texts = ["".join(r.choices(letters + "abcdefghijk the", k=r.randint(0, 60))) for _ in range(3000)]
    return texts + [t or "" for _, t, *_ in odd_rows()] + ["<s></s><unk><0x0A>", " ", "▁", "a" * 5000, "中" * 3000]


@pytest.mark.parametrize("chunk", [7, token_counts.CHUNK])
def test_counts_equal_the_library(counter, monkeypatch, chunk):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    monkeypatch.setattr(token_counts.WordCounts, "limit", 50)
    for text in odd_texts():
        assert counter.count(text) == len(counter.library.encode(text)), repr(text)


def test_proved_strings_are_single_tokens(counter):
    assert len(counter.proved) > 25_000
    for piece in list(counter.proved)[::50]:
        plain = piece.replace("▁", " ")
        alone = counter.library.encode(plain[1:] if plain[0] == " " else "\n" + plain)
        assert len(alone) - (plain[0] != " ") * 2 == 1


def test_no_merge_crosses_a_cut(counter):
    classes = token_counts.character_classes(counter.pieces)
    of = {c: i for i, group in enumerate(classes) for c in group}
    for piece in counter.pieces:
        letters = piece.replace("▁", "")
        assert len({of[c] for c in letters if len(piece) > 1}) <= 1, piece
    assert token_counts.character_classes(["ab", "bc", "▁x", "y"]) == [{"a", "b", "c"}, {"x"}]


def test_token_columns(spark, counter):
    table = clashing(spark)
    got = token_counts.count_tokens(table.withColumn("n_tokens", table.doc_id)).collect()
    assert len(got) == len(odd_rows())
    want = Counter((i, t) for i, t, *_ in odd_rows())
    assert Counter((r["doc_id"], r["text"]) for r in got) == want
    for r in got:
        text = r["text"] or ""
        tokens = len(counter.library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), tokens, tokens > 4096)
    assert token_counts.count_tokens(empty(spark)).count() == 0


# ---------------------------------------------------------------- phrases


def phrase_rows():
    r = random.Random(11)
    rows = [(i, " ".join(r.choices("red blue green sea sky of the".split(), k=r.randint(0, 60))), r.choice(["en", "de", None]), "a", 1) for i in range(60)]
    rows += [
        (100, "New York, New York! new york\nNEW\tYORK  New  york" * 5, "en", "a", 1),
        (101, "Éa b. éa B; Éa b: x?y" * 6, "und", "a", 1),
        (102, "one two three four " * 8, "fr", "a", 1),
        (103, "one two three four " * 8, "fr", "a", 1),
    ]
    return rows + odd_rows()


def plain_phrases(rows, least, lengths, keep):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, lengths + 1):
                f.update((lang, tuple(ws[i : i + k])) for i in range(len(ws) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    most = Counter()
    for (lang, p), a in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                most[lang, p[i : i + k]] = max(most[lang, p[i : i + k]], a)
    by_lang = {}
    for (lang, p), a in candidates.items():
        if 100 * most[lang, p] >= 50 * a:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        row = (-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]])
        by_lang.setdefault(lang, []).append(row)
    return {
        (lang, rank): (p.decode(), -a, left, right, n[lang], -score)
        for lang, found in by_lang.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:keep], 1)
    }


def as_rows(df):
    return {(r["lang"], r["rank"]): tuple(r[c] for c in ("phrase", "a", "l", "r", "n", "score")) for r in df.collect()}


@pytest.mark.parametrize(("least", "lengths", "shards", "slots"), [(10, 3, 2, 1 << 16), (2, 4, 3, 64)])
def test_phrases_equal_plain_counts(spark, least, lengths, shards, slots):
    rows = phrase_rows()
    got = phrase_mining.mine_phrases(
        clashing(spark, rows).repartition(5), least=least, lengths=lengths, shards=shards, slots=slots
    )
    assert as_rows(got) == plain_phrases(rows, least, lengths, 2000)


def test_phrases_of_nothing(spark):
    assert phrase_mining.mine_phrases(empty(spark)).count() == 0
    assert phrase_mining.mine_phrases(docs(spark, [(1, " .,\n", "en", "a", 1)])).count() == 0


def test_the_best_phrases_of_salted_groups(spark):
    rows = [("en", f"w{i}", i % 50, i, i, i, 2) for i in range(500)]
    scored = spark.createDataFrame(rows, "lang string, phrase string, score long, a long, l long, r long, k int")
    got = phrase_mining.best_phrases(scored, 20).orderBy("rank").collect()
    want = sorted(rows, key=lambda r: (-r[2], -r[3], r[1]))[:20]
    assert [r["phrase"] for r in got] == [w[1] for w in want]


def test_scores_beyond_64_bits(spark):
    big = 10**13
    rows = [(1, "en", "a", big), (1, "en", "b", big + 7), (2, "en", "a b", big - 1)]
    scored = phrase_mining.score_cuts(spark.createDataFrame(rows, "k int, lang string, phrase string, f long")).first()
    assert scored["score"] == 1_000_000 * (big - 1) ** 2 // (big * (big + 7))


def test_queries_are_registered():
    for n, name in ((11, "filter_audit"), (12, "token_counts"), (13, "phrase_mining")):
        assert f"op{n}_{name}" in queries.QUERIES
    assert {"op11_filter_audit", "op13_phrase_mining"} <= set(queries.ORACLES)
