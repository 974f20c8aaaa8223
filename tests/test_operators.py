"""Dedup, joins, filters, metrics: small exact cases, properties and plan shapes."""

from __future__ import annotations

from datetime import date

import pytest
from plans import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildmill.functions.text import fold_key_no_punctuation
from gildmill.operators import aggregates, columns, dedup, external, filters, joins, metrics

DAY = date(1995, 10, 30)
TITLES = [
    ("1", "Toy Story", DAY),
    ("2", "  Toy Story  ", DAY),
    ("3", "TOY STORY", DAY),
    ("4", "Toy Story.", DAY),
    ("5", "Toy Story", None),
    ("6", "Toy Story", None),
    ("7", " ", DAY),
    ("8", "", DAY),
]


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame(TITLES, "id string, title string, day date")


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def near(df, **more):
    return dedup.near_duplicates_removed(df, "title", ["day"], ["id"], ["id"], **more)


def test_near_duplicates(titles):
    assert ids(near(titles)) == ["1", "4", "5", "6", "7", "8"]
    assert ids(near(titles, fold=fold_key_no_punctuation)) == ["1", "5", "6", "7", "8"]


def test_dedup_is_idempotent_and_order_free(spark, titles):
    once = near(titles)
    assert ids(near(once)) == ids(once)
    for n in ("1", "3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert ids(near(titles.orderBy(F.rand(int(n))))) == ids(once)
        kept = dedup.first_per_key(titles.repartition(int(n)), ["day"]).collect()
        assert sorted((r["id"], r["day"]) for r in kept) == [("1", DAY), ("5", None)]
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_near_duplicate_keys_are_short(spark):
    """Texts are neither moved nor sorted: the exchange and the sort hold their digests."""
    df = spark.createDataFrame([("A b", 1), ("a B ", 2), ("c", 3)], "title string, id int").repartition(2)
    kept = dedup.near_duplicates_removed(df, "title", unique_key=["id"], order_by=["id"]).select("id")
    assert ids(kept) == [1, 3]
    window = plan_of(kept, "formatted").split("WindowGroupLimit")[-1]
    assert "sha2(" in plan_of(kept, "formatted")
    for line in window.splitlines():
        if line.startswith("Arguments") and ("hashpartitioning" in line or "ASC" in line):
            assert "title" not in line


def test_equal_rows_without_unique_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("", 1), ("", 1), ("", 2)], "title string, n int")
    kept = dedup.near_duplicates_removed(df, "title")
    assert sorted(tuple(r) for r in kept.collect()) == [("", 1), ("", 2), ("a", 1)]
    assert dedup.distinct_rows(df).count() == 3


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of all rows in one group: at most one row per task leaves it."""
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    kept = dedup.first_per_key(df, ["k"], ["id"])
    text = plan_of(kept)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert kept.count() == 60_001
    assert kept.where("k = -1").first()["id"] == 0


def test_map_keys_never_repeats_a_fact(spark):
    facts = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), ("c", 4.0)], "k string, v double")
    mapping = spark.createDataFrame(
        [("a", "9"), ("a", "8"), ("b", "7"), ("c", None), (None, "6")], "k string, t string"
    )
    want = [("a", 1.0, "8"), ("a", 2.0, "8"), ("b", 3.0, "7")]
    for limit in (joins.BROADCAST_LIMIT_BYTES, 0):
        got = joins.map_keys(facts, mapping, "k", "t", "id", limit)
        assert sorted((r["k"], r["v"], r["id"]) for r in got.collect()) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(joins.map_keys(facts, mapping, "k", "t", "id"))
        assert "Broadcast" not in plan_of(joins.map_keys(facts, mapping, "k", "t", "id", 0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_bytes_grows_with_the_data(spark):
    small = spark.range(10).select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert 1000 <= joins.measured_bytes(small) <= 3000
    assert joins.measured_bytes(small.where("id < 0")) == 0
    vectors = small.select(F.array_repeat(F.lit(1.0), 64).alias("v"))
    assert joins.measured_bytes(vectors) >= 10 * 64 * 8


def test_orphans(spark):
    child = spark.createDataFrame([("862",), ("862",), ("8844",), ("9999999",), (None,)], "id string")
    parent = spark.createDataFrame([("862",), ("862",), ("8844",), ("5",)], "id string")
    kept = joins.drop_orphans(child, parent, "id")
    assert ids(kept) == ["862", "862", "8844"]
    report = joins.orphan_report(child, parent, "id")
    assert sorted(tuple(r) for r in report.collect()) == [("5", "no_child", 1), ("9999999", "no_parent", 1)]
    known = child.where("id is not null")
    lost = report.where("reason = 'no_parent'").agg(F.sum("n_rows")).first()[0]
    assert kept.count() + lost == known.count()
    assert "Join" not in plan_of(report)


def test_left_enrich_keeps_the_row_count(spark):
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    side = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), ("z", 9)], "id string, n int")
    got = joins.left_enrich(base, side, "id", {"n": "int"}, ["n"])
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1), ("b", None), ("c", None)]
    absent = joins.left_enrich(base, None, "id", {"n": "int"})
    assert absent.schema["n"].dataType == T.IntegerType()
    assert absent.count() == 3


def test_rating_aggregate(spark):
    base = spark.createDataFrame([("a",), ("b",)], "id string")
    facts = spark.createDataFrame([("a", 4.0), ("a", None), ("a", 2.0)], "id string, rating double")
    agg = aggregates.mean_and_count(facts, "id", "rating")
    got = aggregates.left_join_aggregate(base, agg, "id")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 3.0, 2), ("b", None, 0)]
    none = aggregates.left_join_aggregate(base, None, "id")
    assert none.schema.simpleString() == got.schema.simpleString()


def test_filters(spark):
    df = spark.createDataFrame(
        [(0.4,), (0.5,), (5.0,), (5.1,), (None,), (float("nan"),)], "rating double"
    )
    assert ids(df.where(filters.in_range(F.col("rating"), 0.5, 5.0)), "rating") == [0.5, 5.0]
    days = spark.createDataFrame(
        [(date(1899, 12, 31),), (date(1900, 1, 1),), (date(2030, 12, 31),), (date(2031, 1, 1),), (None,)],
        "d date",
    )
    kept = days.where(filters.years_or_null(F.col("d"), 1900, 2030)).collect()
    assert [r["d"] for r in kept] == [date(1900, 1, 1), date(2030, 12, 31), None]
    people = spark.createDataFrame([("Jane Doe", ["Al", "Bo"], DAY)], "director string, top_cast array<string>, release_date date")
    for field, value, hit in [
        ("director", " jane DOE", 1),
        ("director", "jane", 0),
        ("top_cast", "bo", 1),
        ("top_cast", "b", 0),
        ("year", "1995", 1),
        ("year", "1996", 0),
    ]:
        assert people.where(filters.search_filter(field, value)).count() == hit
    assert people.where(filters.search_filter("top_cast", "bo", exact=True)).count() == 0
    assert filters.search_filter("any", "x") is None and filters.search_filter(None, "x") is None
    for field, value in [("year", "soon"), ("year", "-5"), ("studio", "x")]:
        with pytest.raises(ValueError):
            filters.search_filter(field, value)


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(DAY, 1.0, "x")], "d date, r double, t string").write.parquet(path)
    df = spark.read.parquet(path)
    year = plan_of(df.where(filters.in_year(F.col("d"), 1995)).select("r"), "formatted")
    assert "GreaterThanOrEqual(d,1995-01-01), LessThan(d,1996-01-01)" in year
    assert "ReadSchema: struct<d:date,r:double>" in year
    rating = plan_of(df.where(filters.in_range(F.col("r"), 0.5, 5.0)), "formatted")
    assert "GreaterThanOrEqual(r,0.5), LessThanOrEqual(r,5.0)" in rating


def test_columns(spark):
    df = spark.createDataFrame([(1, " a ")], "id bigint, t string")
    cast = columns.cast_keys(df, ["id"])
    assert cast.schema["id"].dataType == T.StringType()
    assert columns.rewrite_present(df, ["t", "absent"], F.trim).first()["t"] == "a"
    filled = columns.with_defaults(df, {"t": (None, "string"), "n": (0, "bigint")})
    assert tuple(filled.first()) == (1, " a ", 0)
    assert columns.empty_like(df, {"x": "string", "n": "float"}).count() == 0


@pytest.mark.parametrize("ranges", [1, 7, 4096])
def test_reconcile_by_ranges(spark, ranges):
    shape = "k string, a string, l array<int>, extra int"
    rows = [(str(i), f"t{i % 5}", [i, None], i) for i in range(200)] + [("9", "t4", [9, None], 9), (None, "x", None, 0)]
    source = spark.createDataFrame(rows, shape)
    same = metrics.reconcile_ranges(source, source.repartition(3).drop("extra"), "k", ranges=ranges)
    assert tuple(same.summary.first()) == (202, 202, 0, 0, 0) and same.ranges == [] and same.keys.count() == 0
    loaded = [r for r in rows if r[0] not in ("17", "18")] + [("new", "x", None, 0)]
    loaded = [(k, "other" if k == "30" else a, [1] if k == "31" else n, e) for k, a, n, e in loaded]
    loaded.remove(("9", "t4", [9, None], 9))  # one of two
    report = metrics.reconcile_ranges(source, spark.createDataFrame(loaded, shape), "k", ranges=ranges)
    assert {(r["k"], r["difference"]) for r in report.keys.collect()} == {
        ("17", "missing"), ("18", "missing"), ("new", "extra"), ("30", "changed"), ("31", "changed"), ("9", "changed"),
    }
    assert tuple(report.summary.first()) == (202, 200, 2, 1, 3)
    assert len(report.ranges) <= min(ranges, 6)


def test_only_unequal_ranges_are_compared_by_key(spark):
    source = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v"))
    report = metrics.reconcile_ranges(source, source.where("k <> '500'"), "k")
    assert len(report.ranges) == 1
    text = plan_of(report.keys)
    assert "Join" not in text and str(report.ranges[0]) in text
    assert [tuple(r) for r in report.keys.collect()] == [("500", "missing")]


def test_counts_along_the_way(spark):
    count = metrics.RowCounts()
    df = count(spark.range(100), "read")
    df = count(df.where("id % 2 = 0"), "odd")
    df = count(df.where("id > 10"), "small")
    assert len(df.collect()) == 44
    assert count.passed() == [100, 50, 44] and count.dropped() == {"odd": 50, "small": 6}


def test_stage_metrics_and_reconcile(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (5, None), (50, "c")], "n int, t string")
    rules = {"no_number": F.col("n").isNotNull(), "no_text": F.col("t") != "", "big": F.col("n") < 10}
    got = metrics.stage_metrics(df, rules).first().asDict()
    assert got == {"rows_in": 4, "dropped_no_number": 1, "dropped_no_text": 1, "dropped_big": 1, "rows_out": 1}
    source = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "k string")
    sink = spark.createDataFrame([("a",), ("c",), ("d",)], "k string")
    assert tuple(metrics.reconcile(source, sink, "k").first()) == (4, 3, 1, 1, 1)
    empty = source.where("false")
    assert tuple(metrics.reconcile(empty, empty, "k").first()) == (0, 0, 0, 0, 0)


def test_external_lookup(spark, tmp_path):
    log = str(tmp_path)

    def connect():
        from pathlib import Path

        def fetch(key):
            calls = Path(log) / str(key)
            calls.write_text(calls.read_text() + "x" if calls.exists() else "x")
            if key == "flaky" and len(calls.read_text()) < 3:
                raise TimeoutError("slow")
            if key == "bad":
                raise KeyError("gone")
            return {"plot": f"about {key}", "score": len(key)} if key != "unknown" else None

        return fetch

    keys = ["a"] * 50 + ["flaky", "bad", "unknown", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    fields = T.StructType([T.StructField("plot", T.StringType()), T.StructField("score", T.LongType())])
    got = external.enrich_external(df, "k", connect, fields, 1000, 2, retries=2)
    rows = {r["k"]: (r["plot"], r["score"], r["lookup_error"]) for r in got.collect()}
    assert got.count() == len(keys)
    assert rows == {
        "a": ("about a", 1, None),
        "flaky": ("about flaky", 5, None),
        "bad": (None, None, "KeyError: 'gone'"),
        "unknown": (None, None, None),
        None: (None, None, None),
    }
    calls = {p.name: len(p.read_text()) for p in tmp_path.iterdir()}
    assert calls == {"a": 1, "flaky": 3, "bad": 3, "unknown": 1}


def counted_service(log, seen=None):
    """Writes the time of every call to a file per call."""

    def connect():
        import time
        import uuid
        from pathlib import Path

        def fetch(key):
            (Path(log) / f"{key}-{uuid.uuid4().hex}").write_text(repr(time.time()))
            if key == "bad":
                raise KeyError("gone")
            return {"size": len(key)}

        return fetch

    return connect


SIZE = T.StructType([T.StructField("size", T.LongType())])


def test_one_rate_holds_for_the_whole_job(spark, tmp_path):
    df = spark.createDataFrame([(f"k{i}",) for i in range(40)], "k string").repartition(6)
    got = external.enrich_external(
        df, "k", counted_service(str(tmp_path)), SIZE, parallel=4, job_calls_per_second=25
    )
    assert got.where("size is null").count() == 0
    calls = sorted(float(p.read_text()) for p in tmp_path.iterdir())
    assert len(calls) == 40
    # 25 turns begin in a second; a call is noted a little after its turn.
    assert all(sum(a <= b < a + 1.0 for b in calls) <= 25 + 2 for a in calls)
    assert calls[-1] - calls[0] >= 38 / 25 - 0.1


def test_turns_are_shared_and_never_taken_twice():
    now = [100.0]
    taken = []
    tasks = [external.Turns(i, 3, 0.1, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s)) for i in range(3)]
    for _ in range(5):
        for i in (2, 0, 1):
            tasks[i]()
            taken.append(tasks[i].last)
    assert len(set(taken)) == len(taken) and {t % 3 for t in taken} == {0, 1, 2}
    assert all(t.last % 3 == t.mine for t in tasks)


def test_a_late_turn_is_not_taken():
    now = [10.0]
    sleeps = []

    def sleep(s):
        sleeps.append(s)
        now[0] += s + (0.3 if len(sleeps) == 1 else 0.0)  # wakes up late once

    turns = external.Turns(1, 4, 0.5, lambda: now[0], sleep)
    turns()
    assert now[0] == 12.5 and turns.last == 25 and len(sleeps) == 2


def test_stored_answers_are_asked_for_once(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "answers")
    log.mkdir()

    def run(keys, **more):
        df = spark.createDataFrame([(k,) for k in keys], "k string")
        got = external.enrich_external(df, "k", counted_service(str(log)), SIZE, retries=0, answers=store, **more)
        rows = sorted(((r["k"] or "", r["size"], r["lookup_error"]) for r in got.collect()))
        calls = sorted(p.name.split("-")[0] for p in log.iterdir())
        for p in log.iterdir():
            p.unlink()
        return rows, calls

    rows, calls = run(["a", "bb", "bb", "bad", None])
    assert calls == ["a", "bad", "bb"]
    assert rows == [("", None, None), ("a", 1, None), ("bad", None, "KeyError: 'gone'"), ("bb", 2, None), ("bb", 2, None)]
    rows, calls = run(["a", "ccc", "bad"])  # errors are asked for again
    assert calls == ["bad", "ccc"] and rows[0] == ("a", 1, None)
    assert run(["a", "ccc"])[1] == []
    assert run(["a"], expires_after_seconds=0.0)[1] == ["a"]
    assert run(["a", "bb"], expires_after_seconds=3600)[1] == []
