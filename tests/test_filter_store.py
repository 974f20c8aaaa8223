"""Stored filters give the rows of the plain ones and skip the rest."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from gildmill.operators import filter_store, filters

NAMES = ["Ann", " bob ", "Éva", "Carl", None, "ann", ""]


def rows_of(n=300):
    return [
        (
            i,
            NAMES[i % 7],
            [NAMES[j % 7] for j in range(i % 4, i % 9)] if i % 11 else None,
            None if i % 13 == 0 else f"{1960 + i % 60}-03-0{1 + i % 9}",
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    df = spark.createDataFrame(rows_of(), "id long, director string, top_cast array<string>, d string")
    df = df.withColumn("release_date", F.col("d").cast("date")).drop("d")
    path = str(tmp_path_factory.mktemp("store"))
    store = filter_store.write_filter_store(
        df, path, "id", ("director",), ("top_cast",), "release_date", bucket_members=20
    )
    return df, store, filter_store.read_filter_store(spark, path)


@pytest.mark.parametrize(
    ("field", "value", "exact", "literals"),
    [("director", "ANN ", False, 0), ("director", "Ann", True, 0), ("director", "", False, 0),
     ("top_cast", "bob", False, 1000), ("top_cast", "bob", False, 2), ("top_cast", "Ann", True, 1000),
     ("top_cast", "nobody", False, 2), ("year", "1999", False, 0), ("year", "0000", False, 0), (None, "x", False, 0)],
)
def test_rows_equal_the_plain_filter(stored, monkeypatch, field, value, exact, literals):
    monkeypatch.setattr(filter_store, "LITERAL_KEYS", literals)
    df, _, store = stored
    test = filters.search_filter(field, value, exact=exact)
    want = df if test is None else df.where(test)
    got = store.search(field, value, exact)
    assert got.columns == df.columns
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())


def explained(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_plans_skip(stored):
    _, store, _ = stored
    year = explained(store.search("year", "1999"))
    assert "_decade#" in year.split("PartitionFilters: ")[1].split("\n")[0] and "1990" in year
    director = explained(store.search("director", " Ann"))
    assert "EqualTo(director_folded,ann)" in director
    cast = explained(store.search("top_cast", "bob"))
    assert "In(id," in cast and "_decade" in cast
    with pytest.raises(ValueError):
        store.search("studio", "x")
    with pytest.raises(ValueError):
        store.search("year", "soon")


def test_an_absent_director_reads_no_row_group(spark, tmp_path):
    """The Bloom filter or the dictionary answers: no row reaches the filter."""
    df = spark.range(20_000).withColumn("director", F.sha2(F.col("id").cast("string"), 256))
    store = filter_store.write_filter_store(df, str(tmp_path), "id", ("director",))
    found = store.search("director", "f" * 64)
    assert found.count() == 0
    absent = store.rows().where(F.col("director_folded") == "8" * 64)
    absent.collect()
    scan = absent._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() == 0


def test_null_keys_and_empty_tables(spark, tmp_path):
    shape = "id long, director string, top_cast array<string>, release_date date"
    df = spark.createDataFrame([(None, "Ann", ["x"], None), (1, "Ann", ["x", "X "], None)], shape)
    store = filter_store.write_filter_store(df, str(tmp_path / "a"), "id", ("director",), ("top_cast",), "release_date")
    assert store.search("director", "ann").count() == 2
    assert [r["id"] for r in store.search("top_cast", "x").collect()] == [1]
