"""Runs that read new files only, and joins on bucketed silver tables."""

from __future__ import annotations

import os
import shutil

import pytest
from plans import plan_of
from test_jobs import KEYWORDS, MOVIES, bronze_folder, write

from gildmill.plans import bucketed, gold, incremental, schemas, silver

TABLES = {
    "movies": schemas.MOVIES_TABLE,
    "credits": schemas.CREDITS_TABLE,
    "keywords": schemas.KEYWORDS_TABLE,
    "ratings": schemas.RATINGS_TABLE,
}


def same_as_full_run(spark, bronze, lake, tmp):
    full = silver.bronze_to_silver(spark, bronze, str(tmp))
    for name, table in TABLES.items():
        got = spark.read.parquet(f"{lake}/{table}")
        want = full[name].select(*got.columns)
        assert set(full[name].columns) == set(got.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def names(read):
    return {tab: [os.path.basename(f) for f in files] for tab, files in read.items()}


def test_runs_with_new_files_equal_a_full_run(spark, tmp_path, monkeypatch):
    bronze = bronze_folder(tmp_path / "bronze")
    second, links = tmp_path / "bronze" / "movies_metadata_2.csv", tmp_path / "bronze" / schemas.LINKS_FILE
    for later in (second, links):
        shutil.move(later, tmp_path / later.name)
    lake, state = str(tmp_path / "silver"), str(tmp_path / "state")

    def update():
        return names(incremental.update_silver(spark, bronze, lake, state, buckets=5))

    assert set(update()) == {"movies", "credits", "keywords", "ratings"}
    asked = []
    read_csv = incremental.read_csv
    monkeypatch.setattr(incremental, "read_csv", lambda s, paths, *a, **k: asked.extend(paths) or read_csv(s, paths, *a, **k))

    shutil.move(tmp_path / second.name, second)  # a second file of movies: an orphan finds its parent
    assert update() == {"movies": ["movies_metadata_2.csv"]}
    assert len(asked) == 1 and len(asked[0]) == 1

    shutil.move(tmp_path / links.name, links)  # ratings are mapped without being read again
    assert update() == {"links": [schemas.LINKS_FILE]}
    same_as_full_run(spark, bronze, lake, tmp_path / "full2")
    assert update() == {} and len(asked) == 2

    write(tmp_path / "bronze" / "movies_metadata_3.csv", schemas.BRONZE_MOVIES, [
        {"id": "524", "title": "Casino Royale", "overview": "fuller", "tagline": "t", "release_date": "1995-11-22", "runtime": "9"},
        {"id": "1000", "title": " casino", "release_date": "1995.11.22"},  # no longer a near duplicate
    ])
    assert update() == {"movies": ["movies_metadata_3.csv"]}
    same_as_full_run(spark, bronze, lake, tmp_path / "full3")
    titles = {r["id"]: r["title"] for r in spark.read.parquet(f"{lake}/{schemas.MOVIES_TABLE}").collect()}
    assert (titles["524"], titles["1000"]) == ("Casino Royale", "casino")


def test_a_changed_file_starts_its_table_anew(spark, tmp_path):
    bronze = bronze_folder(tmp_path / "bronze")
    lake, state = str(tmp_path / "silver"), str(tmp_path / "state")
    incremental.update_silver(spark, bronze, lake, state, buckets=3)
    write(tmp_path / "bronze" / schemas.KEYWORDS_FILE, schemas.BRONZE_KEYWORDS, [{"id": "862", "keywords": "[]"}, *KEYWORDS[1:]])
    assert names(incremental.update_silver(spark, bronze, lake, state, buckets=3)) == {"keywords": [schemas.KEYWORDS_FILE]}
    os.remove(tmp_path / "bronze" / "movies_metadata_1.csv")
    assert names(incremental.update_silver(spark, bronze, lake, state, buckets=3)) == {"movies": ["movies_metadata_2.csv"]}
    same_as_full_run(spark, bronze, lake, tmp_path / "full2")


def test_a_failed_run_is_taken_up(spark, tmp_path, monkeypatch):
    bronze = bronze_folder(tmp_path / "bronze")
    lake, state = str(tmp_path / "silver"), str(tmp_path / "state")
    derive = incremental._derive
    monkeypatch.setattr(incremental, "_derive", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        incremental.update_silver(spark, bronze, lake, state, buckets=3)
    monkeypatch.setattr(incremental, "_derive", derive)
    assert incremental.update_silver(spark, bronze, lake, state, buckets=3) == {}

    write(tmp_path / "bronze" / "movies_metadata_4.csv", schemas.BRONZE_MOVIES, MOVIES[4:6])
    monkeypatch.setattr(incremental, "_stage", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        incremental.update_silver(spark, bronze, lake, state, buckets=3)
    monkeypatch.undo()
    assert len(incremental.update_silver(spark, bronze, lake, state, buckets=3)["movies"]) == 3
    same_as_full_run(spark, bronze, lake, tmp_path / "full2")


def test_input_files(spark, tmp_path):
    folder = tmp_path / "in.csv"
    (folder / "deep").mkdir(parents=True)
    for name in ("a", "_SUCCESS", ".a.crc", "deep/b"):
        (folder / name).write_text("x")
    found = incremental.input_files(spark, f"{tmp_path}/in*.csv")
    assert [p.rsplit("in.csv/", 1)[1] for p, *_ in found] == ["a", "deep/b"] and all(n == 1 for _, n, _ in found)
    assert incremental.input_files(spark, f"{tmp_path}/none*.csv") == []


def test_bucketed_joins_exchange_nothing(spark, tmp_path):
    bronze = bronze_folder(tmp_path / "bronze")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed.bucketed_writer(spark, buckets=4) as write_bucketed:
            tables = silver.bronze_to_silver(spark, bronze, str(tmp_path / "silver"), write=write_bucketed)
            wide = gold.enrich_movies(*[tables[t] for t in TABLES], sides_are_unique=True)
            text = plan_of(wide)
            assert "Exchange" not in text and text.count("Join") == 3
            assert wide.count() == tables["movies"].count() == 7
            assert len(spark.catalog.listTables()) >= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("gildmill_")]
    assert spark.read.parquet(str(tmp_path / "silver" / schemas.MOVIES_TABLE)).count() == 7


def test_bronze_to_gold_in_one_job(spark, tmp_path):
    bronze = bronze_folder(tmp_path / "bronze")
    got = bucketed.bronze_to_gold(spark, bronze, str(tmp_path / "s1"), str(tmp_path / "g1"), buckets=3)
    silver.bronze_to_silver(spark, bronze, str(tmp_path / "s2"))
    want = gold.silver_to_gold(spark, str(tmp_path / "s2"), str(tmp_path / "g2"))
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        bucketed.bronze_to_gold(spark, bronze_folder(tmp_path / "b2", ("ratings",)), str(tmp_path / "s3"), str(tmp_path / "g3"))
