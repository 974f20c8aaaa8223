"""Readers, writers and the batch sink."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gildmill.operators import metrics
from gildmill.sources import document_sink, readers, writers
from gildmill.sources.file_client import FileClient

CLIENT = "gildmill.sources.file_client:connect"

SCHEMA = readers.text_schema(["id", "title", "overview"])


def test_multi_line_csv_over_several_files(spark, tmp_path):
    (tmp_path / "movies_1.csv").write_text('id,title,overview\n862.0,Toy Story,"Led by ""Woody"",\nAndy"\n')
    (tmp_path / "movies_2.csv").write_text('id,title,overview\n8844,"Jumanji, again",\n')
    glob = str(tmp_path / "movies_*.csv")
    rows = readers.read_csv(spark, glob, SCHEMA, multi_line=True).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("862.0", "Toy Story", 'Led by "Woody",\nAndy'),
        ("8844", "Jumanji, again", None),
    ]
    one = readers.read_csv(spark, [str(tmp_path / "movies_2.csv")], SCHEMA, multi_line=True)
    assert one.count() == 1


def test_corrupt_rows_are_kept(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,title,overview\n1,a,b\n2,a,b,c,d\n")
    df = readers.read_csv(spark, str(tmp_path / "t.csv"), SCHEMA, keep_corrupt=True)
    rows = {r["id"]: r[readers.CORRUPT_COLUMN] for r in df.collect()}
    assert rows == {"1": None, "2": "2,a,b,c,d"}


def test_optional_and_required_tables(spark, tmp_path):
    absent = str(tmp_path / "absent")
    assert readers.read_optional_parquet(spark, absent) is None
    assert readers.read_optional_csv(spark, absent + "*.csv", SCHEMA) is None
    with pytest.raises(AnalysisException):
        readers.read_parquet(spark, absent)
    (tmp_path / "junk.parquet").write_text("not parquet")
    with pytest.raises(Exception):  # noqa: B017  only an absent path is optional
        readers.read_optional_parquet(spark, str(tmp_path / "junk.parquet")).count()


def test_overwrite_is_idempotent_and_errors_propagate(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5)
    for _ in range(2):
        assert writers.write_and_read(df, path).count() == 5
    with pytest.raises(Exception):  # noqa: B017
        writers.write_table(df, "/proc/no/such/place")


def test_scratch_tables_share_one_folder_and_can_be_removed(spark, tmp_path, monkeypatch):
    root = spark.conf.get(writers.CHECKPOINT_SETTING, None) or ""
    assert writers.scratch_folder(spark).startswith(root)
    own = tmp_path / "own"
    monkeypatch.setattr(writers, "scratch_folder", lambda _: str(own))
    first, second = (writers.scratch_path(spark, "x") for _ in range(2))
    assert first.startswith(str(own)) and first != second
    assert writers.materialize(spark.range(3)).count() == 3
    assert any(own.iterdir())
    assert writers.remove_scratch(spark)
    assert not own.exists()


def test_scratch_writes_no_setting(spark):
    before = spark.conf.get(writers.CHECKPOINT_SETTING, None)
    assert writers.materialize(spark.range(3)).count() == 3
    assert spark.conf.get(writers.CHECKPOINT_SETTING, None) == before


def test_spread_leaves_a_divided_scan_alone(spark):
    many = spark.range(0, 1000, 1, 64)
    assert readers.spread(many, "id") is many
    few = spark.range(0, 1000, 1, 1)
    assert readers.spread(few, "id").rdd.getNumPartitions() == 8


def batches_of(folder):
    current = Path(FileClient({"folder": str(folder)}).collection())
    return [json.loads(p.read_text()) for p in current.iterdir()]


def test_batch_sink_replaces_the_collection(spark, tmp_path):
    df = spark.range(0, 300, 1, 2).select(
        F.col("id").cast("string").alias("tmdb_id"), F.array(F.lit("a")).alias("names")
    )
    for source in (df, df.where("id < 130"), df.where("id < 0")):
        loaded = document_sink.send_documents(spark, source, CLIENT, folder=str(tmp_path))
        batches = batches_of(tmp_path)
        assert max(map(len, batches), default=0) <= document_sink.BATCH_SIZE
        sent = sorted(d["tmdb_id"] for b in batches for d in b)
        assert sent == sorted(r["tmdb_id"] for r in source.collect())
        assert loaded == source.count() == len(sent)
        assert all(d["names"] == ["a"] for b in batches for d in b)


def test_failed_load_leaves_the_collection(spark, tmp_path):
    good = spark.range(0, 100, 1, 2).select(F.col("id").cast("string").alias("tmdb_id"))
    document_sink.send_documents(spark, good, CLIENT, folder=str(tmp_path))
    before = batches_of(tmp_path)
    fails = F.when(F.col("tmdb_id") == "99", F.raise_error(F.lit("broken row")).cast("string"))
    bad = good.select(F.coalesce(fails, "tmdb_id").alias("tmdb_id"))
    with pytest.raises(Exception, match="broken row"):
        document_sink.send_documents(spark, bad, CLIENT, folder=str(tmp_path))
    assert sorted(map(str, batches_of(tmp_path))) == sorted(map(str, before))
    # the failed load's own folder is gone
    assert len([p for p in tmp_path.iterdir() if p.is_dir()]) == 1


def test_a_retry_that_cuts_fewer_batches_leaves_nothing_behind(tmp_path):
    """Attempt 0 sent three batches and was lost; attempt 1 sends one."""
    options = {"folder": str(tmp_path), "load": "x"}
    FileClient(options).prepare()
    for attempt, batches in (("0", 3), ("1", 1)):
        client = FileClient({**options, "task": "4", "attempt": attempt})
        for i in range(batches):
            client.send([{"id": f"{attempt}{i}"}, {"id": f"{attempt}{i}b"}])
    other = FileClient({**options, "task": "14", "attempt": "0"})
    other.send([{"id": "z"}])
    FileClient(options).publish(3, ["4-1", "14-0"])
    assert sorted(d["id"] for b in batches_of(tmp_path) for d in b) == ["10", "10b", "z"]
    assert FileClient(options).count() == 3


def test_a_lost_batch_file_is_seen(spark, tmp_path):
    df = spark.range(0, 300, 1, 2).select(F.col("id").cast("string").alias("tmdb_id"))
    assert document_sink.send_documents(spark, df, CLIENT, folder=str(tmp_path)) == 300
    client = FileClient({"folder": str(tmp_path)})
    lost = sorted(Path(client.collection()).iterdir())[0]
    n = len(json.loads(lost.read_text()))
    ids = {d["tmdb_id"] for d in json.loads(lost.read_text())}
    lost.unlink()
    assert client.count() == 300 - n
    stored = spark.read.schema(df.schema).json(client.collection())
    report = metrics.reconcile_ranges(df, stored, "tmdb_id")
    assert {(r["tmdb_id"], r["difference"]) for r in report.keys.collect()} == {(i, "missing") for i in ids}
