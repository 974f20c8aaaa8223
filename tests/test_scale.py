"""Work that must not gather in one task as tables grow."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from gildmill.operators import filter_store, term_index
from gildmill.plans import incremental
from gildmill.queries import storage
from gildmill.sources import document_sink, readers
from plans import plan_of


def test_one_task_does_not_write_the_whole_csv(spark, tmp_path):
    rows = [(i, f'line "{i}"\nand, more', "en") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.repartition(32, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    found = storage.csv_split_scan(spark, str(tmp_path))
    assert len(set(found.inputFiles())) > 1
    assert sorted(map(tuple, found.collect())) == sorted((str(i), t, x) for i, t, x in rows)


def test_members_of_a_store_are_made_distinct_in_their_rows(spark, tmp_path):
    rows = [(1, ["With", " with", None, "a"]), (2, ["with", "with"]), (2, ["WITH"]), (None, ["with"]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "id long, names array<string>")
    store = filter_store.write_filter_store(df, str(tmp_path), "id", array_fields=("names",))
    stored = spark.read.parquet(f"{tmp_path}/members/names")
    assert sorted((r["name"], r["id"]) for r in stored.collect()) == [("a", 1), ("with", 1), ("with", 2), ("with", 2)]
    assert sorted(r["id"] for r in store.members("names", "WITH").collect()) == [1, 2]
    assert sorted(r["id"] for r in store.search("names", "with").collect()) == [1, 2, 2]


def test_members_are_written_by_more_tasks_as_they_grow(spark, tmp_path):
    df = spark.range(4000).select("id", F.array((F.col("id") % 50).cast("string")).alias("names"))
    store = filter_store.write_filter_store(df, str(tmp_path), "id", array_fields=("names",), bucket_members=64)
    files = spark.read.parquet(f"{tmp_path}/members/names").select(F.input_file_name().alias("f"))
    tasks = files.select(F.regexp_extract("f", r"part-(\d+)", 1)).distinct().count()
    assert store.buckets == 64 and tasks > 32


def test_a_sending_task_takes_few_rows_at_a_time(spark, tmp_path, monkeypatch):
    seen, save = [], DataFrameWriter.save
    monkeypatch.setattr(
        DataFrameWriter, "save", lambda self, *a, **k: (seen.append(spark.conf.get(document_sink.ARROW_ROWS)), save(self, *a, **k))
    )
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.range(0, 300, 1, 2).select(F.col("id").cast("string").alias("tmdb_id"))
    assert document_sink.send_documents(spark, df, "gildmill.sources.file_client:connect", folder=str(tmp_path)) == 300
    assert seen == [str(document_sink.BATCH_SIZE)]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_files_that_are_many_are_not_shuffled_before_their_repair(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 4000, 1, 2 * cores).select(F.col("id").cast("string"))
    for name, df, moved in (("many", many, False), ("one", many.coalesce(1), True)):
        df.write.csv(f"{tmp_path}/{name}")
        found = readers.spread_files(spark.read.csv(f"{tmp_path}/{name}"))
        assert ("Exchange" in plan_of(found)) is moved and found.count() == 4000


def test_an_update_moves_rows_once_and_derives_what_has_changed(spark, tmp_path, monkeypatch):
    bronze, lake, state = (str(tmp_path / x) for x in ("bronze", "silver", "state"))
    movies = spark.createDataFrame([(str(i), f"T {i % 5}", "2001-01-01") for i in range(9)], "id string, title string, release_date string")
    ratings = spark.createDataFrame([("1", "3", "4.0", "9")] * 2, "userId string, movieId string, rating string, timestamp string")
    storage.write_csv(movies.where("id < 5"), f"{bronze}/movies_metadata_0.csv")
    storage.write_csv(ratings, f"{bronze}/ratings_small.csv")
    merged, written = [], []
    fresh, write = incremental.materialized, incremental.write_table
    monkeypatch.setattr(incremental, "materialized", lambda df, name: merged.append(name) or fresh(df, name))
    monkeypatch.setattr(incremental, "write_table", lambda df, path: written.append(path.rsplit("/", 1)[1]) or write(df, path))
    incremental.update_silver(spark, bronze, lake, state)
    assert not merged and {"movies.parquet", "ratings.parquet"} <= set(written)
    written.clear()
    storage.write_csv(movies.where("id >= 5"), f"{bronze}/movies_metadata_1.csv")
    incremental.update_silver(spark, bronze, lake, state)
    assert merged == ["fresh"] and "movies.parquet" in written and "ratings.parquet" not in written
    assert spark.read.parquet(f"{lake}/ratings.parquet").count() == 1
    assert sorted(r["id"] for r in spark.read.parquet(f"{lake}/movies.parquet").collect()) == list("01234")


def test_an_index_shuffles_only_rare_terms_to_their_weights(spark, tmp_path, monkeypatch):
    rows = [(i, f"all some{i % 3} rare{i}" + (" rare7" if i == 8 else "")) for i in range(40)]
    df = spark.createDataFrame([*rows, (40, "all all"), (41, " ")], "id long, t string")
    monkeypatch.setattr(term_index, "BROADCAST_LIMIT_BYTES", 1 << 20)
    whole = term_index.index_terms(df, "t", "id", f"{tmp_path}/a", bucket_postings=4)
    monkeypatch.setattr(term_index, "BROADCAST_LIMIT_BYTES", 300)
    divided = term_index.index_terms(df, "t", "id", f"{tmp_path}/b", bucket_postings=4)
    frequency = spark.read.parquet(f"{tmp_path}/b/frequencies")
    assert [term_index._least_common(frequency, n) for n in (1 << 20, 300, 1)] == [1, 8, 1 << 62]
    for name in ("terms", "postings", "docs"):
        found = [
            sorted(re.sub(r"\d+\.\d+", lambda m: f"{float(m[0]):.9f}", str(r)) for r in x.read(name).withColumns(
                {c: F.sort_array(c) for c, t in x.read(name).dtypes if t.startswith("array")}
            ).collect())
            for x in (whole, divided)
        ]
        assert found[0] == found[1] and found[0]
    entries = spark.read.parquet(f"{tmp_path}/b/counts").select("id", F.inline("entries"))
    weights = frequency.withColumn("idf", F.col("df") * 1.0)
    near = plan_of(term_index._weighted(entries, weights, 8))
    assert "BroadcastHashJoin" in near and near.count("LeftAnti") == 1
    assert "Exchange hashpartitioning" not in plan_of(term_index._weighted(entries, weights, 1))
