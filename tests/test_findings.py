"""Cases in which rows were once lost or read wrong."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gildmill.functions import nested
from gildmill.operators.search import nearest_batch
from gildmill.plans import silver
from gildmill.sources.readers import read_csv, text_schema


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_columns_go_by_name(spark, tmp_path, multi_line):
    a = write(tmp_path / "a", "x.csv", "title,id\nX,1\n")
    b = write(tmp_path / "b", "x.csv", "id,extra,year\n2,e,1999\n")
    schema = text_schema(["id", "title", "year"])
    got = read_csv(spark, [a, b], schema, multi_line, required=["id"])
    assert sorted(map(tuple, got.collect())) == [("1", "X", None), ("2", None, "1999")]
    with pytest.raises(ValueError, match="no column title"):
        read_csv(spark, [a, b], schema, multi_line, required=["title"])


def test_one_folder_of_two_headers_raises(spark, tmp_path):
    write(tmp_path / "c", "x.csv", "title,id\nX,1\n")
    folder = write(tmp_path / "c", "y.csv", "id,title\n2,Y\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, folder, text_schema(["id", "title"])).collect()


def test_no_title_is_lost_between_ids_and_near_duplicates(spark):
    rows = [("1", "X", "2001-01-01"), ("1", "Y", "2001-01-01"), ("2", "Y", "2001-01-01")]
    df = spark.createDataFrame(rows, "id string, title string, release_date string")
    kept = silver.clean_movies(df).select("id", "title").collect()
    assert {r["title"] for r in kept} in ({"X", "Y"}, {"Y"})
    assert {r["id"] for r in kept} == ({"1", "2"} if len(kept) == 2 else {"1"})
    assert len(kept) == len({r["title"] for r in kept}) == len({r["id"] for r in kept})


def test_ratings_without_links_stay(spark):
    ratings = spark.createDataFrame(
        [("1", "7", 4.0), ("2", "8", 3.0)], "userId string, movieId string, rating float"
    )
    got = silver.linked_ratings(ratings, None)
    assert got.count() == 2 and got.filter(F.col("id").isNotNull()).count() == 0


def test_queries_of_mixed_length_raise(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    mixed = [(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0])]
    queries = spark.createDataFrame(mixed, "q long, w array<double>")
    with pytest.raises(ValueError, match="2 to 3 dimensions"):
        nearest_batch(corpus, queries, "id", "v", "q", "w")


def test_odd_elements_keep_their_places(spark):
    text = "[1, {'name': 'a'}, {'name': 'b'}, {'name': 'c'}, {'name': 'd'}, {'name': 'e'}]"
    df = spark.createDataFrame([(text,)], "t string")
    both = df.select(
        nested.parse_list_text(F.col("t"), ["name"]).alias("native"),
        nested.parse_list_text(F.col("t"), ["name"], exact=True).alias("exact"),
    ).first()
    assert len(both["native"]) == len(both["exact"]) == 6
