"""The three jobs end to end on one example of every catalogued corruption."""

from __future__ import annotations

import csv
from datetime import date

import pytest
from plans import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gildmill.operators import search, term_index
from gildmill.plans import documents, gold, schemas, silver

GENRES = "[{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': 'Comedy'}]"
CAST = repr([{"name": n, "order": i} for i, n in enumerate(["Tom", "Tim", "Don", "Jim", "Wal", "Joan"])])
CREW = repr(
    [
        {"job": "Editor", "name": "Lee"},
        {"job": "Director of Photography", "name": "Sharon"},
        {"job": "Director", "name": "John"},
    ]
)
MOVIES = [
    {"id": "862", "title": "Toy Story", "overview": "Led by Woody,\nAndy's toys", "tagline": "", "release_date": "1995-10-30", "runtime": "81", "budget": "$30,000,000", "revenue": "373554033", "genres": GENRES},
    {"id": "862", "title": "Toy Story", "overview": "Led by Woody,\nAndy's toys", "tagline": "", "release_date": "1995-10-30", "runtime": "81", "budget": "$30,000,000", "revenue": "373554033", "genres": GENRES},
    {"id": "862", "title": "  Toy   Story ", "overview": "copy", "release_date": "10/30/1995", "genres": GENRES},
    {"id": "862", "title": "TOY STORY", "overview": "undated copy", "genres": ""},
    {"id": "8844.0", "title": "Jumanji", "release_date": "12/15/1995", "runtime": "-1", "budget": "€1.500.000", "genres": GENRES[1:-1]},
    {"id": "710", "title": "GoldenEye", "release_date": "17-11-1995", "runtime": "99999", "budget": "30,000,000.00 USD", "genres": GENRES[:45]},
    {"id": "194", "title": "AmÃ©lie", "overview": "A shy waitress", "release_date": "2001.04.25", "budget": "-1", "genres": "[{'id': 16, 'name': 'Anim"},
    {"id": "524", "title": "Casino", "release_date": "November 22, 1995", "budget": "unknown"},
    {"id": "900", "title": "東京", "release_date": "0000-00-00"},
    {"id": "901", "title": "東京"},
    {"id": "902", "title": "Future Project", "release_date": "2150-01-01"},
    {"id": "903", "title": "Old Project", "release_date": "1492-10-12"},
    {"id": "904", "title": "   "},
    {"id": "", "title": "No id"},
    {"id": "905", "title": ""},
]
CREDITS = [
    {"id": "862", "cast": "", "crew": "[]"},
    {"id": "862", "cast": CAST, "crew": CREW},
    {"id": "8844.0", "cast": "", "crew": "[]"},
    {"id": "9999999", "cast": CAST, "crew": CREW},
]
KEYWORDS = [{"id": "862", "keywords": "[{'id': 931, 'name': \"boy's toy\"}]"}, {"id": "9", "keywords": "[]"}]
RATINGS = [
    {"userId": u, "movieId": m, "rating": r, "timestamp": "1"}
    for u, m, r in [("1", "1", "4.0"), ("1", "1", "4.0"), ("2", "1", "2.0"), ("3", "1", "5.5"), ("4", "1", ""), ("5", "2", "0.5"), ("6", "77", "3.0")]
]
LINKS = [
    {"movieId": "1", "imdbId": "114709", "tmdbId": "862.0"},
    {"movieId": "1", "imdbId": "114709", "tmdbId": "862.0"},
    {"movieId": "2", "imdbId": "113497", "tmdbId": "8844"},
    {"movieId": "3", "imdbId": "1", "tmdbId": ""},
]


def write(path, schema, rows):
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, schema.names)
        out.writeheader()
        out.writerows(rows)


def bronze_folder(tmp, tables=("movies", "credits", "keywords", "ratings", "links")):
    tmp.mkdir()
    if "movies" in tables:
        write(tmp / "movies_metadata_1.csv", schemas.BRONZE_MOVIES, MOVIES[:4])
        write(tmp / "movies_metadata_2.csv", schemas.BRONZE_MOVIES, MOVIES[4:])
    for name, file, schema, rows in [
        ("credits", schemas.CREDITS_FILE, schemas.BRONZE_CREDITS, CREDITS),
        ("keywords", schemas.KEYWORDS_FILE, schemas.BRONZE_KEYWORDS, KEYWORDS),
        ("ratings", schemas.RATINGS_FILE, schemas.BRONZE_RATINGS, RATINGS),
        ("links", schemas.LINKS_FILE, schemas.BRONZE_LINKS, LINKS),
    ]:
        if name in tables:
            write(tmp / file, schema, rows)
    return str(tmp)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    bronze = bronze_folder(root / "bronze")
    tables = silver.bronze_to_silver(spark, bronze, str(root / "silver"))
    wide = gold.silver_to_gold(spark, str(root / "silver"), str(root / "gold"))
    return root, tables, wide


def by_id(df):
    rows = df.collect()
    out = {r["id"]: r.asDict() for r in rows}
    assert len(out) == len(rows)
    return out


def test_silver_movies(lake):
    m = by_id(lake[1]["movies"])
    assert sorted(m) == ["194", "524", "710", "862", "8844", "900", "901"]
    toy = m["862"]
    assert (toy["title"], toy["release_date"]) == ("Toy Story", date(1995, 10, 30))
    assert toy["overview"] == "Led by Woody, Andy's toys"
    assert (toy["runtime"], toy["budget"], toy["revenue"]) == (81.0, 30000000.0, 373554033.0)
    assert (m["8844"]["runtime"], m["8844"]["budget"]) == (None, 1500000.0)
    assert m["8844"]["genres"] == GENRES
    assert (m["710"]["release_date"], m["710"]["runtime"]) == (date(1995, 11, 17), None)
    assert (m["194"]["title"], m["194"]["budget"]) == ("Amélie", 0.0)
    assert m["524"]["release_date"] == date(1995, 11, 22)
    assert m["900"]["release_date"] is None


def test_silver_children_and_ratings(lake):
    tables = lake[1]
    credits = by_id(tables["credits"])
    assert sorted(credits) == ["862", "8844"]
    assert credits["862"]["cast"] == CAST and credits["8844"]["cast"] == "[]"
    assert sorted(by_id(tables["keywords"])) == ["862"]
    ratings = sorted((r["id"], r["userId"], r["rating"]) for r in tables["ratings"].collect())
    assert ratings == [("862", "1", 4.0), ("862", "2", 2.0), ("8844", "5", 0.5)]
    assert {"movieId", "imdbId", "tmdbId"} <= set(tables["ratings"].columns)
    assert tables.counts == {"movies": (15, 7), "credits": (4, 2), "keywords": (2, 1), "ratings": (7, 3)}
    for name, (rows_in, rows_out) in tables.counts.items():
        assert sum(tables.dropped[name].values()) == rows_in - rows_out
    assert list(tables.dropped["movies"]) == ["missing_key", "bad_date", "blank_title", "same_id", "near_duplicate"]


def test_counts_of_a_table_of_orphans(spark, tmp_path):
    bronze = bronze_folder(tmp_path / "bronze", ("movies",))
    write(tmp_path / "bronze" / schemas.KEYWORDS_FILE, schemas.BRONZE_KEYWORDS, [{"id": "-5", "keywords": "[]"}] * 3)
    tables = silver.bronze_to_silver(spark, bronze, str(tmp_path / "silver"))
    assert tables.counts["keywords"] == (3, 0)
    assert tables.dropped["keywords"] == {"missing_key": 0, "orphan": 3, "same_id": 0}


def test_gold(lake):
    wide = lake[2]
    assert wide.columns == schemas.GOLD_COLUMNS
    g = by_id(wide)
    toy = g["862"]
    assert toy["genre_list"] == ["Animation", "Comedy"]
    assert toy["keyword_list"] == ["boy's toy"]
    assert (toy["director"], toy["top_cast"]) == ("John", ["Tom", "Tim", "Don", "Jim", "Wal"])
    assert (toy["avg_rating"], toy["rating_count"]) == (3.0, 2)
    assert toy["combined_text"] == (
        "Toy Story Led by Woody, Andy's toys John Tom Tim Don Jim Wal boy's toy Animation Comedy"
    )
    bare = g["524"]
    assert (bare["genre_list"], bare["keyword_list"], bare["top_cast"]) == ([], [], [])
    assert (bare["director"], bare["avg_rating"], bare["rating_count"]) == (None, None, 0)
    assert bare["combined_text"] == "Casino"
    assert dict(wide.dtypes)["avg_rating"] == "double" and dict(wide.dtypes)["rating_count"] == "bigint"


def test_director_by_containment(spark, lake):
    root, tables, _ = lake
    wide = gold.enrich_movies(tables["movies"], tables["credits"], None, None, "contains")
    assert by_id(wide)["862"]["director"] == "Sharon"


def test_reruns_are_identical(spark, lake, tmp_path):
    root, tables, wide = lake
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = silver.bronze_to_silver(spark, str(root / "bronze"), str(tmp_path / "silver"))
        wide_again = gold.silver_to_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for name, df in {**tables, "gold": wide}.items():
        other = {**again, "gold": wide_again}[name]
        assert df.exceptAll(other).count() == 0 and other.exceptAll(df).count() == 0


@pytest.mark.parametrize("present", [("movies",), ("movies", "ratings"), ("movies", "keywords", "credits")])
def test_absent_inputs(spark, tmp_path, present):
    bronze = bronze_folder(tmp_path / "bronze", present)
    tables = silver.bronze_to_silver(spark, bronze, str(tmp_path / "silver"))
    assert sorted(tables) == sorted(present)
    wide = gold.silver_to_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"))
    assert wide.columns == schemas.GOLD_COLUMNS
    assert wide.count() == tables["movies"].count()
    assert dict(wide.dtypes)["rating_count"] == "bigint"
    assert wide.where("rating_count <> 0 or avg_rating is not null").count() == 0


def test_movies_are_required(spark, tmp_path):
    assert silver.bronze_to_silver(spark, str(tmp_path), str(tmp_path / "silver")) == {}
    with pytest.raises(AnalysisException):
        gold.silver_to_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"))


def test_documents(spark, lake, tmp_path):
    root, _, wide = lake
    docs = documents.build_documents(wide)
    assert docs.columns == schemas.DOCUMENT_COLUMNS
    d = {r["tmdb_id"]: r.asDict() for r in docs.collect()}
    assert d["862"]["release_date"] == "1995-10-30T00:00:00Z"
    assert d["900"]["release_date"] is None and d["900"]["avg_rating"] is None
    assert (d["524"]["overview"], d["524"]["director"], d["524"]["rating_count"]) == ("", "", 0)
    assert sorted(r["tmdb_id"] for r in documents.build_documents(wide, True).collect()) == ["194", "862"]
    target = str(tmp_path / "docs")
    for _ in range(2):
        report = documents.gold_to_documents(spark, str(root / "gold"), target).first()
        assert tuple(report) == (7, 7, 0, 0, 0)
    read = spark.read.schema(docs.schema).json(target)
    assert read.exceptAll(docs).count() == 0 and read.count() == 7
    with pytest.raises(ValueError):
        documents.gold_to_documents(spark, str(root / "gold"))


DOCUMENT_DDL = (
    "tmdb_id string, title string, release_date string, overview string, tagline string, "
    "genre_list array<string>, keyword_list array<string>, director string, "
    "top_cast array<string>, avg_rating double, rating_count bigint, combined_text string"
)


def test_documents_with_vectors(spark, lake, tmp_path):
    def load():
        import numpy

        return lambda texts: numpy.array([[len(t), t.count("o"), 1.0] for t in texts])

    target = str(tmp_path / "docs")
    documents.gold_to_documents(spark, str(lake[0] / "gold"), target, load_encoder=load)
    docs = spark.read.schema("title string, combined_text string, vector array<float>").json(target)
    query = docs.where("title = 'Casino'").first()["vector"]
    assert query == [6.0, 1.0, 1.0]
    whole = spark.read.schema(f"{DOCUMENT_DDL}, vector array<float>").json(target)
    with pytest.raises(ValueError):
        documents.search_documents(whole, "Casino", load, 3, "year")
    found = documents.search_documents(whole, "Casino", load, 1).first()
    assert found["title"] == "Casino"
    john = documents.search_documents(whole, "john", load, field="director").collect()
    assert [r["title"] for r in john] == ["Toy Story"]
    best = search.nearest(docs, "title", "vector", query, 1).first()
    assert (best["title"], best["score"]) == ("Casino", 1.0)


def test_search(lake, tmp_path):
    wide = lake[2]
    index = term_index.index_terms(wide, "combined_text", "id", str(tmp_path))
    cards = documents.search_gold(wide, "a shy waitress", 3, index=index).orderBy("rank").collect()
    assert cards[0]["title"] == "Amélie" and cards[0]["director"] == "Unknown director"
    john = documents.search_gold(wide, "John", field="director", index=index).collect()
    assert [(r["title"], r["rating"]) for r in john] == [("Toy Story", "3.00 (2 ratings)")]
    year = documents.search_gold(wide, "1995", field="year", index=index)
    assert sorted(r["title"] for r in year.collect()) == ["Casino", "GoldenEye", "Jumanji", "Toy Story"]
    for query, field in [("", None), ("soon", "year"), ("x", "studio")]:
        with pytest.raises(ValueError):
            documents.search_gold(wide, query, field=field, index=index)


def test_gold_joins_add_no_exchange(spark, lake):
    """All sides hash by id: one exchange each for movies, credits, keywords, ratings."""
    root, tables, _ = lake
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = gold.enrich_movies(
            tables["movies"], tables["credits"], tables["keywords"], tables["ratings"]
        )
        text = plan_of(wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(id") == text.count("Exchange") == 4
    assert "Python" not in text and "Pandas" not in text
    assert text.count("SortMergeJoin") == 3


def test_policies(spark):
    df = spark.createDataFrame(
        [("1", "é Foo.", None, None, "[{'name': 'x'}"), ("2", "Foo", None, None, None)],
        "id string, title string, overview string, release_date string, genres string",
    )
    policy = silver.CleaningPolicy(repair_mojibake=False, strip_non_ascii=True, repair_lists=False)
    m = by_id(silver.clean_movies(df, policy))
    assert m["1"]["title"] == "Foo." and m["1"]["genres"] == "[]"
    dated = df.withColumn("release_date", F.lit("1995-10-30"))
    merged = silver.CleaningPolicy(strip_non_ascii=True, ignore_punctuation=True)
    assert sorted(by_id(silver.clean_movies(dated, merged))) == ["1"]
