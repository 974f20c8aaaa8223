"""The composed jobs on messy tables derived from the test tables.

Documents stand in for movies, conversation turns for credits, benchmark items
for keywords, line items for ratings and parts for the id mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.functions import nested
from gildmill.operators import search
from gildmill.plans import bucketed, documents, gold, incremental, schemas, silver
from gildmill.queries.cleaning import crew_text
from gildmill.queries.registry import (
    ORACLES,
    query,
    spread_table,
    sql_flat,
    sql_list_text,
    sql_words,
    table,
    words,
)
from gildmill.queries.storage import write_csv
from gildmill.shipping import ship_package
from gildmill.sources.file_client import FileClient
from gildmill.sources.writers import scratch_path, write_table


def messy_movies(spark: SparkSession, folder: str) -> DataFrame:
    day = F.date_add(F.lit("1990-01-01").cast("date"), F.col("n_chars").cast("int"))
    rendered = (
        F.when(F.col("lang") == "en", F.date_format(day, "M/d/yyyy"))
        .when(F.col("lang") == "fr", F.date_format(day, "dd-MM-yyyy"))
        .when(F.col("lang") == "de", F.date_format(day, "yyyy.MM.dd"))
        .otherwise(F.date_format(day, "MMMM d, yyyy"))
    )
    amount = F.format_number(F.col("n_chars") * 1000, 2)
    genre = nested.to_list_text(F.array("lang", "source"), "{'id': None, 'name': '%s'}")
    return spread_table(spark, folder, "documents", "doc_id").select(
        F.concat(F.lit(" "), F.col("doc_id").cast("string"), F.lit(".0")).alias("id"),
        F.concat_ws(
            "  \t", F.lit(""), F.upper("source"), F.col("lang"), F.col("n_chars").cast("string")
        ).alias("title"),
        F.concat(F.lit("\n "), F.col("text")).alias("overview"),
        F.when(F.col("lang") != "en", F.concat(F.lit(" "), F.col("source"))).alias("tagline"),
        rendered.alias("release_date"),
        F.col("n_chars").cast("string").alias("runtime"),
        F.concat(F.lit("$"), amount).alias("budget"),
        F.concat(F.lit("€"), F.translate(amount, ".,", ",.")).alias("revenue"),
        F.when(F.col("source") != "src7", genre).otherwise(F.regexp_replace(genre, r"^\[|\]$", "")).alias(
            "genres"
        ),
    )


def messy_credits(spark: SparkSession, folder: str) -> DataFrame:
    turns = spread_table(spark, folder, "conversations", "conv_id", "turn")
    return turns.select(
        F.concat(F.col("conv_id").cast("string"), F.lit(".0")).alias("id"),
        nested.to_list_text(words(F.col("text"))).alias("cast"),
        crew_text(F.col("role"), F.col("text")).alias("crew"),
    )


def messy_keywords(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "benchmark")
    return items.select(
        F.col("item_id").cast("string").alias("id"),
        nested.to_list_text(words(F.col("text")), "{'id': 931, 'name': '%s'}").alias("keywords"),
    )


def messy_ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = spread_table(spark, folder, "lineitem", "l_orderkey", "l_linenumber")
    return lines.select(
        F.col("l_suppkey").cast("string").alias("userId"),
        F.col("l_partkey").cast("string").alias("movieId"),
        (F.col("l_quantity") / 10).cast("string").alias("rating"),
        F.unix_date(F.col("l_shipdate").cast("date")).cast("string").alias("timestamp"),
    )


def messy_links(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    return table(spark, folder, "part").select(
        key.alias("movieId"), key.alias("imdbId"), F.concat(key, F.lit(".0")).alias("tmdbId")
    )


_SQL_MOVIES = f"""
m0 AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, upper(source) || ' ' || lang || ' ' || n_chars AS title,
    {sql_flat("text")} AS overview, CASE WHEN lang <> 'en' THEN source END AS tagline,
    DATE '1990-01-01' + CAST(n_chars AS INT) AS release_date,
    CASE WHEN n_chars BETWEEN 1 AND 1440 THEN CAST(n_chars AS DOUBLE) END AS runtime,
    CAST(n_chars * 1000 AS DOUBLE) AS budget, lang, source
  FROM documents),
m1 AS (SELECT *, row_number() OVER (PARTITION BY lower(title), release_date ORDER BY id) AS rn
       FROM m0 WHERE year(release_date) BETWEEN 1900 AND 2030),
movies AS (SELECT * FROM m1 WHERE rn = 1)"""

_SQL_CREW = f"""'[{{''job'': ''Editor'', ''name'': ''Ed''}}, {{''job'': ''Assistant Director'', ''name'': ''' || role
  || '''}}, {{''job'': ''Director'', ''name'': ''' || replace({sql_words("text")}[-1], '''', '\\''')
  || ''', ''id'': None}}]'"""

_SQL_CREDITS = f"""
c0 AS (
  SELECT CAST(conv_id AS VARCHAR) AS id, text, {sql_list_text(sql_words("text"))} AS cast_text,
    {_SQL_CREW} AS crew_text FROM conversations),
c1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY length(cast_text) DESC,
         length(crew_text) DESC, cast_text, crew_text) AS rn FROM c0),
credits AS (SELECT * FROM c1 WHERE rn = 1)"""

_SQL_RATINGS = """
ratings AS (
  SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
    CAST(CAST(l_quantity / 10 AS FLOAT) AS DOUBLE) AS rating, CAST(l_shipdate AS DATE) AS day
  FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity / 10 BETWEEN 0.5 AND 5.0)"""

_MOVIE_COLUMNS = "id, title, overview, tagline, CAST(release_date AS VARCHAR) AS release_date, runtime, budget"


@query(f"""
WITH {_SQL_MOVIES} SELECT {_MOVIE_COLUMNS}, budget AS revenue,
  '[{{''id'': None, ''name'': ''' || lang || '''}}, {{''id'': None, ''name'': ''' || source || '''}}]' AS genres
FROM movies
""")
def clean_entities(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = silver.clean_movies(messy_movies(spark, folder))
    return cleaned.withColumns(
        {
            "release_date": F.col("release_date").cast("string"),
            "runtime": F.col("runtime").cast("double"),
        }
    )


@query(f"WITH {_SQL_CREDITS} SELECT id, cast_text, crew_text FROM credits")
def clean_child(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = silver.clean_child(messy_credits(spark, folder), "id", ["cast", "crew"])
    return cleaned.select("id", F.col("cast").alias("cast_text"), F.col("crew").alias("crew_text"))


@query("""
SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
  round(l_quantity / 10, 4) AS rating, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day
FROM lineitem WHERE l_quantity / 10 BETWEEN 0.5 AND 5.0
""")
def clean_facts(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = silver.clean_ratings(messy_ratings(spark, folder))
    return cleaned.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        F.round(F.col("rating").cast("double"), 4).alias("rating"),
        F.date_from_unix_date(F.col("timestamp").try_cast("int")).cast("string").alias("day"),
    )


_MOVIES = "movies_metadata.csv"
_BRONZE = [
    (_MOVIES, messy_movies, schemas.BRONZE_MOVIES),
    (schemas.CREDITS_FILE, messy_credits, schemas.BRONZE_CREDITS),
    (schemas.KEYWORDS_FILE, messy_keywords, schemas.BRONZE_KEYWORDS),
    (schemas.RATINGS_FILE, messy_ratings, schemas.BRONZE_RATINGS),
    (schemas.LINKS_FILE, messy_links, schemas.BRONZE_LINKS),
]


def _bronze_columns(df: DataFrame, schema) -> DataFrame:
    """All columns of a schema, in an order unlike it."""
    absent = {c: F.lit(None).cast("string") for c in schema.names if c not in df.columns}
    return df.withColumns(absent).select(*sorted(schema.names)[::-1])


def write_bronze(spark: SparkSession, folder: str, *only: str) -> str:
    """The messy tables as CSV files in a new folder, columns unlike any schema's order."""
    bronze = scratch_path(spark, "bronze")
    for name, make, schema in _BRONZE:
        if not only or name in only:
            write_csv(_bronze_columns(make(spark, folder), schema), f"{bronze}/{name}")
    return bronze


@query(f"""
WITH {_SQL_MOVIES}, {_SQL_CREDITS}, {_SQL_RATINGS}
SELECT 'movies' AS tab, id, title AS a, overview AS b, CAST(runtime AS DOUBLE) AS n FROM movies
UNION ALL
SELECT 'credits', id, cast_text, crew_text, NULL FROM credits WHERE id IN (SELECT id FROM movies)
UNION ALL
SELECT 'keywords', CAST(item_id AS VARCHAR),
  {sql_list_text(sql_words("text"), "{'id': 931, 'name': '%s'}")}, NULL, NULL
FROM benchmark WHERE CAST(item_id AS VARCHAR) IN (SELECT id FROM movies)
UNION ALL
SELECT 'ratings', id, user_id, CAST(day AS VARCHAR), round(rating, 4) FROM ratings
""")
def silver_tables(spark: SparkSession, folder: str) -> DataFrame:
    return _silver_rows(
        silver.bronze_to_silver(spark, write_bronze(spark, folder), scratch_path(spark, "silver"))
    )


def _silver_rows(out: dict[str, DataFrame]) -> DataFrame:
    """The tables as one, for comparison."""

    def rows(name: str, a, b, n) -> DataFrame:
        return out[name].select(
            F.lit(name).alias("tab"), "id", a.alias("a"), b.alias("b"), n.cast("double").alias("n")
        )

    none = F.lit(None).cast("string")
    day = F.date_from_unix_date(F.col("timestamp").try_cast("int")).cast("string")
    return (
        rows("movies", F.col("title"), F.col("overview"), F.col("runtime"))
        .unionByName(rows("credits", F.col("cast"), F.col("crew"), none))
        .unionByName(rows("keywords", F.col("keywords"), none, none))
        .unionByName(rows("ratings", F.col("userId"), day, F.round(F.col("rating").cast("double"), 4)))
    )


@query(f"""
WITH {_SQL_MOVIES}, {_SQL_CREDITS}, {_SQL_RATINGS}
SELECT 'movies' AS tab, (SELECT count(*) FROM documents) AS rows_in, (SELECT count(*) FROM movies) AS rows_out
UNION ALL
SELECT 'credits', (SELECT count(*) FROM conversations),
  (SELECT count(*) FROM credits WHERE id IN (SELECT id FROM movies))
UNION ALL
SELECT 'keywords', (SELECT count(*) FROM benchmark),
  (SELECT count(DISTINCT item_id) FROM benchmark WHERE CAST(item_id AS VARCHAR) IN (SELECT id FROM movies))
UNION ALL
SELECT 'ratings', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM ratings)
""")
def silver_metrics(spark: SparkSession, folder: str) -> DataFrame:
    out = silver.bronze_to_silver(spark, write_bronze(spark, folder), scratch_path(spark, "silver"))
    rows = [(name, *counts) for name, counts in out.counts.items()]
    return spark.createDataFrame(rows, "tab string, rows_in bigint, rows_out bigint")


@query(f"""
WITH {_SQL_MOVIES}, turns AS (SELECT CAST(conv_id AS VARCHAR) AS id FROM conversations),
items AS (SELECT CAST(item_id AS VARCHAR) AS id FROM benchmark),
lines AS (SELECT l_suppkey, l_partkey, l_quantity, CAST(l_shipdate AS DATE) AS day FROM lineitem
          WHERE l_quantity / 10 BETWEEN 0.5 AND 5.0),
facts AS (SELECT DISTINCT * FROM lines),
known AS (SELECT id FROM movies),
drops AS (
  SELECT 'movies' AS tab, 'missing_key' AS reason, count(*) FILTER (doc_id IS NULL) AS n_rows FROM documents
  UNION ALL
  SELECT 'movies', 'bad_date', count(*) FILTER (year(release_date) NOT BETWEEN 1900 AND 2030) FROM m0
  UNION ALL
  SELECT 'movies', 'blank_title', 0
  UNION ALL
  SELECT 'movies', 'same_id', count(*) - count(DISTINCT id) FROM m1
  UNION ALL
  SELECT 'movies', 'near_duplicate', count(*) FILTER (rn > 1) FROM m1
  UNION ALL
  SELECT 'credits', 'missing_key', count(*) FILTER (id IS NULL) FROM turns
  UNION ALL
  SELECT 'credits', 'orphan', count(*) FILTER (id NOT IN (SELECT id FROM known)) FROM turns
  UNION ALL
  SELECT 'credits', 'same_id', count(*) - count(DISTINCT id) FROM turns WHERE id IN (SELECT id FROM known)
  UNION ALL
  SELECT 'keywords', 'missing_key', count(*) FILTER (id IS NULL) FROM items
  UNION ALL
  SELECT 'keywords', 'orphan', count(*) FILTER (id NOT IN (SELECT id FROM known)) FROM items
  UNION ALL
  SELECT 'keywords', 'same_id', count(*) - count(DISTINCT id) FROM items WHERE id IN (SELECT id FROM known)
  UNION ALL
  SELECT 'ratings', 'missing_or_out_of_range', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM lines)
  UNION ALL
  SELECT 'ratings', 'duplicate', (SELECT count(*) FROM lines) - (SELECT count(*) FROM facts)
  UNION ALL
  SELECT 'ratings', 'unmapped', count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)) FROM facts)
SELECT tab, reason, CAST(n_rows AS BIGINT) AS n_rows FROM drops
""")
def silver_drop_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that each rule of the job removed, counted while it ran."""
    out = silver.bronze_to_silver(spark, write_bronze(spark, folder), scratch_path(spark, "silver"))
    rows = [(tab, reason, n) for tab, dropped in out.dropped.items() for reason, n in dropped.items()]
    return spark.createDataFrame(rows, "tab string, reason string, n_rows bigint")


@query("""
SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
  round(l_quantity / 10, 4) AS rating, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day,
  CAST(NULL AS VARCHAR) AS id
FROM lineitem WHERE l_quantity / 10 BETWEEN 0.5 AND 5.0
""")
def silver_without_links(spark: SparkSession, folder: str) -> DataFrame:
    bronze = write_bronze(spark, folder, schemas.RATINGS_FILE)
    kept = silver.bronze_to_silver(spark, bronze, scratch_path(spark, "silver"))["ratings"]
    return kept.select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("movie_id"),
        F.round(F.col("rating").cast("double"), 4).alias("rating"),
        F.date_from_unix_date(F.col("timestamp").try_cast("int")).cast("string").alias("day"),
        "id",
    )


@query("""
SELECT CAST(2 * doc_id AS VARCHAR) AS id, CASE WHEN lang = 'en' THEN 'First ' ELSE 'Second ' END || doc_id AS title
FROM documents
UNION ALL
SELECT CAST(2 * doc_id + 1 AS VARCHAR), 'Second ' || doc_id FROM documents WHERE lang = 'en'
""")
def clean_entities_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """One id with two titles, and one of these titles under a second id.

    Of the two titles the first stays where both rows are equally full, and then so
    does the second id; elsewhere the second title's row is the fuller one.
    """
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    even, odd = (2 * F.col("doc_id")).cast("string"), (2 * F.col("doc_id") + 1).cast("string")
    extra = F.when(F.col("lang") != "en", F.lit("a tagline"))
    none = F.lit(None).cast("string")

    def row(key: Column, title: str, tagline: Column) -> Column:
        name = F.concat(F.lit(title), F.col("doc_id").cast("string"))
        return F.struct(key.alias("id"), name.alias("title"), tagline.alias("tagline"))

    rows = F.array(row(even, "First ", none), row(even, "Second ", extra), row(odd, "Second ", none))
    messy = docs.select(F.inline(rows)).withColumn("release_date", F.lit("1995-10-30"))
    return silver.clean_movies(messy).select("id", "title")


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    """Gold rows straight from the messy tables, without files between the jobs."""
    movies = silver.clean_movies(messy_movies(spark, folder))
    credits = silver.clean_child(messy_credits(spark, folder), "id", ["cast", "crew"])
    keywords = silver.clean_child(messy_keywords(spark, folder), "id", ["keywords"])
    ratings = silver.linked_ratings(
        silver.clean_ratings(messy_ratings(spark, folder)), messy_links(spark, folder)
    )
    return gold.enrich_movies(movies, credits, keywords, ratings, sides_are_unique=True)


SQL_GOLD = f"""{_SQL_MOVIES}, {_SQL_CREDITS}, {_SQL_RATINGS},
agg AS (SELECT id, avg(rating) AS avg_rating, count(rating) AS rating_count FROM ratings GROUP BY id),
cr AS (SELECT id, list_filter(list_slice({sql_words("text")}, 1, 5), lambda w: w <> '') AS top_cast,
       nullif({sql_words("text")}[-1], '') AS director FROM credits),
kw AS (SELECT CAST(item_id AS VARCHAR) AS id, list_filter({sql_words("text")}, lambda w: w <> '') AS keyword_list
       FROM benchmark),
gold AS (
  SELECT id, title, release_date, overview, tagline, [lang, source] AS genre_list,
    coalesce(keyword_list, []) AS keyword_list, director, coalesce(top_cast, []) AS top_cast,
    avg_rating, coalesce(rating_count, 0) AS rating_count,
    concat_ws(' ', title, tagline, nullif(overview, ''), director, nullif(array_to_string(top_cast, ' '), ''),
      nullif(array_to_string(keyword_list, ' '), ''), lang, source) AS combined_text
  FROM movies LEFT JOIN cr USING (id) LEFT JOIN kw USING (id) LEFT JOIN agg USING (id))"""


def _flat(df: DataFrame) -> DataFrame:
    """Lists as joined text and rounded averages, for comparison."""
    lists = {c: F.array_join(c, "|") for c in ("genre_list", "keyword_list", "top_cast")}
    return df.withColumns(
        {
            **lists,
            "release_date": F.col("release_date").cast("string"),
            "avg_rating": F.round("avg_rating", 6),
        }
    )


_SQL_FLAT_LISTS = """array_to_string(genre_list, '|') AS genre_list, array_to_string(keyword_list, '|') AS keyword_list,
  array_to_string(top_cast, '|') AS top_cast, round(avg_rating, 6) AS avg_rating, rating_count, combined_text"""


@query(f"""
WITH {SQL_GOLD}
SELECT id, title, CAST(release_date AS VARCHAR) AS release_date, overview, tagline, director, {_SQL_FLAT_LISTS}
FROM gold
""")
def gold_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(enriched(spark, folder))


@query(f"""
WITH {SQL_GOLD}
SELECT id AS tmdb_id, title, CAST(release_date AS VARCHAR) || 'T00:00:00Z' AS release_date,
  coalesce(overview, '') AS overview, coalesce(tagline, '') AS tagline, coalesce(director, '') AS director,
  {_SQL_FLAT_LISTS}
FROM gold
""")
def build_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(documents.build_documents(enriched(spark, folder)))


@query(ORACLES["gold_enrich"])
def silver_to_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Both jobs on files: messy CSV to silver, silver to gold."""
    lake = scratch_path(spark, "silver")
    silver.bronze_to_silver(spark, write_bronze(spark, folder), lake)
    return _flat(gold.silver_to_gold(spark, lake, scratch_path(spark, "gold")))


@query(ORACLES["gold_enrich"])
def bronze_to_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Both jobs through silver tables in buckets of the id."""
    lake, target = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    return _flat(bucketed.bronze_to_gold(spark, write_bronze(spark, folder), lake, target))


@query(ORACLES["silver_tables"])
def silver_update(spark: SparkSession, folder: str) -> DataFrame:
    """The silver tables in two runs: the second has one more file of movies."""
    bronze, lake, state = (scratch_path(spark, name) for name in ("bronze", "silver", "state"))
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    movies = _bronze_columns(messy_movies(spark, folder), schemas.BRONZE_MOVIES)
    for name, make, schema in _BRONZE:
        if name != _MOVIES:
            write_csv(_bronze_columns(make(spark, folder), schema), f"{bronze}/{name}")
    for part in (0, 1):
        write_csv(movies.where(half == part), f"{bronze}/movies_metadata_{part}.csv")
        incremental.update_silver(spark, bronze, lake, state)
    out = {
        name: spark.read.parquet(f"{lake}/{path}")
        for name, path in (
            ("movies", schemas.MOVIES_TABLE),
            ("credits", schemas.CREDITS_TABLE),
            ("keywords", schemas.KEYWORDS_TABLE),
            ("ratings", schemas.RATINGS_TABLE),
        )
    }
    return _silver_rows(out)


def _stored_gold(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "gold")
    write_table(enriched(spark, folder), f"{path}/{schemas.MOVIES_TABLE}")
    return path


_SQL_LOADED = ORACLES["build_documents"].replace(
    "SELECT id AS tmdb_id", "SELECT count(*) OVER () AS source_rows, count(*) OVER () AS sink_rows, id AS tmdb_id"
)


@query(_SQL_LOADED)
def gold_to_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The load as JSON files, read back, each row beside the job's own account."""
    path, target = _stored_gold(spark, folder), scratch_path(spark, "documents")
    report = documents.gold_to_documents(spark, path, target).select("source_rows", "sink_rows")
    return _loaded(spark, path, target, report)


@query(_SQL_LOADED)
def document_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The load in batches through a client that writes a file per batch."""
    ship_package(spark)
    path, target = _stored_gold(spark, folder), scratch_path(spark, "collection")
    client = "gildmill.sources.file_client:connect"
    report = documents.gold_to_documents(spark, path, client=client, folder=target)
    return _loaded(spark, path, FileClient({"folder": target}).collection(), report)


def _loaded(spark: SparkSession, gold_path: str, files: str, report: DataFrame) -> DataFrame:
    source = spark.read.parquet(f"{gold_path}/{schemas.MOVIES_TABLE}")
    schema = documents.build_documents(source).schema
    account = report.first().asDict()
    stored = _flat(spark.read.schema(schema).json(files))
    return stored.withColumns({c: F.lit(n) for c, n in account.items()})


@query(f"""
WITH first_turn AS (
  SELECT CAST(conv_id AS VARCHAR) AS id, {sql_flat("text")} AS overview,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)
SELECT CAST(doc_id AS VARCHAR) AS id, overview FROM documents
JOIN first_turn ON id = CAST(doc_id AS VARCHAR) AND rn = 1 WHERE overview <> ''
""")
def embeddable_only(spark: SparkSession, folder: str) -> DataFrame:
    from gildmill.functions.text import clean_text
    from gildmill.operators.joins import left_enrich

    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("id"))
    turns = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), "turn", clean_text(F.col("text")).alias("overview")
    )
    joined = left_enrich(docs, turns, "id", {"overview": "string"}, ["turn"])
    return documents.keep_embeddable(joined)


SQL_CARD = r"""CAST(rank AS INT) AS rank, title, CAST(release_date AS VARCHAR) AS release_date,
  coalesce(director, 'Unknown director') AS director, array_to_string(top_cast, ', ') AS top_cast,
  printf('%.2f', round(avg_rating, 2)) || ' (' || rating_count || ' ratings)' AS rating,
  CASE WHEN overview = '' THEN '(no overview available)' WHEN length(overview) <= 240 THEN overview
    ELSE regexp_extract(overview, '^(.{0,237}) ', 1) || '...' END AS overview"""


@query(f"""
WITH {SQL_GOLD}, best AS (
  SELECT *, row_number() OVER (ORDER BY round(avg_rating, 6) DESC, id) AS rank FROM gold
  WHERE avg_rating IS NOT NULL ORDER BY rank LIMIT 10)
SELECT {SQL_CARD} FROM best
""")
def result_cards(spark: SparkSession, folder: str) -> DataFrame:
    scored = enriched(spark, folder).withColumn("score", F.round("avg_rating", 6))
    hits = search.result_fields(
        search.top_k(scored, "score", ["id"], 10), ["rank", *search.RESULT_FIELDS]
    )
    return search.result_cards(hits)
