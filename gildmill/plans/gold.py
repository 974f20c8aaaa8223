"""Silver to gold: one wide enriched row per movie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.functions import nested
from gildmill.functions.text import join_text
from gildmill.operators import aggregates, joins
from gildmill.operators.columns import with_defaults
from gildmill.plans import schemas as S
from gildmill.sources.readers import read_optional_parquet, read_parquet
from gildmill.sources.writers import write_and_read

NAMES = "array<string>"
OPTIONAL_MOVIE_COLUMNS = ["overview", "tagline", "genres"]


def credit_names(
    credits: DataFrame, director_match: str = "equals", exact: bool = False
) -> DataFrame:
    """Top cast and director per credits row, in place of the long list texts."""
    cast = nested.parse_list_text(F.col("cast"), ["name"], exact)
    crew = nested.parse_list_text(F.col("crew"), ["name", "job"], exact)
    return credits.select(
        "id",
        nested.top_names(cast, S.TOP_CAST).alias("top_cast"),
        nested.first_match(crew, S.DIRECTOR, match=director_match).alias("director"),
    )


def keyword_names(keywords: DataFrame, exact: bool = False) -> DataFrame:
    items = nested.parse_list_text(F.col("keywords"), ["name"], exact)
    return keywords.select("id", nested.names_of(items).alias("keyword_list"))


def combined_text():
    names = [F.array_join(c, " ") for c in ("top_cast", "keyword_list", "genre_list")]
    return join_text(
        F.col("title"), F.col("tagline"), F.col("overview"), F.col("director"), *names
    )


def enrich_movies(
    movies: DataFrame,
    credits: DataFrame | None,
    keywords: DataFrame | None,
    ratings: DataFrame | None,
    director_match: str = "equals",
    exact_lists: bool = False,
    sides_are_unique: bool = False,
) -> DataFrame:
    """Join the sides by id and build the search text; the movie row count is kept.

    List texts are parsed before the joins, so only the few names that gold keeps
    are shuffled. Movies, sides and the rating aggregate all hash by id: each is
    shuffled once and the joins add no exchange.
    """
    movies = with_defaults(movies, {c: (None, "string") for c in OPTIONAL_MOVIE_COLUMNS})
    base = movies.select("id", "title", "release_date", "overview", "tagline", "genres")
    if credits is not None:
        credits = credit_names(credits, director_match, exact_lists)
    if keywords is not None:
        keywords = keyword_names(keywords, exact_lists)
    aggregate = None if ratings is None else aggregates.mean_and_count(ratings, "id", "rating")

    df = joins.left_enrich(
        base,
        credits,
        "id",
        {"top_cast": NAMES, "director": "string"},
        side_is_unique=sides_are_unique,
    )
    df = joins.left_enrich(
        df, keywords, "id", {"keyword_list": NAMES}, side_is_unique=sides_are_unique
    )
    df = aggregates.left_join_aggregate(df, aggregate, "id")
    genres = nested.parse_list_text(F.col("genres"), ["name"], exact_lists)
    none = F.array().cast(NAMES)
    df = df.withColumns(
        {
            "genre_list": nested.names_of(genres),
            "keyword_list": F.coalesce("keyword_list", none),
            "top_cast": F.coalesce("top_cast", none),
        }
    )
    return df.withColumn("combined_text", combined_text()).select(*S.GOLD_COLUMNS)


def silver_to_gold(spark: SparkSession, silver: str, gold: str, **options) -> DataFrame:
    """Movies are required; any other table may be absent."""
    silver = silver.rstrip("/")
    enriched = enrich_movies(
        read_parquet(spark, f"{silver}/{S.MOVIES_TABLE}"),
        read_optional_parquet(spark, f"{silver}/{S.CREDITS_TABLE}"),
        read_optional_parquet(spark, f"{silver}/{S.KEYWORDS_TABLE}"),
        read_optional_parquet(spark, f"{silver}/{S.RATINGS_TABLE}"),
        sides_are_unique=True,
        **options,
    )
    return write_and_read(enriched, f"{gold.rstrip('/')}/{S.MOVIES_TABLE}")
