"""File names, columns and types of the input and output tables."""

from __future__ import annotations

from gildmill.sources.readers import text_schema

# Movies may come as several files.
MOVIES_FILE = "movies_metadata*.csv"
CREDITS_FILE = "credits.csv"
KEYWORDS_FILE = "keywords.csv"
RATINGS_FILE = "ratings_small.csv"
LINKS_FILE = "links_small.csv"

MOVIES_TABLE = "movies.parquet"
CREDITS_TABLE = "credits.parquet"
KEYWORDS_TABLE = "keywords.parquet"
RATINGS_TABLE = "ratings.parquet"
DOCUMENTS_TABLE = "documents"

BRONZE_MOVIES = text_schema(
    [
        "id",
        "imdb_id",
        "title",
        "original_title",
        "original_language",
        "overview",
        "tagline",
        "release_date",
        "runtime",
        "budget",
        "revenue",
        "popularity",
        "vote_average",
        "vote_count",
        "genres",
        "production_companies",
        "production_countries",
        "spoken_languages",
        "belongs_to_collection",
        "homepage",
        "poster_path",
        "backdrop_path",
        "status",
        "adult",
        "video",
    ]
)
BRONZE_CREDITS = text_schema(["id", "cast", "crew"])
BRONZE_KEYWORDS = text_schema(["id", "keywords"])
BRONZE_RATINGS = text_schema(["userId", "movieId", "rating", "timestamp"])
BRONZE_LINKS = text_schema(["movieId", "imdbId", "tmdbId"])

GOLD_COLUMNS = [
    "id",
    "title",
    "release_date",
    "overview",
    "tagline",
    "genre_list",
    "keyword_list",
    "director",
    "top_cast",
    "avg_rating",
    "rating_count",
    "combined_text",
]

DOCUMENT_COLUMNS = ["tmdb_id", *GOLD_COLUMNS[1:]]

FIRST_YEAR, LAST_YEAR = 1900, 2030
LOW_RATING, HIGH_RATING = 0.5, 5.0
TOP_CAST = 5
DIRECTOR = "director"
