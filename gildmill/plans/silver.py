"""Bronze to silver: tolerant cleaning, deterministic dedup, orphan removal."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.functions import nested, parsing, text
from gildmill.operators import dedup, filters, joins
from gildmill.operators.columns import rewrite_present
from gildmill.operators.metrics import RowCounts, uncounted
from gildmill.plans import schemas as S
from gildmill.sources.readers import read_optional_csv, spread_files
from gildmill.sources.writers import write_and_read

MOVIE_TEXT = ["title", "overview", "tagline"]
MOVIE_AMOUNTS = ["budget", "revenue"]
LOST_KEYS = {"imdbId": "string", "tmdbId": "string", "id": "string"}


@dataclass(frozen=True)
class CleaningPolicy:
    """What the catalogue of corruptions leaves open."""

    repair_mojibake: bool = True
    strip_non_ascii: bool = False
    repair_lists: bool = True
    ignore_punctuation: bool = False
    longest_runtime: float = 1440.0


DEFAULT_POLICY = CleaningPolicy()


def _list_text(c, policy: CleaningPolicy):
    return nested.repair_list_text(c) if policy.repair_lists else nested.validate_list_text(c)


def repaired_movies(
    df: DataFrame, policy: CleaningPolicy = DEFAULT_POLICY, count=uncounted
) -> DataFrame:
    """Typed, repaired movies, row by row."""
    df = df.withColumn("id", parsing.normalize_id(F.col("id")))
    df = count(filters.require_columns(df, ["id", "title"]), "missing_key")
    df = df.withColumn("release_date", parsing.parse_date(F.col("release_date")))
    df = df.where(filters.years_or_null(F.col("release_date"), S.FIRST_YEAR, S.LAST_YEAR))
    df = count(df, "bad_date")
    df = rewrite_present(
        df, MOVIE_TEXT, lambda c: text.clean_text(c, policy.repair_mojibake, policy.strip_non_ascii)
    )
    df = count(df.where(filters.non_blank(["title"])), "blank_title")
    df = rewrite_present(
        df, MOVIE_AMOUNTS, lambda c: parsing.parse_currency_intl(c, default=0.0, minimum=0.0)
    )
    df = rewrite_present(
        df,
        ["runtime"],
        lambda c: parsing.plausible(
            parsing.positive_or_null(c), 0.0, policy.longest_runtime
        ).cast("float"),
    )
    return rewrite_present(df, ["genres"], lambda c: _list_text(c, policy))


def one_movie_per_id(df: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Of several rows for one id the fullest, then the least by all columns.

    ``within``: columns that follow from the id, by which the rows are divided already.
    """
    return dedup.first_per_key(df, [*within, "id"], dedup.fullest_first(df))


def one_movie_per_title(df: DataFrame, policy: CleaningPolicy = DEFAULT_POLICY) -> DataFrame:
    """One row per folded title and date, from one row per id."""
    return dedup.near_duplicates_removed(
        df,
        "title",
        ["release_date"],
        ["id"],
        dedup.fullest_first(df, ["id"]),
        text.fold_key_no_punctuation if policy.ignore_punctuation else text.fold_key,
    )


def clean_movies(
    df: DataFrame, policy: CleaningPolicy = DEFAULT_POLICY, count=uncounted
) -> DataFrame:
    """Typed, repaired movies: one row per id and per title and date.

    Equal rows need no step of their own: both reductions order by all columns, so
    equal rows share their group and one of them is kept. Of several rows for one id
    the fullest is kept, and only then near duplicates leave: a row that goes for its
    title never takes along the last row of another. ``count`` sees the rows that each
    rule leaves.
    """
    df = count(one_movie_per_id(repaired_movies(df, policy, count)), "same_id")
    return count(one_movie_per_title(df, policy), "near_duplicate")


def repaired_child(
    df: DataFrame, key: str, lists: list[str], policy: CleaningPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Credits or keywords, row by row: text key, valid list text."""
    df = df.withColumn(key, parsing.normalize_id(F.col(key)))
    df = filters.require_columns(df, [key])
    return rewrite_present(df, lists, lambda c: _list_text(c, policy))


def one_child_per_key(df: DataFrame, key: str, lists: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """Of several rows for a key the one with the longest list text.

    So an emptied copy does not displace a filled one. ``within`` as for movies.
    """
    filled = [F.length(c).desc() for c in lists]
    return dedup.first_per_key(df, [*within, key], [*filled, *dedup.total_order(df)])


def clean_child(
    df: DataFrame, key: str, lists: list[str], policy: CleaningPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Credits or keywords: text key, valid list text, one row per key."""
    return one_child_per_key(repaired_child(df, key, lists, policy), key, lists)


def repaired_facts(
    df: DataFrame, keys: list[str], value: str, low: float, high: float, count=uncounted
) -> DataFrame:
    """Ratings, row by row: text keys, a value in the closed range.

    A value outside the range becomes null and leaves with the null test, which
    names the parsed value once; a range test pushed to the scan would parse it
    twice more.
    """
    number = parsing.parse_number(F.col(value)).cast("float")
    cleaned = {k: parsing.normalize_id(F.col(k)) for k in keys}
    df = df.withColumns({**cleaned, value: parsing.plausible(number, low, high)})
    return count(filters.require_columns(df, [*keys, value]), "missing_or_out_of_range")


def clean_facts(
    df: DataFrame, keys: list[str], value: str, low: float, high: float, count=uncounted
) -> DataFrame:
    """Ratings: text keys, a value in the closed range, equal rows once."""
    return count(dedup.distinct_rows(repaired_facts(df, keys, value, low, high, count)), "duplicate")


def clean_links(df: DataFrame) -> DataFrame:
    df = df.withColumns({k: parsing.normalize_id(F.col(k)) for k in ["movieId", "tmdbId"]})
    return filters.require_columns(df, ["movieId", "tmdbId"])


def repaired_ratings(df: DataFrame) -> DataFrame:
    return repaired_facts(df, ["userId", "movieId"], "rating", S.LOW_RATING, S.HIGH_RATING)


def clean_ratings(df: DataFrame, count=uncounted) -> DataFrame:
    return clean_facts(df, ["userId", "movieId"], "rating", S.LOW_RATING, S.HIGH_RATING, count)


def linked_ratings(ratings: DataFrame, links: DataFrame | None) -> DataFrame:
    """Ratings with the mapped id. Without a mapping all ratings stay, with null ids."""
    if links is None:
        return ratings.withColumns({k: F.lit(None).cast(t) for k, t in LOST_KEYS.items()})
    return joins.map_keys(ratings, clean_links(links), "movieId", "tmdbId", "id")


class SilverTables(dict[str, DataFrame]):
    """The written tables by name.

    ``counts`` has (rows read, rows written) of each, ``dropped`` the rows that each rule removed.
    """

    def __init__(self) -> None:
        super().__init__()
        self.counts: dict[str, tuple[int, int]] = {}
        self.dropped: dict[str, dict[str, int]] = {}


def bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    policy: CleaningPolicy = DEFAULT_POLICY,
    write: Callable[[DataFrame, str], DataFrame] = write_and_read,
) -> SilverTables:
    """Read whichever input files exist, write one table each, return them with row counts.

    Movies are written first and read back, so orphan removal sees exactly the
    movies that were kept and the cleaning runs once. Rows are counted while the
    tables are written, before the first and after each rule: no input is read twice for it.
    ``write`` puts a table in its folder and gives it back from there.
    """
    bronze, silver = bronze.rstrip("/"), silver.rstrip("/")
    movies = read_optional_csv(spark, f"{bronze}/{S.MOVIES_FILE}", S.BRONZE_MOVIES, True, ["id", "title"])
    credits = read_optional_csv(spark, f"{bronze}/{S.CREDITS_FILE}", S.BRONZE_CREDITS, True, ["id"])
    keywords = read_optional_csv(spark, f"{bronze}/{S.KEYWORDS_FILE}", S.BRONZE_KEYWORDS, True, ["id"])
    ratings = read_optional_csv(spark, f"{bronze}/{S.RATINGS_FILE}", S.BRONZE_RATINGS, required=["userId", "movieId", "rating"])
    links = read_optional_csv(spark, f"{bronze}/{S.LINKS_FILE}", S.BRONZE_LINKS, required=["movieId", "tmdbId"])

    out = SilverTables()

    def store(name: str, raw: DataFrame, clean, table: str) -> None:
        count = RowCounts()
        out[name] = write(clean(count(raw, "read"), count), f"{silver}/{table}")
        passed = count.passed()
        out.counts[name], out.dropped[name] = (passed[0], passed[-1]), count.dropped()

    def child_cleaner(lists: list[str]):
        def clean(raw: DataFrame, count: RowCounts) -> DataFrame:
            child = spread_files(raw).withColumn("id", parsing.normalize_id(F.col("id")))
            child = count(filters.require_columns(child, ["id"]), "missing_key")
            if "movies" in out:
                # Orphans leave before the dedup shuffle; neither step affects the other.
                child = count(joins.drop_orphans(child, out["movies"], "id"), "orphan")
            return count(clean_child(child, "id", lists, policy), "same_id")

        return clean

    def rating_cleaner(raw: DataFrame, count: RowCounts) -> DataFrame:
        return count(linked_ratings(clean_ratings(raw, count), links), "unmapped")

    if movies is not None:
        store("movies", movies, lambda raw, count: clean_movies(spread_files(raw), policy, count), S.MOVIES_TABLE)
    if credits is not None:
        store("credits", credits, child_cleaner(["cast", "crew"]), S.CREDITS_TABLE)
    if keywords is not None:
        store("keywords", keywords, child_cleaner(["keywords"]), S.KEYWORDS_TABLE)
    if ratings is not None:
        store("ratings", ratings, rating_cleaner, S.RATINGS_TABLE)
    return out
