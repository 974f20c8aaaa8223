"""Bronze to silver again, reading only the input files that are new.

The rules that look at one row, and those that keep one row of each key, do not care in how many
runs the rows come: the best of old and new rows is the best of the old ones' best and the new. Their
results are staged per table, in folders by key. A run

1. lists the input files and compares them with the manifest of the last run,
2. reads the new files alone, and merges their rows into the folders that hold their keys, which
   are overwritten as a whole (dynamic partition overwrite), others stay,
3. derives the silver tables whose staged rows have changed: near duplicates, orphans and mapped ids
   depend on the other rows and tables, but need no list or date to be parsed again,
4. enters each step in the manifest when it is done, and takes a table out of it before its folders
   are overwritten.

So a run that failed is taken up by the next one: a table whose merge broke off starts anew, the others
need not. A file that was changed or removed makes its table start anew, too. Tables whose input is gone
are no longer derived; their last silver files stay.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.operators import dedup, joins
from gildmill.plans import schemas as S
from gildmill.plans import silver as rules
from gildmill.sources.readers import read_csv, spread_files
from gildmill.sources.writers import COMPRESSION, materialized, path_exists, write_table

BUCKETS = 64
_BUCKET = "_bucket"
_PART = "_part"
# In the manifest, with a table's name, while that silver table fits the staged ones.
_DERIVED = "derived "
# The silver tables that a staged one goes into.
_GOES_INTO = {
    "movies": ("movies", "credits", "keywords"),
    "credits": ("credits",),
    "keywords": ("keywords",),
    "ratings": ("ratings",),
    "links": ("ratings",),
}
_MANIFEST = "tab string, path string, size bigint, changed bigint"


@dataclass(frozen=True)
class _Input:
    """How a table's rows come in: its files, what is done by row, and the best row of a key."""

    files: str
    schema: object
    required: list[str]
    multi_line: bool
    by_row: Callable[[DataFrame], DataFrame]
    key: str
    best: Callable[..., DataFrame] | None  # None: all rows that differ


def _inputs(policy: rules.CleaningPolicy) -> dict[str, _Input]:
    def child(files, schema, lists):
        by_row = lambda df: rules.repaired_child(df, "id", lists, policy)
        return _Input(files, schema, ["id"], True, by_row, "id", lambda df, within: rules.one_child_per_key(df, "id", lists, within))

    return {
        "movies": _Input(
            S.MOVIES_FILE, S.BRONZE_MOVIES, ["id", "title"], True,
            lambda df: rules.repaired_movies(df, policy), "id", rules.one_movie_per_id,
        ),
        "credits": child(S.CREDITS_FILE, S.BRONZE_CREDITS, ["cast", "crew"]),
        "keywords": child(S.KEYWORDS_FILE, S.BRONZE_KEYWORDS, ["keywords"]),
        "ratings": _Input(
            S.RATINGS_FILE, S.BRONZE_RATINGS, ["userId", "movieId", "rating"], False,
            rules.repaired_ratings, "movieId", None,
        ),
        "links": _Input(
            S.LINKS_FILE, S.BRONZE_LINKS, ["movieId", "tmdbId"], False,
            rules.clean_links, "movieId", None,
        ),
    }


def input_files(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of the files that a path, folder or glob names, in order.

    Files whose names begin with a dot or an underscore are none, as for Spark's readers.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, waiting = [], list(fs.globStatus(path) or [])
    while waiting:
        status = waiting.pop()
        name = status.getPath().getName()
        if name.startswith((".", "_")):
            continue
        if status.isDirectory():
            waiting += list(fs.listStatus(status.getPath()))
        else:
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def _known(spark: SparkSession, state: str) -> dict[str, set[tuple[str, int, int]]]:
    known: dict[str, set[tuple[str, int, int]]] = {}
    if not path_exists(spark, f"{state}/manifest"):
        return known
    for r in spark.read.schema(_MANIFEST).parquet(f"{state}/manifest").collect():
        known.setdefault(r["tab"], set()).add((r["path"], r["size"], r["changed"]))
    return known


def _stage(spark: SparkSession, path: str, spec: _Input, files: list[str], anew: bool, buckets: int) -> None:
    """Merge the rows of some files, which have one header, into the staged table."""
    raw = read_csv(spark, [files], spec.schema, spec.multi_line, required=spec.required)
    rows = spec.by_row(spread_files(raw) if spec.multi_line else raw)
    bucket = F.pmod(F.xxhash64(spec.key), F.lit(buckets)).cast("int")
    fresh = rows.withColumn(_BUCKET, bucket)
    if anew:  # nothing to merge with, so the rows go straight to their folders
        _write_best(fresh, path, spec, "static")
        return
    with materialized(fresh, "fresh") as fresh:
        touched = [r[0] for r in fresh.select(_BUCKET).distinct().collect()]  # ``buckets`` at most
        old = spark.read.schema(fresh.schema).parquet(path).where(F.col(_BUCKET).isin(touched))
        _write_best(fresh.unionByName(old), path, spec, "dynamic")


def _write_best(rows: DataFrame, path: str, spec: _Input, mode: str) -> None:
    """The best row of each key, in folders by bucket, of which four tasks each write a part.

    Rows of one key are divided as they are written, so they move once.
    """
    if spec.best is None:
        best = dedup.distinct_rows(rows)
        divided = best.repartition(_BUCKET, F.xxhash64(*best.columns) % 4)
    else:
        part = F.pmod(F.hash(spec.key), F.lit(4))
        divided = spec.best(rows.withColumn(_PART, part).repartition(_BUCKET, _PART), (_BUCKET, _PART)).drop(_PART)
    writer = divided.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.option("compression", COMPRESSION).partitionBy(_BUCKET).parquet(path)


def update_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    state: str,
    policy: rules.CleaningPolicy = rules.DEFAULT_POLICY,
    buckets: int = BUCKETS,
) -> dict[str, list[str]]:
    """Bring the silver tables up to date; returns the files that were read, by table.

    The tables equal those of ``bronze_to_silver`` over all files. ``state`` is a folder of this
    job's own; ``policy`` and ``buckets`` stay the same from run to run.
    """
    bronze, silver, state = (p.rstrip("/") for p in (bronze, silver, state))
    known, read = _known(spark, state), {}
    done, staged = dict(known), {}

    def write_manifest() -> None:
        rows = [(name, *f) for name, files in done.items() for f in sorted(files)]
        write_table(spark.createDataFrame(rows, _MANIFEST), f"{state}/manifest")

    for name, spec in _inputs(policy).items():
        present = input_files(spark, f"{bronze}/{spec.files}")
        before = known.get(name, set())
        anew = not before or not before <= set(present)
        new = [f[0] for f in present if anew or f not in before]
        path = f"{state}/{name}"
        if new or (before and not present):
            done.pop(name, None)
            for table in _GOES_INTO[name]:
                done.pop(_DERIVED + table, None)
            write_manifest()
        if new:
            _stage(spark, path, spec, new, anew, buckets)
            read[name], done[name] = new, set(present)
            write_manifest()
        if present:
            staged[name] = spark.read.parquet(path).drop(_BUCKET)
    stale = [t for t in ("movies", "credits", "keywords", "ratings") if _DERIVED + t not in done]
    if stale:
        _derive(spark, staged, silver, policy, stale)
        done |= {_DERIVED + table: {("", 0, 0)} for table in stale}
        write_manifest()
    return read


def _derive(
    spark: SparkSession, staged: dict[str, DataFrame], silver: str, policy: rules.CleaningPolicy, stale: list[str]
) -> None:
    """The rules that look at other rows and tables, for the tables whose staged rows have changed."""
    movies = None
    if "movies" in staged:
        if "movies" in stale:
            write_table(rules.one_movie_per_title(staged["movies"], policy), f"{silver}/{S.MOVIES_TABLE}")
        movies = spark.read.parquet(f"{silver}/{S.MOVIES_TABLE}")
    for name, table in (("credits", S.CREDITS_TABLE), ("keywords", S.KEYWORDS_TABLE)):
        if name in staged and name in stale:
            rows = staged[name]
            write_table(rows if movies is None else joins.drop_orphans(rows, movies, "id"), f"{silver}/{table}")
    if "ratings" in staged and "ratings" in stale:
        if "links" in staged:
            linked = joins.map_keys(staged["ratings"], staged["links"], "movieId", "tmdbId", "id")
        else:
            linked = rules.linked_ratings(staged["ratings"], None)
        write_table(linked, f"{silver}/{S.RATINGS_TABLE}")
