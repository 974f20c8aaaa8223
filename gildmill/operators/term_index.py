"""An exact TF-IDF index in files, of which a search reads only what can still matter.

Postings carry their impact, the part of a document's score that does not depend on the query:
tf * idf / length of the document. They lie in buckets by term, and within a term in levels of
falling impact (four to a halving). The terms' own table holds each level's largest impact and its
number of postings. A search

1. fetches the query's terms, by literal names from their buckets,
2. reads some of each term's first levels and scores the documents found there exactly: the k-th
   score is a threshold,
3. deepens the levels until a document that appears in none of them must stay below the threshold,
4. reads those levels, drops documents whose bound stays below it, and scores the rest exactly.

The number of buckets follows the number of postings, so a bucket's size does not grow with the
corpus, and a search names the folders it reads instead of listing them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gildmill.functions.text import stepwise
from gildmill.operators.joins import BROADCAST_LIMIT_BYTES
from gildmill.operators.search import DEFAULT_LIMIT, SCORE_DIGITS, top_k
from gildmill.sources.writers import path_exists, write_table

WORD_BREAK = r"[^\p{L}\p{M}\p{N}]+"
LEVELS = 64
LEVELS_PER_HALVING = 4
BUCKET_POSTINGS = 1 << 21
LEAST_BUCKETS = 32
OPENED = 64
LITERAL_IDS = 2000
CHEAP_LEVEL = 50_000
# Scores are rounded before they are ranked; a bound must clear the threshold by more than that.
MARGIN = 2.0 * 10.0**-SCORE_DIGITS


def checked_query(query: str) -> str:
    if query is None or not query.strip():
        raise ValueError("a search query needs some text")
    return query


def terms_of(c: Column) -> Column:
    """All words of a text in lower case, in order; null for a null text."""
    return F.filter(F.split(F.lower(c), WORD_BREAK), lambda t: t != "")


def counted_terms(words: Column) -> Column:
    """Each distinct word of a list once, in order, with its number, as array<struct<term, tf>>."""
    return stepwise(
        F.sort_array(words),
        "s -> named_struct('s', s, 'at', if(size(s) = 0, array(),"
        " filter(sequence(0, size(s) - 1), i -> i = 0 or s[i] <> s[i - 1])))",
        "x -> transform(x.at, (i, j) -> named_struct('term', x.s[i],"
        " 'tf', cast(coalesce(get(x.at, j + 1), size(x.s)) - i as int)))",
    )


def bucket_of(c: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class TermIndex:
    """A written index: tables ``terms``, ``postings`` and ``docs`` in buckets below ``path``."""

    spark: SparkSession = field(repr=False)
    path: str
    id_col: str
    id_type: T.DataType
    documents: int
    buckets: int
    opened: dict = field(default_factory=dict, repr=False, compare=False)

    def schema(self, table: str) -> T.StructType:
        level = "array<struct<level: int, top: double, n: bigint>>"
        kind = self.id_type.simpleString()
        columns = {
            "terms": f"term string, idf double, levels {level}",
            "postings": f"term string, level int, id {kind}, impact double",
            "docs": f"id {kind}, norm double, entries array<struct<term: string, tf: int>>",
        }
        return T.StructType.fromDDL(columns[table])

    def read(self, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """All of a table, or the named buckets of it: other folders are not even listed.

        What was opened stays so, files listed, for the next search.
        """
        wanted = tuple(range(self.buckets) if buckets is None else sorted(set(buckets)))
        if (table, wanted) not in self.opened:
            folders = [f"{self.path}/{table}/bucket={b}" for b in wanted]
            paths = [p for p in folders if path_exists(self.spark, p)]
            read = self.spark.read.schema(self.schema(table))
            if len(self.opened) >= OPENED:
                self.opened.clear()
            none = self.spark.createDataFrame([], self.schema(table))
            self.opened[table, wanted] = read.parquet(*paths) if paths else none
        return self.opened[table, wanted]


def _write_buckets(df: DataFrame, path: str, *order: str) -> None:
    df.sortWithinPartitions("bucket", *order).write.mode("overwrite").partitionBy("bucket").parquet(path)


def _least_common(frequency: DataFrame, limit: int) -> int:
    """The least power of two for which the terms of so many documents have ``limit`` bytes at most."""
    size = F.octet_length("term") + 64
    by_size = frequency.groupBy(F.floor(F.log2("df")).cast("int").alias("power")).agg(F.sum(size).alias("bytes"))
    least, held = 62, 0
    for r in sorted(by_size.collect(), reverse=True):  # 62 rows at most
        held += r["bytes"]
        if held > limit:
            break
        least = r["power"]
    return 1 << least


def _weighted(entries: DataFrame, weights: DataFrame, common: int) -> DataFrame:
    """Entries with their terms' weights, of which those in ``common`` documents or more are broadcast.

    Most entries are of such terms, so few are shuffled however many terms there are.
    """
    known = F.broadcast(weights.where(F.col("df") >= common))
    near = entries.join(known, "term")
    if common == 1:
        return near
    rare = entries.join(known.select("term"), "term", "left_anti")
    return near.unionByName(rare.join(weights.where(F.col("df") < common), "term"))


def index_terms(
    df: DataFrame, text_col: str, id_col: str, path: str, bucket_postings: int = BUCKET_POSTINGS
) -> TermIndex:
    """Count the terms of every text by name and write the index.

    Ids must be unique; null texts are left out. Terms are counted within each row, without a
    shuffle, and stay in their rows: documents go whole to their buckets, where they meet their
    lengths. The weights of common terms are broadcast, as many as fit; only postings of rarer terms
    are shuffled to meet theirs. All go to their buckets by one exchange. A term with more postings than a bucket should hold is written by several tasks.
    """
    path, spark = path.rstrip("/"), df.sparkSession
    texts = df.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    counted = texts.select(F.col(id_col).alias("id"), counted_terms(terms_of(F.col(text_col))).alias("entries"))
    write_table(counted, f"{path}/counts")
    counts = spark.read.schema(counted.schema).parquet(f"{path}/counts")

    entries = counts.select("id", F.inline("entries"))
    frequency = entries.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    write_table(frequency, f"{path}/frequencies")
    frequency = spark.read.schema(frequency.schema).parquet(f"{path}/frequencies")
    n, postings = counts.count(), frequency.agg(F.sum("df")).first()[0] or 0
    buckets = LEAST_BUCKETS
    while buckets * bucket_postings < postings:
        buckets *= 2

    idf = F.log((F.lit(n) + 1.0) / (F.col("df") + 1.0))
    weights = frequency.select("term", "df", idf.alias("idf"), F.ceil(F.col("df") / bucket_postings).alias("pieces"))
    common = _least_common(frequency, BROADCAST_LIMIT_BYTES)
    square = F.col("tf") * F.col("idf") * F.col("tf") * F.col("idf")
    # Map tasks add up a document's terms, which lie together: one small row each is shuffled.
    squares = _weighted(entries, weights, common).groupBy("id").agg(F.sum(square).alias("square"))
    none = F.lit(None).cast(counts.schema["entries"].dataType)
    parts = counts.where(F.size("entries") > 0).select("id", "entries", F.lit(None).cast("double").alias("square"))
    parts = parts.unionByName(squares.select("id", none.alias("entries"), "square"))
    bucketed = parts.withColumn("bucket", bucket_of(F.col("id"), buckets)).repartition("bucket")
    together = bucketed.groupBy("bucket", "id").agg(
        F.sqrt(F.max("square")).alias("norm"), F.flatten(F.collect_list("entries")).alias("entries")
    )
    _write_buckets(together, f"{path}/docs", "id")
    wordless = counts.where(F.size("entries") == 0).select(
        bucket_of(F.col("id"), buckets).alias("bucket"),
        "id",
        F.lit(0.0).alias("norm"),
        F.array().cast(together.schema["entries"].dataType).alias("entries"),
    )
    wordless.write.mode("append").partitionBy("bucket").parquet(f"{path}/docs")
    size = spark.range(1).select(
        F.lit(n).cast("long").alias("n"), F.lit(buckets).alias("buckets"), F.lit(None).cast(df.schema[id_col].dataType).alias("id")
    )
    write_table(size, f"{path}/size")

    stored = T.StructType([together.schema[c] for c in ("id", "norm", "entries")])
    hits = spark.read.schema(stored).parquet(f"{path}/docs").where("norm > 0").select("id", "norm", F.inline("entries"))
    hits = _weighted(hits, weights, common).where(F.col("idf") > 0)
    placed = hits.withColumn("impact", F.col("tf") * F.col("idf") / F.col("norm")).select(
        bucket_of(F.col("term"), buckets).alias("bucket"),
        "term",
        "id",
        "impact",
        F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece"),
    )
    level = F.floor(F.log2("impact") * F.lit(-LEVELS_PER_HALVING))
    level = F.greatest(F.lit(0), F.least(F.lit(LEVELS - 1), level)).cast("int")
    divided = placed.repartition("bucket", "piece").drop("piece").withColumn("level", level)
    _write_buckets(divided, f"{path}/postings", "term", "level")

    index = read_index(spark, path, id_col)
    shape = T.StructType([*index.schema("postings"), T.StructField("bucket", T.IntegerType())])
    by_level = spark.read.schema(shape).parquet(f"{path}/postings").groupBy("term", "level")
    tops = by_level.agg(F.max("impact").alias("top"), F.count(F.lit(1)).alias("n"))
    levels = tops.groupBy("term").agg(F.sort_array(F.collect_list(F.struct("level", "top", "n"))).alias("levels"))
    # LEVELS entries at most; words of every document have none
    none = F.array().cast(levels.schema["levels"].dataType)
    listed = weights.join(levels, "term", "left").select(
        bucket_of(F.col("term"), buckets).alias("bucket"), "term", "idf", F.coalesce("levels", none).alias("levels")
    )
    _write_buckets(listed.repartition("bucket"), f"{path}/terms", "term")
    return index


def read_index(spark: SparkSession, path: str, id_col: str) -> TermIndex:
    """The index that ``index_terms`` wrote."""
    path = path.rstrip("/")
    size = spark.read.parquet(f"{path}/size")
    row = size.first()
    return TermIndex(spark, path, id_col, size.schema["id"].dataType, row["n"], row["buckets"])


# ---------------------------------------------------------------- search


@dataclass
class _Term:
    """A query's term: its weight, its levels, and how many of them are read."""

    name: str
    bucket: int
    idf: float
    weight: float
    levels: list
    depth: int = 0

    def bound(self) -> float:
        """What it can add to a document that none of the read levels holds."""
        return self.weight * self.levels[self.depth]["top"] if self.depth < len(self.levels) else 0.0


def _local(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A few rows of the driver's as a local relation, which needs no job to be read."""
    return spark.createDataFrame(pa.table(columns))


def _query_terms(index: TermIndex, query: str) -> tuple[list[_Term], float]:
    """The query's known words, and its length, in which unknown words count."""
    text = _local(index.spark, q=pa.array([checked_query(query)]))
    asked = text.select(F.inline(counted_terms(terms_of(F.col("q")))))
    asked = asked.withColumn("bucket", bucket_of(F.col("term"), index.buckets)).collect()
    if not asked:
        return [], 0.0
    held = index.read("terms", [r["bucket"] for r in asked])
    known = {r["term"]: r for r in held.where(F.col("term").isin([r["term"] for r in asked])).collect()}
    unseen = math.log(index.documents + 1.0)
    terms, square = [], 0.0
    for r in asked:
        found = known.get(r["term"])
        weight = r["tf"] * (found["idf"] if found else unseen)
        square += weight * weight
        if found:
            terms.append(_Term(r["term"], r["bucket"], found["idf"], weight, found["levels"]))
    return terms, square**0.5


def _read_levels(index: TermIndex, terms: list[_Term]) -> DataFrame:
    """(id, term, impact) of the levels that the terms' depths name."""
    by_depth: dict[int, list[str]] = {}
    for t in terms:
        if t.depth:
            by_depth.setdefault(t.levels[t.depth - 1]["level"], []).append(t.name)
    read = index.read("postings", [t.bucket for t in terms if t.depth])
    wanted = F.lit(False)
    for level, names in by_depth.items():
        wanted = wanted | (F.col("term").isin(names) & (F.col("level") <= level))
    # The plain list of all names is what the scan can push down in any case.
    names = [t.name for t in terms if t.depth]
    return read.where(F.col("term").isin(names) & wanted).select("id", "term", "impact")


def _partial_scores(index: TermIndex, terms: list[_Term]) -> DataFrame:
    """(id, score, bound): from the read levels, and with what unread ones can add at most."""
    rest = sum(t.bound() for t in terms)
    known = _local(
        index.spark,
        term=pa.array([t.name for t in terms], pa.string()),
        weight=pa.array([t.weight for t in terms], pa.float64()),
        unread=pa.array([t.bound() for t in terms], pa.float64()),
    )
    hits = _read_levels(index, terms).join(F.broadcast(known), "term")  # the query's own words
    gained = F.col("weight") * F.col("impact")
    return hits.groupBy("id").agg(
        F.sum(gained).alias("score"), (F.sum(gained - F.col("unread")) + F.lit(rest)).alias("bound")
    )


def _exact_scores(index: TermIndex, terms: list[_Term], ids: list) -> DataFrame:
    """(id, score) of the given documents, from their own entries."""
    places = _local(index.spark, id=pa.array(ids, to_arrow_type(index.id_type)))
    buckets = [r[0] for r in places.select(bucket_of(F.col("id"), index.buckets)).collect()]
    return _scored(index, terms, index.read("docs", buckets).where(F.col("id").isin(ids)))


def _scored(index: TermIndex, terms: list[_Term], docs: DataFrame) -> DataFrame:
    known = _local(
        index.spark,
        term=pa.array([t.name for t in terms], pa.string()),
        weight=pa.array([t.idf * t.weight for t in terms], pa.float64()),
    )
    entries = docs.select("id", "norm", F.inline("entries"))
    hits = entries.join(F.broadcast(known), "term")  # the query's own words
    gained = F.sum(F.col("tf") * F.col("weight")) / F.first("norm")
    return hits.where(F.col("norm") > 0).groupBy("id").agg(gained.alias("score"))


def _deepen_first(terms: list[_Term], k: int) -> None:
    """Some of the first levels of each term; none that holds a great many postings."""
    for t in terms:
        seen = 0
        while t.depth < len(t.levels) and seen < 4 * k and t.levels[t.depth]["n"] <= CHEAP_LEVEL:
            seen += t.levels[t.depth]["n"]
            t.depth += 1


def _deepen_to(terms: list[_Term], floor: float) -> None:
    """Read on, where it lowers the bound most per posting, until no unseen document can rank."""
    while True:
        open_terms = [t for t in terms if t.depth < len(t.levels)]
        if not open_terms or sum(t.bound() for t in open_terms) < floor:
            return

        def gain(t: _Term) -> float:
            after = t.levels[t.depth + 1]["top"] * t.weight if t.depth + 1 < len(t.levels) else 0.0
            return (t.bound() - after) / t.levels[t.depth]["n"]

        max(open_terms, key=gain).depth += 1


def search_terms(
    index: TermIndex,
    df: DataFrame,
    query: str,
    k: int = DEFAULT_LIMIT,
    where: Column | None = None,
) -> DataFrame:
    """The ``k`` rows of ``df`` whose indexed texts are most like ``query``.

    Cosine of TF-IDF vectors, exact. Documents without a common word score 0 and fill up what is
    missing to ``k``, least ids first; a query without any word, or only of words that every
    document holds, finds nothing. ``where`` holds before the ranking.
    """
    id_col = index.id_col
    terms, length = _query_terms(index, query)
    if not length:
        return df.limit(0).withColumns({"score": F.lit(0.0), "rank": F.lit(1)})
    allowed = None if where is None else df.where(where).select(F.col(id_col).alias("id"))

    def permitted(found: DataFrame) -> DataFrame:
        return found if allowed is None else found.join(allowed, "id", "left_semi")

    useful = [t for t in terms if t.levels]
    best = _ranked(index, useful, length, k, permitted) if useful else []
    if len(best) < k:
        held = index.read("docs").select("id").where(~F.col("id").isin([i for i, _ in best]))
        rest = permitted(held).orderBy("id").limit(k - len(best)).collect()
        best += [(r["id"], 0.0) for r in rest]
    ids = [i for i, _ in best]
    columns = {id_col: pa.array(ids, to_arrow_type(index.id_type)), "score": pa.array([s for _, s in best], pa.float64())}
    scores = _local(index.spark, **columns)  # k rows at most
    found = df.where(F.col(id_col).isin(ids)).join(F.broadcast(scores), id_col)
    return top_k(found, "score", [id_col], k)


def _ranked(index: TermIndex, terms: list[_Term], length: float, k: int, permitted) -> list[tuple]:
    """The best ``k`` documents with a score above 0."""
    rounded = F.round(F.col("score") / F.lit(length), SCORE_DIGITS).alias("score")

    def best(scored: DataFrame) -> list[tuple]:
        rows = permitted(scored).select("id", rounded).where(F.col("score") > 0)
        return [tuple(r) for r in rows.orderBy(F.desc("score"), "id").limit(k).collect()]

    _deepen_first(terms, k)
    floor = -1.0
    if any(t.depth for t in terms):
        first = permitted(_partial_scores(index, terms)).orderBy(F.desc("score")).limit(4 * k).collect()
        scored = best(_exact_scores(index, terms, [r["id"] for r in first])) if first else []
        if len(scored) == k:
            floor = (scored[-1][1] - MARGIN) * length
    _deepen_to(terms, floor)
    near = permitted(_partial_scores(index, terms).where(F.col("bound") >= floor)).select("id")
    ids = [r["id"] for r in near.limit(LITERAL_IDS + 1).collect()]
    if len(ids) <= LITERAL_IDS:
        return best(_exact_scores(index, terms, ids)) if ids else []
    return best(_scored(index, terms, index.read("docs").join(near, "id", "left_semi")))
