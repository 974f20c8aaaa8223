"""Nearest documents by cosine similarity: one query or many, optionally filtered."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gildmill.functions.text import snippet
from gildmill.operators.joins import measured_bytes
from gildmill.sources.writers import scratch_path

DEFAULT_LIMIT = 10
# Scores are rounded before ranking, so equal vectors tie whatever the batch shape.
SCORE_DIGITS = 9
QUERY_BLOCK_BYTES = 32 * 1024 * 1024
# A tile of scores is at most 512 queries by 4096 rows, 16 MB.
_TILE = 512
_ROWS = 4096

# The fields of a search hit, and the text shown for absent ones.
RESULT_FIELDS = [
    "title",
    "release_date",
    "overview",
    "tagline",
    "director",
    "top_cast",
    "avg_rating",
    "rating_count",
]
UNKNOWN_TITLE = "Unknown title"
UNKNOWN_DATE = "Unknown date"
UNKNOWN_DIRECTOR = "Unknown director"
CARD_CAST = 5


def unit_vector(query: Sequence[float]) -> np.ndarray:
    q = np.asarray(query, dtype="float64")
    norm = np.linalg.norm(q)
    if q.ndim != 1 or not np.isfinite(norm) or norm == 0.0:
        raise ValueError("a query vector needs a finite, non-zero length")
    return q / norm


def _unit_rows(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors, and those vectors scaled to length one."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    usable = pc.fill_null(pc.equal(pc.list_value_length(vectors), dim), False)
    rows = np.flatnonzero(usable.to_numpy(zero_copy_only=False))
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype("float64").reshape(len(rows), dim)
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    good = np.isfinite(norms) & (norms > 0)
    return rows[good], matrix[good] / norms[good, None]


def cosine_arrow(c: Column, query: Sequence[float]) -> Column:
    """Cosine by one matrix product per Arrow batch; unusable vectors score null."""
    q = unit_vector(query)

    @F.arrow_udf(T.DoubleType())
    def score(vectors: pa.Array) -> pa.Array:
        rows, unit = _unit_rows(vectors, len(q))
        out = np.full(len(vectors), np.nan)
        out[rows] = unit @ q
        return pa.array(out, from_pandas=True)

    return F.round(score(c), SCORE_DIGITS)


def cosine_native(c: Column, query: Sequence[float]) -> Column:
    """Cosine with array functions: no Python worker, slower per vector."""
    q = F.array(*[F.lit(float(x)) for x in unit_vector(query)])
    dot = F.aggregate(
        F.zip_with(c, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x
    )
    square = F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = (F.size(c) == len(query)) & (square > 0) & ~F.isnan(square)
    return F.when(usable, F.round(dot / F.sqrt(square), SCORE_DIGITS))


def top_k(df: DataFrame, score: str, tie: list[str], k: int = DEFAULT_LIMIT) -> DataFrame:
    """The ``k`` best rows, each task keeping its own ``k``; ``rank`` counts from 1."""
    order = [F.col(score).desc_nulls_last(), *[F.col(t).asc() for t in tie]]
    # Unscored rows sort last and leave after the cut: an earlier filter would be
    # pushed below the score and compute it twice.
    best = df.orderBy(*order).limit(k).where(F.col(score).isNotNull())
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def nearest(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    query: Sequence[float],
    k: int = DEFAULT_LIMIT,
    where: Column | None = None,
    native: bool = False,
) -> DataFrame:
    """Filter first, then rank by similarity. No match gives an empty typed table."""
    if where is not None:
        df = df.where(where)
    cosine = cosine_native if native else cosine_arrow
    scored = df.withColumn("score", cosine(F.col(vector_col), query)).drop(vector_col)
    return top_k(scored, "score", [id_col], k)


class _BestRows:
    """Running best ``k`` rows of every query, over batches of unit vectors."""

    def __init__(self, query_ids: pa.Array, queries: np.ndarray, k: int, schema: pa.Schema):
        self.query_ids, self.queries, self.k, self.schema = query_ids, queries, k, schema
        self.best: dict[int, pa.Table] = {}
        self.floor = np.full(len(queries), -np.inf)

    def add(self, ids: pa.Array, vectors: pa.Array) -> None:
        for at in range(0, len(ids), _ROWS):
            rows, unit = _unit_rows(vectors.slice(at, _ROWS), self.queries.shape[1])
            if len(rows):
                mine = ids.slice(at, _ROWS).take(pa.array(rows))
                for start in range(0, len(self.queries), _TILE):
                    self._add_tile(start, mine, unit)

    def _add_tile(self, start: int, ids: pa.Array, unit: np.ndarray) -> None:
        """Rows below a query's k-th best score cannot rank; ties at it are all kept."""
        floor = self.floor[start : start + _TILE]
        tile = np.round(self.queries[start : start + _TILE] @ unit.T, SCORE_DIGITS)
        hit = tile >= floor[:, None]
        many = np.flatnonzero(hit.sum(axis=1) > self.k)
        if len(many):
            limit = np.partition(tile[many], -self.k, axis=1)[:, -self.k]
            hit[many] &= tile[many] >= limit[:, None]
        q, row = np.nonzero(hit)
        if not len(q):
            return
        new = pa.table({"q": q, "score": tile[q, row], "id": ids.take(pa.array(row))})
        held = self.best.get(start)
        both = new if held is None else pa.concat_tables([held, new])
        both = both.sort_by([("q", "ascending"), ("score", "descending"), ("id", "ascending")])
        q = both["q"].to_numpy()
        first = np.searchsorted(q, np.arange(len(floor)))
        kept = both.filter(pa.array(np.arange(len(q)) - first[q] < self.k)).combine_chunks()
        self.best[start] = kept
        q, scores = kept["q"].to_numpy(), kept["score"].to_numpy()
        full = np.bincount(q, minlength=len(floor)) == self.k
        last = np.searchsorted(q, np.arange(len(floor)), side="right") - 1
        floor[full] = scores[last[full]]

    def batches(self) -> Iterator[pa.RecordBatch]:
        for start, kept in self.best.items():
            which = pa.array(kept["q"].to_numpy() + start)
            columns = [
                self.query_ids.take(which).cast(self.schema.types[0]),
                _combined(kept["id"]).cast(self.schema.types[1]),
                _combined(kept["score"]),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _combined(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _query_block(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
    vectors = _combined(table.column(1))
    lengths = pc.list_value_length(vectors).drop_null()
    dim = lengths[0].as_py() if len(lengths) else 0
    rows, unit = _unit_rows(vectors, dim)
    return _combined(table.column(0)).take(pa.array(rows)), unit


def nearest_batch(
    corpus: DataFrame,
    queries: DataFrame,
    id_col: str,
    vector_col: str,
    query_id_col: str,
    query_vector_col: str,
    k: int = DEFAULT_LIMIT,
    query_block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """The exact ``k`` nearest rows of every query.

    Queries travel to the tasks in blocks of some ``query_block_bytes``, measured
    first. Each block is one pass over the corpus, which is never copied or shuffled; a
    task sends on its best ``k`` rows per query only, and a pass is written before
    the next one starts. Query ids must be unique. All query vectors must have one
    length; null ones find nothing.
    """
    corpus = corpus.select(id_col, vector_col)
    queries = queries.select(query_id_col, query_vector_col)
    out = T.StructType(
        [
            T.StructField(query_id_col, queries.schema[0].dataType),
            T.StructField(id_col, corpus.schema[0].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    size = F.when(F.col(query_vector_col).isNotNull(), F.size(query_vector_col))
    low, high = queries.agg(F.min(size), F.max(size)).first()
    if low != high:
        raise ValueError(f"queries have {low} to {high} dimensions, not one number")
    blocks = math.ceil(measured_bytes(queries) / query_block_bytes) or 1
    if blocks == 1:
        partial = _nearest_of_block(corpus, queries, k, out)
    else:
        partial = _nearest_by_passes(corpus, queries, k, out, blocks)
    order = Window.partitionBy(query_id_col).orderBy(F.desc("score"), F.col(id_col))
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _nearest_of_block(
    corpus: DataFrame, block: DataFrame, k: int, out: T.StructType
) -> DataFrame:
    query_ids, unit = _query_block(block.toArrow())
    schema = to_arrow_schema(out)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _BestRows(query_ids, unit, k, schema)
        for b in batches:
            best.add(b.column(0), b.column(1))
        yield from best.batches()

    return corpus.mapInArrow(scan, out)


def _nearest_by_passes(
    corpus: DataFrame, queries: DataFrame, k: int, out: T.StructType, blocks: int
) -> DataFrame:
    """One pass per block of queries. Blocks divide by hash, so their sizes are alike."""
    spark = corpus.sparkSession
    number = F.pmod(F.xxhash64(queries.columns[0]), F.lit(blocks)).cast("int")
    divided = scratch_path(spark, "query-blocks")
    queries.withColumn("_block", number).write.partitionBy("_block").parquet(divided)
    found = scratch_path(spark, "nearest")
    for n in range(blocks):
        block = spark.read.parquet(divided).where(F.col("_block") == n).drop("_block")
        hits = _nearest_of_block(corpus, block, k, out)
        hits.write.mode("append").parquet(found)
    return spark.read.schema(out).parquet(found)


def result_fields(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    return df.select(*(fields or RESULT_FIELDS))


def result_cards(hits: DataFrame) -> DataFrame:
    """Ranked hits as display text; the rating line is null for an unrated title."""
    rating = F.format_string(
        "%.2f (%d ratings)", F.round("avg_rating", 2), F.coalesce("rating_count", F.lit(0))
    )

    def shown(c: str, default: str) -> Column:
        text = F.col(c).cast("string")
        return F.when(text.isNull() | (text == ""), F.lit(default)).otherwise(text)

    return hits.select(
        "rank",
        shown("title", UNKNOWN_TITLE).alias("title"),
        shown("release_date", UNKNOWN_DATE).alias("release_date"),
        shown("director", UNKNOWN_DIRECTOR).alias("director"),
        F.array_join(F.slice("top_cast", 1, CARD_CAST), ", ").alias("top_cast"),
        F.when(F.col("avg_rating").isNotNull(), rating).alias("rating"),
        snippet(F.col("overview")).alias("overview"),
    )
