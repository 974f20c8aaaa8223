"""Approximate nearest rows of many queries: a random-projection hash table with probing.

Stored vectors lie in buckets by the signs of some random projections; each is stored once. A query
looks into the buckets that its own projections make likeliest, nearest first, and all rows found
there are ranked by exact cosine. How many buckets that takes depends on the vectors, not on a
formula: the index is calibrated when it is built, on a bounded sample of its own rows whose true
neighbours are searched exactly, and keeps the least number of probes that reaches the recall
asked for. In the worst case that is every bucket, and the search exact.

Queries travel to the tasks in blocks of bounded size, as in ``nearest_batch``; a pass reads only
the buckets that its queries probe. The number of buckets follows the number of rows; a large
bucket is read by several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gildmill.operators.joins import measured_bytes
from gildmill.operators.search import (
    DEFAULT_LIMIT,
    QUERY_BLOCK_BYTES,
    SCORE_DIGITS,
    _query_block,
    _unit_rows,
    nearest_batch,
)
from gildmill.sources.writers import materialized, scratch_path

BUCKET_ROWS = 4096
MOST_BITS = 16
SAMPLE = 256
RECALL = 0.9
MARGIN = 0.03  # by which the sample's recall must exceed it
SEED = 11
_TILE = 1 << 22  # scores computed at a time
_HELD = 1 << 20  # hits held before they are cut to k each


def projections(dim: int, bits: int) -> np.ndarray:
    """Random directions, orthogonal while there are dimensions for it."""
    rows = np.random.default_rng(SEED).standard_normal((dim, max(bits, 1)))
    if bits <= dim:
        rows = np.linalg.qr(rows)[0]
    return rows[:, :bits]


def keys_of(unit: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return ((unit @ directions > 0) @ (1 << np.arange(directions.shape[1]))).astype(np.int64)


def probe_order(query: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """All keys, likeliest first: by the squared distance to cross into the bucket; ties by key."""
    bits = directions.shape[1]
    side = query @ directions
    cost = np.zeros(1)
    for b in range(bits):  # the cost of key bits 0..b, from that of 0..b-1
        wrong = side[b] ** 2
        zero, one = (wrong, 0.0) if side[b] > 0 else (0.0, wrong)
        cost = np.concatenate([cost + zero, cost + one])
    return np.argsort(cost, kind="stable")


@dataclass(frozen=True)
class VectorTable:
    """A written table of vectors in buckets, with the number of probes it was calibrated to."""

    spark: SparkSession = field(repr=False)
    path: str
    id_col: str
    vector_col: str
    dim: int
    bits: int
    probes: int

    def directions(self) -> np.ndarray:
        return projections(self.dim, self.bits)

    def rows(self) -> DataFrame:
        shape = self.spark.read.parquet(f"{self.path}/shape").schema
        return self.spark.read.schema(shape).parquet(f"{self.path}/vectors")


def _keyed(corpus: DataFrame, vector_col: str, dim: int, bits: int) -> DataFrame:
    """Rows with a ``key``; unusable vectors get none."""

    @F.arrow_udf(T.IntegerType())
    def key(vectors: pa.Array) -> pa.Array:
        rows, unit = _unit_rows(vectors, dim)
        out = np.full(len(vectors), -1.0)
        out[rows] = keys_of(unit, projections(dim, bits))
        return pa.array(out, mask=out < 0).cast(pa.int32())

    return corpus.withColumn("key", key(F.col(vector_col)))


def build_vector_table(
    corpus: DataFrame,
    id_col: str,
    vector_col: str,
    path: str,
    k: int = DEFAULT_LIMIT,
    recall: float = RECALL,
    bucket_rows: int = BUCKET_ROWS,
    sample: int = SAMPLE,
) -> VectorTable:
    """Write ``corpus`` in buckets and calibrate the number of probes.

    Vectors of another length than most rows', null and zero ones are left out: no search finds
    them. Of equal lengths the smaller one counts. Ids must be unique.
    """
    path, spark = path.rstrip("/"), corpus.sparkSession
    corpus = corpus.select(id_col, vector_col)
    lengths = corpus.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("dim"))
    common = lengths.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    dim, n = (common["dim"], common["n"]) if common else (1, 0)
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(n, 1) / bucket_rows))))
    keyed = _keyed(corpus, vector_col, dim, bits).where(F.col("key").isNotNull())
    # A bucket may hold most rows: pieces spread it over tasks.
    piece = F.pmod(F.xxhash64(id_col), F.lit(max(1, n // (bucket_rows << bits))))
    divided = keyed.repartition("key", piece).sortWithinPartitions("key")
    divided.write.mode("overwrite").partitionBy("key").parquet(f"{path}/vectors")
    keyed.limit(0).write.mode("overwrite").parquet(f"{path}/shape")
    probes = _calibrated(spark, f"{path}/vectors", id_col, vector_col, dim, bits, k, recall, sample) if n else 1
    meta = spark.createDataFrame([(id_col, vector_col, dim, bits, probes)], _META)
    meta.write.mode("overwrite").parquet(f"{path}/meta")
    return read_vector_table(spark, path)


_META = "id_col string, vector_col string, dim int, bits int, probes int"


def read_vector_table(spark: SparkSession, path: str) -> VectorTable:
    row = spark.read.parquet(f"{path.rstrip('/')}/meta").first()
    return VectorTable(spark, path.rstrip("/"), *row)


def _calibrated(spark, path, id_col, vector_col, dim, bits, k, recall, sample) -> int:
    """Probes after which the sampled rows' true neighbours are found, with a margin."""
    if bits == 0:
        return 1
    stored = spark.read.parquet(path)  # holds rows
    asked = stored.orderBy(F.xxhash64(F.lit(SEED), F.col(id_col)), id_col).limit(sample)
    asked = asked.select(F.col(id_col).alias("_q"), F.col(vector_col).alias("_v"))
    with materialized(asked, "sample") as asked:
        near = nearest_batch(stored.select(id_col, vector_col), asked, id_col, vector_col, "_q", "_v", k + 1)
        near = near.where(F.col("_q") != F.col(id_col)).select("_q", id_col)
        near = near.join(stored.select(id_col, "key"), id_col).collect()  # sample * (k + 1) rows
        ids, unit = _query_block(asked.toArrow())
    directions = projections(dim, bits)
    place = {}
    for i, v in zip(ids.to_pylist(), unit):
        at = np.empty(1 << bits, np.int64)
        at[probe_order(v, directions)] = np.arange(1 << bits)
        place[i] = at
    found = np.sort([place[r["_q"]][r["key"]] for r in near])
    if not len(found):
        return 1
    wanted = math.ceil(min(1.0, recall + MARGIN) * len(found))
    return int(found[wanted - 1]) + 1


class _Best:
    """The best ``k`` rows of each query so far."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.floor = np.full(len(queries), -np.inf)
        self.hits: list[pa.Table] = []
        self.held = 0

    def add(self, asking: np.ndarray, ids: pa.Array, unit: np.ndarray) -> None:
        step = max(1, _TILE // max(1, len(unit)))
        for at in range(0, len(asking), step):
            who = asking[at : at + step]
            scores = np.round(self.queries[who] @ unit.T, SCORE_DIGITS)
            hit = scores >= self.floor[who][:, None]
            many = np.flatnonzero(hit.sum(axis=1) > self.k)
            if len(many):
                least = np.partition(scores[many], -self.k, axis=1)[:, -self.k]
                hit[many] &= scores[many] >= least[:, None]
            q, row = np.nonzero(hit)
            self.hits.append(pa.table({"q": who[q], "score": scores[q, row], "id": ids.take(pa.array(row))}))
            self.held += len(q)
            if self.held > _HELD:
                self.cut()

    def cut(self) -> pa.Table | None:
        if not self.hits:
            return None
        every = pa.concat_tables(self.hits)
        every = every.sort_by([("q", "ascending"), ("score", "descending"), ("id", "ascending")])
        q = every["q"].to_numpy()
        first = np.searchsorted(q, q)
        rank = np.arange(len(q)) - first
        kept = every.filter(pa.array(rank < self.k)).combine_chunks()
        last = every.filter(pa.array(rank == self.k - 1))
        self.floor[last["q"].to_numpy()] = last["score"].to_numpy()
        self.hits, self.held = [kept], 0  # what is kept does not count: it can't be cut again
        return kept


def nearest_approximate(
    index: VectorTable,
    queries: DataFrame,
    query_id_col: str,
    query_vector_col: str,
    k: int = DEFAULT_LIMIT,
    probes: int | None = None,
    query_block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """(query id, id, score, rank): the ``k`` best rows that each query's probes find.

    Scores are exact. A query whose buckets hold fewer than ``k`` rows is searched exactly. Query
    ids must be unique; null, zero and misfit query vectors find nothing.
    """
    spark, probes = index.spark, min(probes or index.probes, 1 << index.bits)
    queries = queries.select(query_id_col, query_vector_col)
    stored = index.rows()
    out = T.StructType(
        [
            T.StructField(query_id_col, queries.schema[0].dataType),
            T.StructField(index.id_col, stored.schema[index.id_col].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    fit = queries.where(F.size(query_vector_col) == index.dim)
    blocks = math.ceil(measured_bytes(fit) / query_block_bytes) or 1
    number = F.pmod(F.xxhash64(query_id_col), F.lit(blocks)).cast("int")
    divided, found = scratch_path(spark, "query-blocks"), scratch_path(spark, "nearest")
    fit.withColumn("_block", number).write.partitionBy("_block").parquet(divided)
    shape = T.StructType([*fit.schema, T.StructField("_block", T.IntegerType())])
    for block in range(blocks):
        asked = spark.read.schema(shape).parquet(divided).where(F.col("_block") == block).drop("_block")
        _block_hits(index, asked, k, probes, out).write.mode("append").parquet(found)
    hits = spark.read.schema(out).parquet(found)
    order = Window.partitionBy(query_id_col).orderBy(F.desc("score"), F.col(index.id_col))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    if probes == 1 << index.bits:
        return ranked
    few = ranked.groupBy(query_id_col).count().where(F.col("count") >= k).select(query_id_col)
    missing = fit.join(few, query_id_col, "left_anti")
    if missing.isEmpty():
        return ranked
    corpus = stored.select(index.id_col, index.vector_col)
    exact = nearest_batch(
        corpus, missing, index.id_col, index.vector_col, query_id_col, query_vector_col, k, query_block_bytes
    )
    return ranked.join(few, query_id_col, "left_semi").unionByName(exact)


def _block_hits(index: VectorTable, block: DataFrame, k: int, probes: int, out: T.StructType) -> DataFrame:
    query_ids, unit = _query_block(block.toArrow())
    spark, directions, schema = index.spark, index.directions(), to_arrow_schema(out)
    asked = np.array([probe_order(v, directions)[:probes] for v in unit], np.int64).reshape(len(unit), probes)
    keys = np.unique(asked).tolist()
    rows = index.rows().where(F.col("key").isin(keys)).select(index.id_col, index.vector_col, "key")
    shared = spark.sparkContext.broadcast((query_ids, unit, asked.astype(np.int32)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, probed = shared.value
        order = np.argsort(probed, axis=None, kind="stable")
        by_key = probed.ravel()[order]
        best = _Best(vectors, k)
        for batch in batches:
            key = batch.column(2).to_numpy()
            for one in np.unique(key):
                mine = batch.filter(pa.array(key == one))
                at, rows = _unit_rows(mine.column(1), vectors.shape[1])
                lo, hi = np.searchsorted(by_key, [one, one + 1])
                best.add(order[lo:hi] // probed.shape[1], mine.column(0).take(pa.array(at)), rows)
        kept = best.cut()
        if kept is not None and len(kept):
            which = pa.array(kept["q"].to_numpy())
            columns = [ids.take(which), kept["id"], kept["score"]]
            flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays(
                [c.cast(t) for c, t in zip(flat, schema.types)], schema=schema
            )

    return rows.mapInArrow(scan, out)
