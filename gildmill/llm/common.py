"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.shipping import ship_package
from gildmill.sources.writers import materialize, scratch_path

__all__ = [
    "connected_components", "materialize", "mix64", "ranges_of", "reduce_tasks", "scratch_path",
    "ship_package", "slices", "strings", "table", "uniform", "whole_text", "word_hashes",
]

HEX_DIGITS = 13  # 52 bits, all of which a double holds


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def reduce_tasks(spark: SparkSession) -> int:
    """The session's number of reduce tasks, for exchanges that state one."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def whole_text(c: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def hash52(*parts: Column) -> Column:
    """The first 52 bits of the MD5 of the parts joined by colons; null parts are empty."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return hash52(*parts) / F.lit(float(1 << 52))


# ---------------------------------------------------------------- inside tasks


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 over an array of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold at most ``limit`` bytes; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def strings(column: pa.Array) -> list[str]:
    return [x if x is not None else "" for x in column.to_pylist()]


def ranges_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes laid end to end: each item's group, and its place in it."""
    group = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    return group, np.arange(len(group)) - starts[group]


_BASE = 0x9E3779B97F4A7C15
_powers = np.array([1], dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 64), _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown, dtype=np.uint64)
    return _powers


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words split at white space: all words' 64-bit hashes in order, words per text."""
    flat = [" ".join(t.lower().split()) for t in texts]
    counts = np.array([t.count(" ") + 1 if t else 0 for t in flat], dtype=np.int64)
    data = np.frombuffer(
        " ".join(t for t in flat if t).encode("utf-8", "surrogatepass"), dtype=np.uint8
    )
    if not len(data):
        return np.empty(0, np.uint64), counts
    gap = data == 32
    starts = np.concatenate([[0], np.flatnonzero(gap) + 1])
    lengths = np.diff(np.concatenate([starts, [len(data) + 1]])) - 1
    place = np.arange(len(data)) - np.repeat(starts, lengths + 1)[: len(data)]
    value = (data.astype(np.uint64) + np.uint64(1)) * _powers_to(int(lengths.max()) + 2)[place]
    value[gap] = 0
    return mix64(np.add.reduceat(value, starts) + lengths.astype(np.uint64)), counts


# ---------------------------------------------------------------- graphs


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "least").alias("least"))
    joined = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    joined = edges.join(_least(edges), "a")
    moved = joined.filter(F.col("b") != F.col("least"))
    return joined.select("a", F.col("least").alias("b")).union(
        moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) can reach.

    Alternating large-star and small-star steps until the edges stand still. The
    number of rounds grows with the logarithm of the graph; each is written to the shared
    folder. Only the state's count and checksum reach the driver. Nodes without an edge are
    not returned.
    """
    state = materialize(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )

    def checksum(df: DataFrame):
        return tuple(
            df.agg(
                F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
            ).first()
        )

    before = checksum(state)
    while before[0]:
        star = _large_star(state).filter(F.col("a") != F.col("b")).distinct()
        state = materialize(_small_star(star).distinct(), "edges")
        after = checksum(state)
        if after == before:
            break
        before = after
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
