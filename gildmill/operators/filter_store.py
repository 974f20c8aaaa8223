"""A table stored so that the search filters skip what cannot match.

* Rows lie in one folder per decade of their date, so a year reads one of them.
* Each text field has a folded copy with a Parquet Bloom filter, and rows are sorted by the first of
  them, so an equality test skips files and row groups by statistics, dictionary or Bloom filter.
* Members of array fields are a table of their own, (name, key, decade), in buckets by name: a
  member's rows are found by key in the decades where it occurs.

The number of buckets follows the number of members. A search names the bucket it reads.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.functions.text import fold_key
from gildmill.operators import filters
from gildmill.sources.writers import write_table

BUCKET_MEMBERS = 1 << 20
LITERAL_KEYS = 1000
FOLDED = "_folded"
DECADE = "_decade"
_META = "key string, text_fields array<string>, array_fields array<string>, date_field string, buckets int"


def decade_of(c: Column) -> Column:
    return (F.floor(F.year(c) / 10) * 10).cast("int")


def _name_bucket(c: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class FilterStore:
    """A table that ``write_filter_store`` wrote below ``path``."""

    spark: SparkSession = field(repr=False)
    path: str
    key: str
    text_fields: tuple[str, ...]
    array_fields: tuple[str, ...]
    date_field: str | None
    buckets: int

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def search(self, name: str | None, value: str, exact: bool = False) -> DataFrame:
        """The rows that ``filters.search_filter`` keeps, with the columns of the stored table."""
        dates = {"year": self.date_field} if self.date_field else {}
        test = filters.search_filter(name, value, self.text_fields, self.array_fields, dates, exact)
        rows = self.rows()
        if test is None:
            found = rows
        elif name in self.text_fields:
            found = rows.where(F.col(f"{name}{FOLDED}") == fold_key(F.lit(value))).where(test)
        elif name in self.array_fields:
            found = self._holding(rows, name, value).where(test)
        else:
            found = rows.where(F.col(DECADE) == int(value) // 10 * 10).where(test)
        return found.drop(DECADE, *[f"{f}{FOLDED}" for f in self.text_fields])

    def members(self, name: str, value: str) -> DataFrame:
        """(key, decade) of the rows whose field ``name`` holds ``value``, whatever its case."""
        return self._stored_members(name, value).distinct()

    def _stored_members(self, name: str, value: str) -> DataFrame:
        """As ``members``; rows that share a key and decade come once each."""
        folded = fold_key(F.lit(value))
        bucket = self.spark.range(1).select(_name_bucket(folded, self.buckets)).first()[0]
        stored = self.spark.read.parquet(f"{self.path}/members/{name}").where(F.col("bucket") == bucket)
        return stored.where(F.col("name") == folded).select(self.key, DECADE)

    def _holding(self, rows: DataFrame, name: str, value: str) -> DataFrame:
        found = self._stored_members(name, value)
        some = found.limit(LITERAL_KEYS + 1).collect()
        if len(some) > LITERAL_KEYS:
            near = found.select(self.key, F.coalesce(DECADE, F.lit(-1)).alias(DECADE))
            placed = rows.withColumn("_at", F.coalesce(DECADE, F.lit(-1)))
            same = (placed[self.key] == near[self.key]) & (placed["_at"] == near[DECADE])
            return placed.join(near, same, "left_semi").drop("_at")
        decades = {r[DECADE] for r in some}
        there = F.col(DECADE).isin([d for d in decades if d is not None])
        there = there | F.col(DECADE).isNull() if None in decades else there
        return rows.where(there & F.col(self.key).isin([r[self.key] for r in some]))


def write_filter_store(
    df: DataFrame,
    path: str,
    key: str,
    text_fields: tuple[str, ...] = (),
    array_fields: tuple[str, ...] = (),
    date_field: str | None = None,
    bucket_members: int = BUCKET_MEMBERS,
) -> FilterStore:
    """Write ``df`` for searches by the given fields.

    Keys are unique and not null; rows without one are stored but no member search finds them.
    Undated rows have a folder of their own.
    """
    path, spark = path.rstrip("/"), df.sparkSession
    decade = decade_of(F.col(date_field)) if date_field else F.lit(None).cast("int")
    placed = df.withColumns({DECADE: decade, **{f"{f}{FOLDED}": fold_key(F.col(f)) for f in text_fields}})
    order = [f"{f}{FOLDED}" for f in text_fields[:1]] or [key]
    # Ranges keep equal values together and divide a decade that holds most rows.
    divided = placed.repartitionByRange(DECADE, *order, key).sortWithinPartitions(DECADE, *order)
    writer = divided.write.mode("overwrite").partitionBy(DECADE)
    for column in [key, *[f"{f}{FOLDED}" for f in text_fields]]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(f"{path}/rows")

    stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    buckets = 8
    if array_fields:
        longest = F.greatest(*[F.coalesce(F.size(f), F.lit(0)) for f in array_fields], F.lit(0))
        most = stored.agg(F.sum(longest.cast("long"))).first()[0] or 0
        while buckets * bucket_members < most:
            buckets *= 2
    for name in array_fields:
        # A row's members are made distinct within the row: nothing is gathered or shuffled for it.
        held = F.array_distinct(F.transform(F.array_distinct(name), fold_key))
        every = stored.where(F.col(key).isNotNull()).select(key, DECADE, F.explode(held).alias("name"))
        once = every.where("name is not null").select("name", key, DECADE)
        bucketed = once.withColumn("bucket", _name_bucket(F.col("name"), buckets))
        # By ranges, so a name that most rows hold is written by several tasks; as many as there are
        # buckets, so a task sorts about ``bucket_members`` members however many there are.
        ranged = bucketed.repartitionByRange(buckets, "bucket", "name", key).sortWithinPartitions("bucket", "name", key)
        ranged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/members/{name}")
    meta = [(key, list(text_fields), list(array_fields), date_field, buckets)]
    write_table(spark.createDataFrame(meta, _META), f"{path}/meta")
    return read_filter_store(spark, path)


def read_filter_store(spark: SparkSession, path: str) -> FilterStore:
    path = path.rstrip("/")
    row = spark.read.parquet(f"{path}/meta").first()
    return FilterStore(
        spark, path, row["key"], tuple(row["text_fields"]), tuple(row["array_fields"]), row["date_field"], row["buckets"]
    )
