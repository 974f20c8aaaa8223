"""Bronze to gold through silver tables that are bucketed by id.

Silver rows are written in buckets of their id, so the joins of the gold job find them already
divided: nothing is exchanged again. Buckets are known to Spark by a catalog table only; the job's
tables have names of its own, lie over the silver folders and are dropped at the end. The folders
stay, as ordinary Parquet.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.plans import gold as gold_plan
from gildmill.plans import schemas as S
from gildmill.plans.silver import DEFAULT_POLICY, CleaningPolicy, bronze_to_silver
from gildmill.sources.writers import COMPRESSION, write_and_read


@contextmanager
def bucketed_writer(
    spark: SparkSession, key: str = "id", buckets: int | None = None
) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function that writes a table to a folder in buckets of ``key`` and gives it back.

    The catalog knows the tables while the block runs. ``buckets`` is the session's number of
    shuffle partitions unless given. Each bucket is one file; rows with a null key share one.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names: list[str] = []

    def write(df: DataFrame, path: str) -> DataFrame:
        names.append(f"gildmill_{uuid.uuid4().hex}")
        writer = df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet")
        writer = writer.option("compression", COMPRESSION)
        writer.bucketBy(buckets, key).option("path", path).saveAsTable(names[-1])
        return spark.table(names[-1])

    try:
        yield write
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def bronze_to_gold(
    spark: SparkSession,
    bronze: str,
    silver: str,
    gold: str,
    policy: CleaningPolicy = DEFAULT_POLICY,
    buckets: int | None = None,
    **options,
) -> DataFrame:
    """Both jobs in one; movies are required. The gold table has one row per movie."""
    with bucketed_writer(spark, buckets=buckets) as write:
        tables = bronze_to_silver(spark, bronze, silver, policy, write)
        if "movies" not in tables:
            raise ValueError(f"{bronze} has no {S.MOVIES_FILE}")
        enriched = gold_plan.enrich_movies(
            tables["movies"],
            tables.get("credits"),
            tables.get("keywords"),
            tables.get("ratings"),
            sides_are_unique=True,
            **options,
        )
        return write_and_read(enriched, f"{gold.rstrip('/')}/{S.MOVIES_TABLE}")
