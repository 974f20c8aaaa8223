"""Table and document sinks. Failures propagate to the caller."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
COMPRESSION = "zstd"


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite, so a re-run leaves the same table."""
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write once and continue from the files, so the lineage runs only once."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def write_documents(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Drop and recreate a document collection; executors write, nothing is collected."""
    writer = df.write.mode("overwrite")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(fmt).save(path)


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="gildmill-")


def scratch_folder(spark: SparkSession) -> str:
    """This session's own folder under the shared folder that the session names.

    Only a local session without that setting gets a temporary folder.
    """
    application = spark.sparkContext.applicationId
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        root = _local_root(application)
    return f"{root.rstrip('/')}/gildmill-{application}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this session's scratch folder."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder, on any file system?"""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a table or folder on any file system; False if there was none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_scratch(spark: SparkSession) -> bool:
    """Delete all scratch tables of this session; DataFrames that read them end with it."""
    return remove_path(spark, scratch_folder(spark))


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage with a written table, which survives the loss of executors."""
    return write_and_read(df, scratch_path(df.sparkSession, name))


@contextmanager
def materialized(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """As ``materialize``, for the length of a block; the table is deleted at its end."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield write_and_read(df, path)
    finally:
        remove_path(df.sparkSession, path)
