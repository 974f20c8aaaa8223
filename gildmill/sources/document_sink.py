"""Batch document sink as a Spark data source: each task sends its rows in batches.

The client is named as ``module:factory`` and built from the sink's options, to which a
name of the ``load`` and, in a task, the numbers of the ``task`` and of its ``attempt`` are
added. It needs

* ``prepare()``: make an empty collection for this load beside the present one,
* ``send(batch)``: add a list of dictionaries to it,
* ``publish(documents, committed)``: put it in the present one's place, with what the named
  task attempts sent and nothing else,
* ``discard()``: drop it, as the job failed,
* ``count()``: the documents that the present collection holds, by what is stored,
* ``close()``.

A retried task sends its rows again under another attempt. A client that can't take back what an
uncommitted attempt has sent must upsert by the document key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import closing, contextmanager
from dataclasses import dataclass
from importlib import import_module
from itertools import batched

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "document_batches"
BATCH_SIZE = 64
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@dataclass
class SentDocuments(WriterCommitMessage):
    documents: int
    batches: int
    attempt: str


def connect(options: dict):
    """The client that the options name, closed at the end of a ``with`` block."""
    module, _, factory = options["client"].partition(":")
    return closing(getattr(import_module(module), factory)(options))


class DocumentBatchWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.options = options
        self.batch_size = int(options.get("batchsize", BATCH_SIZE))

    def write(self, iterator: Iterator[Row]) -> SentDocuments:
        documents = batches = 0
        context = TaskContext.get()
        task, attempt = str(context.partitionId()), str(context.attemptNumber())
        with connect({**self.options, "task": task, "attempt": attempt}) as client:
            for batch in batched(iterator, self.batch_size):
                client.send([row.asDict(recursive=True) for row in batch])
                documents += len(batch)
                batches += 1
        return SentDocuments(documents, batches, f"{task}-{attempt}")

    def commit(self, messages) -> None:
        sent = [m for m in messages if m is not None]
        with connect(self.options) as client:
            client.publish(sum(m.documents for m in sent), [m.attempt for m in sent])

    def abort(self, messages) -> None:
        with connect(self.options) as client:
            client.discard()


class DocumentBatches(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DocumentBatchWriter:
        if not overwrite:
            raise ValueError("the document sink replaces its collection: use mode overwrite")
        options = {**self.options, "load": uuid.uuid4().hex}
        with connect(options) as client:
            client.prepare()
        return DocumentBatchWriter(options)


@contextmanager
def _rows_at_a_time(spark: SparkSession, rows: int) -> Iterator[None]:
    """Tasks take ``rows`` rows at a time into Python, not thousands of long documents."""
    before = spark.conf.get(ARROW_ROWS, None)
    spark.conf.set(ARROW_ROWS, rows)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_ROWS)
        else:
            spark.conf.set(ARROW_ROWS, before)


def send_documents(
    spark: SparkSession, df: DataFrame, client: str, batch_size: int = BATCH_SIZE, **options
) -> int:
    """Replace a collection with the rows of ``df``, sent from the executors.

    The old collection stays until all tasks are done, and for good if one fails.
    A task holds the rows of a batch, or of ``BATCH_SIZE`` if that is more, however many it sends.
    Returns how many documents the collection then holds.
    """
    spark.dataSource.register(DocumentBatches)
    writer = df.write.format(FORMAT).mode("overwrite").option("client", client)
    with _rows_at_a_time(spark, max(batch_size, BATCH_SIZE)):
        writer.option("batchsize", batch_size).options(**options).save()
    with connect({**options, "client": client}) as loaded:
        return loaded.count()
