"""Gold to documents, and search over them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gildmill.functions import parsing
from gildmill.functions.text import null_to_empty
from gildmill.operators import filters, metrics, search
from gildmill.operators.encode import encode
from gildmill.operators.term_index import TermIndex, checked_query, index_terms, search_terms
from gildmill.plans import schemas as S
from gildmill.sources.document_sink import send_documents
from gildmill.sources.readers import read_parquet
from gildmill.sources.writers import scratch_path, write_documents

NAMES = "array<string>"
VECTOR = "vector"
Encoder = Callable[[], Callable[[list[str]], np.ndarray]]


def build_documents(gold: DataFrame, embeddable_only: bool = False) -> DataFrame:
    """Null-safe documents: empty text and lists, zero count; score and date may be null."""
    if embeddable_only:
        gold = keep_embeddable(gold)
    none = F.array().cast(NAMES)
    text = {c: null_to_empty(F.col(c)) for c in ("title", "overview", "tagline", "director")}
    lists = {c: F.coalesce(c, none) for c in ("genre_list", "keyword_list", "top_cast")}
    return (
        gold.withColumns(
            {
                **text,
                **lists,
                "tmdb_id": null_to_empty(F.col("id").cast("string")),
                "release_date": parsing.rfc3339_date(F.col("release_date")),
                "avg_rating": F.col("avg_rating").cast("double"),
                "rating_count": F.coalesce(F.col("rating_count").cast("bigint"), F.lit(0)),
                "combined_text": null_to_empty(F.col("combined_text")),
            }
        )
        .select(*S.DOCUMENT_COLUMNS)
    )


def keep_embeddable(df: DataFrame, columns: tuple[str, ...] = ("overview",)) -> DataFrame:
    """Only rows with text to embed."""
    return df.where(filters.non_blank(list(columns)))


def gold_to_documents(
    spark: SparkSession,
    gold: str,
    target: str | None = None,
    client: str | None = None,
    embeddable_only: bool = False,
    load_encoder: Encoder | None = None,
    index: str | None = None,
    **client_options,
) -> DataFrame:
    """Replace the document collection with the gold table's rows.

    With ``target`` the documents are written as JSON and the result compares what is stored
    with its source, whole documents by checksums of key ranges; with ``client`` the tasks send them in batches and the
    result compares the rows that were read with the documents that the client counts.
    ``load_encoder`` adds a vector of the combined text to each document; ``index``
    names a folder for the term index of these texts.
    """
    if (target is None) == (client is None):
        raise ValueError("give either target or client")
    documents = build_documents(
        read_parquet(spark, f"{gold.rstrip('/')}/{S.MOVIES_TABLE}"), embeddable_only
    )
    if index is not None:
        index_terms(documents, "combined_text", "tmdb_id", index)
    if load_encoder is not None:
        documents = encode(documents, "combined_text", load_encoder, VECTOR)
    if client is not None:
        read = Observation()
        counted = documents.observe(read, F.count(F.lit(1)).alias("rows"))
        loaded = send_documents(spark, counted, client, **client_options)
        report = [(read.get["rows"], loaded)]
        return spark.createDataFrame(report, "source_rows bigint, sink_rows bigint")
    write_documents(documents, target)
    plain = documents.drop(VECTOR)
    written = spark.read.schema(plain.schema).json(target)
    return metrics.reconcile_ranges(plain, written, "tmdb_id").summary


def search_gold(
    gold: DataFrame,
    query: str,
    k: int = search.DEFAULT_LIMIT,
    field: str | None = None,
    index: TermIndex | None = None,
    exact: bool = False,
) -> DataFrame:
    """Cards of the movies whose words are most like ``query``; ``field`` also filters by it.

    Without an ``index`` of the combined text by id, one is written first.
    """
    if index is None:
        index = index_terms(
            gold, "combined_text", "id", scratch_path(gold.sparkSession, "terms")
        )
    where = filters.search_filter(field, query, exact=exact)
    return search.result_cards(search_terms(index, gold, query, k, where))


def search_documents(
    documents: DataFrame,
    query: str,
    load_encoder: Encoder,
    k: int = search.DEFAULT_LIMIT,
    field: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Cards of the stored documents whose vectors are nearest to that of ``query``.

    ``load_encoder`` is the one the documents were loaded with; it runs once, for the query.
    """
    asked = np.asarray(load_encoder()([checked_query(query)]))[0]
    dated = documents.withColumn("release_date", F.col("release_date").try_cast("date"))
    where = filters.search_filter(field, query, exact=exact)
    return search.result_cards(search.nearest(dated, "tmdb_id", VECTOR, asked, k, where))
