"""Similarity search, encoders and the search job."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildmill.operators import dedup, encode, latent, search, term_index, vector_tables
from gildmill.operators.joins import measured_bytes
from gildmill.plans import documents
from gildmill.plans.schemas import MOVIES_TABLE
from gildmill.queries.jobs import SQL_CARD, SQL_GOLD, enriched
from gildmill.queries.registry import query, spread_table, sql_term_search, table
from gildmill.shipping import ship_package
from gildmill.sources.writers import materialize, scratch_path, write_table

K = 10

_SQL_Q = "q AS (SELECT CAST(embedding AS DOUBLE[]) AS v, label AS l FROM embeddings ORDER BY vec_id LIMIT 1)"
_SQL_SCORED = """s AS (
  SELECT vec_id, label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), v), 6) AS score,
    list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS exact_score, l FROM embeddings, q)"""


def _sample_query(spark: SparkSession, folder: str):
    """The first vector of the table serves as the query."""
    return table(spark, folder, "embeddings").orderBy("vec_id").first()


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


@query(f"""
WITH {_SQL_Q}, {_SQL_SCORED}
SELECT CAST(row_number() OVER (ORDER BY exact_score DESC, vec_id) AS INT) AS rank, vec_id, label, score
FROM s ORDER BY rank LIMIT {K}
""")
def search_topk(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    q = _sample_query(spark, folder)["embedding"]
    return _rounded(search.nearest(table(spark, folder, "embeddings"), "vec_id", "embedding", q, K))


@query(f"""
WITH {_SQL_Q}, {_SQL_SCORED}
SELECT CAST(row_number() OVER (ORDER BY exact_score DESC, vec_id) AS INT) AS rank, vec_id, label, score
FROM s WHERE label = l ORDER BY rank LIMIT {K}
""")
def search_topk_filtered(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    q = _sample_query(spark, folder)
    where = F.col("label") == q["label"]
    corpus = table(spark, folder, "embeddings")
    return _rounded(search.nearest(corpus, "vec_id", "embedding", q["embedding"], K, where))


@query(f"""
WITH {_SQL_Q}, {_SQL_SCORED}
SELECT CAST(row_number() OVER (ORDER BY exact_score DESC, vec_id) AS INT) AS rank, vec_id, label, score
FROM s ORDER BY rank LIMIT {K}
""")
def search_topk_native(spark: SparkSession, folder: str) -> DataFrame:
    q = _sample_query(spark, folder)["embedding"]
    corpus = table(spark, folder, "embeddings")
    return _rounded(search.nearest(corpus, "vec_id", "embedding", q, K, native=True))


@query(f"""
WITH q AS (
  SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v,
    row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings),
s AS (
  SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS exact_score
  FROM embeddings, q WHERE n = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY exact_score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, CAST(rank AS INT) AS rank, round(exact_score, 6) AS score FROM r WHERE rank <= {K}
""")
def search_topk_batch(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    corpus = table(spark, folder, "embeddings")
    one_per_label = dedup.first_per_key(corpus, ["label"], ["vec_id"])
    asked = one_per_label.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return _rounded(
        search.nearest_batch(corpus, asked, "vec_id", "embedding", "query_id", "query", K)
    )


@query(f"""
WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 = 0),
s AS (
  SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS exact_score
  FROM embeddings, q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY exact_score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, CAST(rank AS INT) AS rank, round(exact_score, 6) AS score FROM r WHERE rank <= {K}
""")
def search_topk_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Every twentieth vector asks, in three passes over the corpus."""
    ship_package(spark)
    corpus = table(spark, folder, "embeddings")
    asked = corpus.where(F.col("vec_id") % 20 == 0)
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    third = math.ceil(measured_bytes(asked) / 3) or 1
    hits = search.nearest_batch(
        corpus, asked, "vec_id", "embedding", "query_id", "query", K, query_block_bytes=third
    )
    return _rounded(hits)


@query()
def search_topk_approximate(spark: SparkSession, folder: str) -> DataFrame:
    """Every twentieth vector asks the hash table of all; no SQL, as a few true neighbours may lack."""
    ship_package(spark)
    corpus = table(spark, folder, "embeddings")
    index = vector_tables.build_vector_table(corpus, "vec_id", "embedding", scratch_path(spark, "vectors"), K)
    asked = corpus.where(F.col("vec_id") % 20 == 0)
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return _rounded(vector_tables.nearest_approximate(index, asked, "query_id", "query", K))


@query("""
SELECT CAST(1 AS INT) AS rank, vec_id, label, CAST(0 AS DOUBLE) AS score FROM embeddings WHERE label < 0
""")
def search_empty(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    q = _sample_query(spark, folder)["embedding"]
    corpus = table(spark, folder, "embeddings")
    return _rounded(search.nearest(corpus, "vec_id", "embedding", q, K, F.col("label") < 0))


def _letter_counts():
    """A tiny encoder: text length, and the number of spaces and line ends."""
    import numpy

    def model(texts: list[str]):
        return numpy.array(
            [[len(t), t.count(" "), t.count("\n")] for t in texts], dtype="float32"
        )

    return model


@query("""
SELECT doc_id, CAST(length(text) AS DOUBLE) AS x0,
  CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS x1,
  CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS x2
FROM documents
""")
def encode_text(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    v = F.col(encode.VECTOR_COLUMN)
    encoded = encode.encode(docs, "text", _letter_counts)
    return encoded.select(
        "doc_id", *[F.get(v, F.lit(i)).cast("double").alias(f"x{i}") for i in range(3)]
    )


_SQL_FIRST_ITEM = "SELECT text AS q FROM benchmark ORDER BY item_id LIMIT 1"


def _first_item(spark: SparkSession, folder: str) -> str:
    return table(spark, folder, "benchmark").orderBy("item_id").first()["text"]


@query(f"""
WITH {sql_term_search("documents", "doc_id", "text", _SQL_FIRST_ITEM, K)}
SELECT CAST(rank AS INT) AS rank, doc_id, lang, round(score, 6) AS score
FROM hits JOIN documents ON doc_id = id
""")
def tfidf_search(spark: SparkSession, folder: str) -> DataFrame:
    """A search on the ready index of all documents."""
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    hits = term_index.search_terms(_ready_index(spark, folder), docs, _first_item(spark, folder), K)
    return _rounded(hits.select("rank", "doc_id", "lang", "score"))


_READY: dict[tuple[str, str], str] = {}


def _ready_index(spark: SparkSession, folder: str) -> term_index.TermIndex:
    """The documents' index, as a load leaves it: written by the session's first search, then read."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _READY:
        docs = spread_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
        path = scratch_path(spark, "terms")
        term_index.index_terms(docs, "text", "doc_id", path)
        _READY[key] = path
    return term_index.read_index(spark, _READY[key], "doc_id")


@query(rf"""
WITH words AS (
  SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda t: t <> '')) AS term
  FROM documents WHERE text IS NOT NULL),
num AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL)
SELECT term, count(DISTINCT doc_id) AS n_documents,
  round(ln((max(n) + 1.0) / (count(DISTINCT doc_id) + 1.0)), 6) AS idf
FROM words, num GROUP BY term
""")
def build_term_index(spark: SparkSession, folder: str) -> DataFrame:
    """The load of an index: its terms, with the postings that its levels hold."""
    docs = spread_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    index = term_index.index_terms(docs, "text", "doc_id", scratch_path(spark, "terms"))
    held = F.aggregate("levels", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    everywhere = F.when(F.col("idf") <= 0, F.lit(index.documents).cast("long"))
    return index.read("terms").select(
        "term", F.coalesce(everywhere, held).alias("n_documents"), F.round("idf", 6).alias("idf")
    )


@query(f"""
WITH {sql_term_search("documents", "doc_id", "text", _SQL_FIRST_ITEM, K, "lang = 'de'")}
SELECT CAST(rank AS INT) AS rank, doc_id, source, round(score, 6) AS score
FROM hits JOIN documents ON doc_id = id
""")
def indexed_search(spark: SparkSession, folder: str) -> DataFrame:
    """The same index asked for rows of one language."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    where = F.col("lang") == "de"
    hits = term_index.search_terms(_ready_index(spark, folder), docs, _first_item(spark, folder), K, where)
    return _rounded(hits.select("rank", "doc_id", "source", "score"))


@query(f"""
WITH {SQL_GOLD}, {sql_term_search("gold", "id", "combined_text", _SQL_FIRST_ITEM, K)}
SELECT {SQL_CARD} FROM hits JOIN gold USING (id)
""")
def search_cards(spark: SparkSession, folder: str) -> DataFrame:
    gold = materialize(enriched(spark, folder), "gold")
    return documents.search_gold(gold, _first_item(spark, folder), K)


_LETTERS = " aeinorst"


def _letter_vectors():
    """A small encoder: how often each of some letters occurs, and the length."""
    import numpy

    def model(texts: list[str]):
        counts = [[t.count(c) for c in _LETTERS] + [len(t)] for t in texts]
        return numpy.array(counts, dtype="float32").reshape(len(texts), len(_LETTERS) + 1)

    return model


def _sql_letter_vector(text: str) -> str:
    counts = [f"length({text}) - length(replace({text}, '{c}', ''))" for c in _LETTERS]
    return f"CAST([{', '.join(counts)}, length({text})] AS DOUBLE[])"


@query(f"""
WITH {SQL_GOLD}, ask AS (SELECT '1991' AS q),
scores AS (
  SELECT id, round(list_cosine_similarity({_sql_letter_vector("combined_text")}, {_sql_letter_vector("q")}), 9)
    AS score FROM gold, ask WHERE year(release_date) = 1991),
hits AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scores
         WHERE score IS NOT NULL ORDER BY rank LIMIT {K})
SELECT {SQL_CARD} FROM hits JOIN gold USING (id)
""")
def search_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents are loaded with vectors, and the query goes through the same encoder."""
    ship_package(spark)
    gold, target = scratch_path(spark, "gold"), scratch_path(spark, "documents")
    write_table(enriched(spark, folder), f"{gold}/{MOVIES_TABLE}")
    documents.gold_to_documents(spark, gold, target, load_encoder=_letter_vectors)
    shape = documents.build_documents(spark.read.parquet(f"{gold}/{MOVIES_TABLE}")).schema
    stored = spark.read.schema(shape.add("vector", T.ArrayType(T.FloatType()))).json(target)
    return documents.search_documents(stored, "1991", _letter_vectors, K, "year")


@query()
def latent_search(spark: SparkSession, folder: str) -> DataFrame:
    """An encoder is learned from all texts, they are encoded with it, and so is the query."""
    ship_package(spark)
    docs = spread_table(spark, folder, "documents", "doc_id").select("doc_id", "lang", "text")
    load = latent.fit_latent(docs, "text").encoder()
    asked = load()([_first_item(spark, folder)])[0]
    hits = search.nearest(encode.encode(docs, "text", load), "doc_id", encode.VECTOR_COLUMN, asked, K)
    return _rounded(hits.select("rank", "doc_id", "lang", "score"))
