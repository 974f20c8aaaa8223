"""Filters, dedup, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.functions.text import fold_key_no_punctuation
from gildmill.operators import aggregates, dedup, external, filters, joins
from gildmill.operators.filter_store import write_filter_store
from gildmill.queries.registry import ORACLES, day_text, query, spread_table, table, words
from gildmill.shipping import ship_package
from gildmill.sources.writers import scratch_path


@query("SELECT DISTINCT text, lang FROM documents")
def dedup_exact(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.distinct_rows(table(spark, folder, "documents").select("text", "lang"))


def _titled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a shouted or padded title; one source has no language."""
    title = F.when(F.col("lang") == "en", F.upper("text")).otherwise(
        F.concat(F.lit("  "), F.col("text"), F.lit(" "))
    )
    lang = F.when(F.col("source") != "src7", F.col("lang"))
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", title.alias("title"), lang.alias("lang"))


_SQL_TITLED = """
titled AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN upper(text) ELSE '  ' || text || ' ' END AS title,
         CASE WHEN source <> 'src7' THEN lang END AS lang
  FROM documents)"""


@query(f"""
WITH {_SQL_TITLED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lower(trim(title)), lang ORDER BY doc_id) AS rn FROM titled)
SELECT doc_id, lang FROM ranked WHERE rn = 1 OR lang IS NULL
""")
def dedup_near(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup.near_duplicates_removed(
        _titled(spark, folder), "title", ["lang"], ["doc_id"], ["doc_id"]
    )
    return kept.select("doc_id", "lang")


@query(rf"""
WITH titled AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN text || '.' ELSE '«' || text || '»' END AS title FROM documents),
folded AS (
  SELECT doc_id, trim(regexp_replace(lower(title), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')) AS k FROM titled),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS rn FROM folded)
SELECT doc_id FROM ranked WHERE rn = 1 OR k = ''
""")
def dedup_near_punct(spark: SparkSession, folder: str) -> DataFrame:
    title = F.when(F.col("lang") == "en", F.concat("text", F.lit("."))).otherwise(
        F.concat(F.lit("«"), "text", F.lit("»"))
    )
    docs = spread_table(spark, folder, "documents", "doc_id").select("doc_id", title.alias("title"))
    return dedup.near_duplicates_removed(
        docs, "title", None, ["doc_id"], ["doc_id"], fold_key_no_punctuation
    ).select("doc_id")


@query("""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events)
SELECT user_id, event_id, event_type, value FROM ranked WHERE rn = 1
""")
def dedup_by_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return dedup.first_per_key(events, ["user_id"], [F.desc("ts"), F.col("event_id")]).drop("ts")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, o_custkey AS custkey
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def key_map_join(spark: SparkSession, folder: str) -> DataFrame:
    facts = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = table(spark, folder, "orders")
    mapping = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return joins.map_keys(facts, mapping, "l_orderkey", "o_custkey", "custkey").drop("o_custkey")


@query("""
SELECT l_partkey, round(avg(l_quantity), 6) AS avg_rating, count(l_quantity) AS rating_count
FROM lineitem GROUP BY l_partkey
""")
def rating_agg(spark: SparkSession, folder: str) -> DataFrame:
    agg = aggregates.mean_and_count(table(spark, folder, "lineitem"), "l_partkey", "l_quantity")
    return agg.withColumn("avg_rating", F.round("avg_rating", 6))


@query("""
WITH a AS (SELECT user_id, avg(value) AS m, count(value) AS n FROM events GROUP BY user_id)
SELECT c_custkey, c_name, round(m, 6) AS avg_rating, coalesce(n, 0) AS rating_count
FROM customer LEFT JOIN a ON user_id = c_custkey
""")
def left_join_agg(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumnRenamed("user_id", "c_custkey")
    agg = aggregates.mean_and_count(events, "c_custkey", "value")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    joined = aggregates.left_join_aggregate(customer, agg, "c_custkey")
    return joined.withColumn("avg_rating", F.round("avg_rating", 6))


def _unique_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup.first_per_key(docs, [dedup.digest(F.col("text"))], ["doc_id"])


_SQL_UNIQUE = "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text"


@query(f"SELECT doc_id, quality, toxic FROM labels WHERE doc_id IN ({_SQL_UNIQUE})")
def orphan_removal(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    return joins.drop_orphans(labels, _unique_documents(spark, folder), "doc_id")


@query(f"""
WITH u AS ({_SQL_UNIQUE})
SELECT doc_id, 'no_parent' AS reason, count(*) AS n_rows FROM labels
WHERE doc_id NOT IN (SELECT doc_id FROM u) GROUP BY doc_id
UNION ALL
SELECT doc_id, 'no_child', 1 FROM u WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def orphan_report(spark: SparkSession, folder: str) -> DataFrame:
    return joins.orphan_report(
        table(spark, folder, "labels"), _unique_documents(spark, folder), "doc_id"
    )


@query("""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)
SELECT d.doc_id, d.lang, t.role, length(t.text) AS first_turn_chars, l.quality
FROM documents d LEFT JOIN t ON t.conv_id = d.doc_id AND rn = 1
LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def left_enrich(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    turns = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        "turn",
        "role",
        F.length("text").cast("bigint").alias("first_turn_chars"),
    )
    labels = table(spark, folder, "labels")
    side = {"role": "string", "first_turn_chars": "bigint"}
    df = joins.left_enrich(docs, turns, "doc_id", side, ["turn"])
    return joins.left_enrich(df, labels, "doc_id", {"quality": "int"})


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE lower(trim(p_brand)) = 'brand#7'")
def search_filter_equal(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    return part.where(filters.search_filter("p_brand", " BRAND#7 ", text_fields=("p_brand",)))


@query(r"""
SELECT doc_id, lang FROM documents
WHERE list_contains(string_split(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), ' '), 'with')
""")
def search_filter_member(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_table(spark, folder, "documents", "doc_id").withColumn("names", words(F.col("text")))
    kept = docs.where(filters.search_filter("names", "With", array_fields=("names",)))
    return kept.select("doc_id", "lang")


@query("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE year(o_orderdate) = 1997
""")
def search_filter_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    kept = orders.where(filters.search_filter("year", "1997", date_fields={"year": "o_orderdate"}))
    return kept.select("o_orderkey", day_text(F.col("o_orderdate")).alias("day"))


@query(ORACLES["search_filter_equal"])
def stored_filter_equal(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    store = write_filter_store(part, scratch_path(spark, "store"), "p_partkey", text_fields=("p_brand",))
    return store.search("p_brand", " BRAND#7 ")


@query(ORACLES["search_filter_member"])
def stored_filter_member(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_table(spark, folder, "documents", "doc_id").withColumn("names", words(F.col("text")))
    docs = docs.select("doc_id", "lang", "names")
    store = write_filter_store(docs, scratch_path(spark, "store"), "doc_id", array_fields=("names",))
    return store.search("names", "With").select("doc_id", "lang")


@query(ORACLES["search_filter_year"])
def stored_filter_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    store = write_filter_store(orders, scratch_path(spark, "store"), "o_orderkey", date_field="day")
    return store.search("year", "1997").select("o_orderkey", day_text(F.col("day")).alias("day"))


def _score_service():
    """Stand-in for an outside service: a pure function of the key."""

    def fetch(key):
        if key % 10 == 3:
            raise LookupError("no such key")
        return {"score": int(key) * 2, "name": f"S{key}"}

    return fetch


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey,
  CASE WHEN l_suppkey % 10 <> 3 THEN l_suppkey * 2 END AS score,
  CASE WHEN l_suppkey % 10 <> 3 THEN 'S' || l_suppkey END AS name,
  CASE WHEN l_suppkey % 10 = 3 THEN 'LookupError: no such key' END AS lookup_error
FROM lineitem
""")
def external_enrich(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import types as T

    ship_package(spark)
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    fields = T.StructType(
        [T.StructField("score", T.LongType()), T.StructField("name", T.StringType())]
    )
    return external.enrich_external(lines, "l_suppkey", _score_service, fields)
