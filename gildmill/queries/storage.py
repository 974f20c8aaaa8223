"""Sources, sinks and row accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.functions.text import clean_text
from gildmill.operators import aggregates, dedup, filters, joins, metrics
from gildmill.queries.registry import day_text, query, spread_table, sql_flat, table
from gildmill.shipping import ship_package
from gildmill.sources import readers, writers
from gildmill.sources.split_csv import read_split_csv

PARTITIONS_TO_A_FILE = 4


def write_csv(df: DataFrame, path: str) -> str:
    """Headered CSV with doubled quotes, as the readers expect it."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("o_orderdate", day_text(F.col("o_orderdate")))
    path = write_csv(orders, writers.scratch_path(spark, "csv"))
    read = readers.read_csv(spark, path, readers.text_schema(orders.columns))
    return read.withColumns(
        {
            "o_orderkey": F.col("o_orderkey").try_cast("bigint"),
            "o_custkey": F.col("o_custkey").try_cast("bigint"),
            "o_totalprice": F.col("o_totalprice").try_cast("double"),
        }
    )


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def csv_header_order(spark: SparkSession, folder: str) -> DataFrame:
    """Two paths, each with its own column order; one lacks an optional column."""
    orders = table(spark, folder, "orders")
    odd = F.col("o_orderkey") % 2 == 1
    columns = ["o_orderpriority", "o_totalprice", "o_orderkey", "o_orderstatus"]
    first = orders.where(odd).select(*columns)
    second = orders.where(~odd).select("o_orderstatus", "o_orderkey", "o_custkey")
    paths = [write_csv(df, writers.scratch_path(spark, "csv")) for df in (first, second)]
    schema = readers.text_schema(["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return readers.read_csv(spark, paths, schema, required=["o_orderkey", "o_orderstatus"])


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def csv_multiline_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string"), "text", "lang")
    path = write_csv(docs, writers.scratch_path(spark, "csv-multiline"))
    return readers.read_csv(spark, path, readers.text_schema(docs.columns), multi_line=True)


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def csv_split_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same in few large files, each of which many tasks read.

    A file is written by one task, so it holds some partitions of the scan and no more.
    """
    ship_package(spark)
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string"), "text", "lang")
    files = -(-docs.rdd.getNumPartitions() // PARTITIONS_TO_A_FILE)
    path = write_csv(docs.coalesce(max(1, files)), writers.scratch_path(spark, "csv-split"))
    return read_split_csv(spark, path, readers.text_schema(docs.columns))


@query("""
SELECT c_custkey, c_name, n_name, CAST(NULL AS VARCHAR) AS note
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def optional_source(spark: SparkSession, folder: str) -> DataFrame:
    root = folder.rstrip("/")
    nation = readers.read_optional_parquet(spark, f"{root}/nation.parquet")
    notes = readers.read_optional_parquet(spark, f"{root}/no_such_table.parquet")
    customer = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    df = joins.left_enrich(customer, nation, "n_nationkey", {"n_name": "string"})
    df = joins.left_enrich(df, notes, "c_custkey", {"note": "string"})
    return df.select("c_custkey", "c_name", "n_name", "note")


@query("""
SELECT c_custkey, CAST(NULL AS DOUBLE) AS avg_rating, CAST(0 AS BIGINT) AS rating_count
FROM customer
""")
def missing_side_defaults(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey")
    return aggregates.left_join_aggregate(customer, None, "c_custkey")


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return writers.write_and_read(part, writers.scratch_path(spark, "parquet"))


@query(f"""
SELECT CAST(doc_id AS VARCHAR) AS id, lang, {sql_flat("text")} AS body, CAST(NULL AS VARCHAR) AS note
FROM documents
""")
def document_sink(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_table(spark, folder, "documents", "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        "lang",
        clean_text(F.col("text")).alias("body"),
        F.lit(None).cast("string").alias("note"),
    )
    path = writers.scratch_path(spark, "documents")
    writers.write_documents(docs, path)
    return spark.read.schema(docs.schema).json(path)


@query("""
SELECT count(*) AS rows_in,
       count(*) FILTER (quality IS NULL) AS dropped_no_label,
       count(*) FILTER (quality <> 1) AS dropped_low_quality,
       count(*) FILTER (quality = 1 AND n_chars < 100) AS dropped_short,
       count(*) FILTER (quality = 1 AND n_chars >= 100) AS rows_out
FROM documents LEFT JOIN labels USING (doc_id)
""")
def stage_metrics(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "labels")
    joined = joins.left_enrich(docs, labels, "doc_id", {"quality": "int"})
    rules = {
        "no_label": F.col("quality").isNotNull(),
        "low_quality": F.col("quality") == 1,
        "short": F.col("n_chars") >= 100,
    }
    return metrics.stage_metrics(joined, rules)


@query("""
WITH kept AS (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text)
SELECT (SELECT count(*) FROM documents) AS source_rows,
       (SELECT count(*) FROM kept) AS sink_rows,
       (SELECT count(*) FROM documents d WHERE NOT EXISTS
         (SELECT 1 FROM kept k WHERE k.doc_id = d.doc_id)) AS missing_keys,
       CAST(0 AS BIGINT) AS extra_keys,
       CAST(0 AS BIGINT) AS changed_keys
""")
def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    text_key = dedup.digest(F.col("text"))
    kept = dedup.first_per_key(docs.select("doc_id", "text"), [text_key], ["doc_id"])
    return metrics.reconcile(docs, kept, "doc_id")


@query("""
SELECT doc_id, CASE WHEN lang = 'fr' THEN 'missing' ELSE 'changed' END AS difference FROM documents
WHERE lang = 'fr' OR source = 'src3'
UNION ALL
SELECT -1 - doc_id, 'extra' FROM documents WHERE lang = 'es'
""")
def reconcile_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """A load that lost one language, changed the texts of one source and holds some rows too many."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    loaded = docs.where(F.col("lang") != "fr").withColumn(
        "text", F.when(F.col("source") == "src3", F.concat("text", F.lit("."))).otherwise(F.col("text"))
    )
    extra = docs.where(F.col("lang") == "es").withColumn("doc_id", -1 - F.col("doc_id"))
    return metrics.reconcile_ranges(docs, loaded.unionByName(extra), "doc_id").keys


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part")
def cast_keys(spark: SparkSession, folder: str) -> DataFrame:
    from gildmill.operators.columns import cast_keys as cast

    return cast(table(spark, folder, "part").select("p_partkey", "p_name", "p_brand"), ["p_partkey"])


@query("""
SELECT d.doc_id, l.quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id
WHERE l.quality IS NOT NULL
""")
def require_columns(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id")
    joined = joins.left_enrich(docs, table(spark, folder, "labels"), "doc_id", {"quality": "int"})
    return filters.require_columns(joined, ["quality"])


