"""Text, date, number and nested-list expressions.

Dirty input is made inside each query from clean columns by a fixed rule, so the
clean column is the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.functions import nested, parsing, text
from gildmill.operators import filters
from gildmill.queries.registry import (
    query,
    sql_flat,
    sql_list_text,
    sql_words,
    spread_table,
    table,
    words,
)

PRIORITY = "o_orderpriority"


def _by_priority(urgent: Column, high: Column, medium: Column, unset: Column, low: Column):
    """One of five renderings, chosen by the order's priority."""
    p = F.col(PRIORITY)
    return (
        F.when(p == "1-URGENT", urgent)
        .when(p == "2-HIGH", high)
        .when(p == "3-MEDIUM", medium)
        .when(p == "4-NOT SPECIFIED", unset)
        .otherwise(low)
    )


def _mixed_dates(d: Column) -> Column:
    return _by_priority(
        F.date_format(d, "yyyy-MM-dd"),
        F.date_format(d, "M/d/yyyy"),
        F.date_format(d, "dd-MM-yyyy"),
        F.date_format(d, "yyyy.MM.dd"),
        F.date_format(d, "MMMM d, yyyy"),
    )


@query("""
SELECT o_orderkey, CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED')
  THEN CAST(o_orderdate AS DATE) END AS VARCHAR) AS parsed
FROM orders
""")
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    orders = spread_table(spark, folder, "orders", "o_orderkey").withColumn("raw", _mixed_dates(F.col("o_orderdate")))
    return orders.select("o_orderkey", parsing.parse_iso_date(F.col("raw")).cast("string").alias("parsed"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed FROM orders")
def parse_dates_multi(spark: SparkSession, folder: str) -> DataFrame:
    orders = spread_table(spark, folder, "orders", "o_orderkey").withColumn("raw", _mixed_dates(F.col("o_orderdate")))
    return orders.select("o_orderkey", parsing.parse_date(F.col("raw")).cast("string").alias("parsed"))


@query("""
WITH d AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
                  ELSE CAST(o_orderdate AS DATE) END AS day FROM orders)
SELECT o_orderkey, CAST(day AS VARCHAR) AS day FROM d
WHERE day IS NULL OR year(day) BETWEEN 1996 AND 1998
""")
def date_range_keep_null(spark: SparkSession, folder: str) -> DataFrame:
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    orders = spread_table(spark, folder, "orders", "o_orderkey").select("o_orderkey", day.alias("day"))
    kept = orders.where(filters.years_or_null(F.col("day"), 1996, 1998))
    return kept.withColumn("day", F.col("day").cast("string"))


@query("SELECT event_id, value FROM events WHERE value BETWEEN 0.5 AND 5.0")
def numeric_range(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "value")
    return events.where(filters.in_range(F.col("value"), 0.5, 5.0))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 0.0
  ELSE round(o_totalprice, 2) END AS amount
FROM orders
""")
def parse_currency(spark: SparkSession, folder: str) -> DataFrame:
    grouped = F.format_number("o_totalprice", 2)
    raw = _by_priority(
        F.col("o_totalprice").cast("decimal(20,2)").cast("string"),
        F.concat(F.lit("$"), grouped),
        F.concat(F.lit(" $ "), grouped, F.lit(" ")),
        grouped,
        F.lit("unknown"),
    )
    orders = spread_table(spark, folder, "orders", "o_orderkey")
    return orders.select("o_orderkey", F.round(parsing.parse_currency(raw), 2).alias("amount"))


@query("SELECT o_orderkey, round(o_totalprice, 2) AS amount FROM orders")
def parse_currency_intl(spark: SparkSession, folder: str) -> DataFrame:
    grouped = F.format_number("o_totalprice", 2)
    european = F.translate(grouped, ".,", ",.")
    raw = _by_priority(
        F.concat(F.lit("$"), grouped),
        F.concat(F.lit("€"), european),
        F.concat(grouped, F.lit(" USD")),
        F.concat(european, F.lit(" EUR")),
        F.concat(F.lit("  "), F.col("o_totalprice").cast("decimal(20,2)").cast("string")),
    )
    other_side = _by_priority(
        F.concat(grouped, F.lit("$")),
        F.concat(european, F.lit(" €")),
        F.concat(F.lit("USD "), grouped),
        F.concat(F.lit("EUR "), european),
        F.concat(european, F.lit("€")),
    )
    raw = F.when(F.col("o_orderkey") % 2 == 0, raw).otherwise(other_side)
    orders = spread_table(spark, folder, "orders", "o_orderkey")
    return orders.select("o_orderkey", F.round(parsing.parse_currency_intl(raw), 2).alias("amount"))


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' AND c_acctbal > 0 THEN c_acctbal END AS balance
FROM customer
""")
def positive_or_null(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("NaN")).otherwise(
        F.col("c_acctbal").cast("string")
    )
    return table(spark, folder, "customer").select(
        "c_custkey", parsing.positive_or_null(raw).alias("balance")
    )


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 5 AND 40 THEN CAST(p_size AS DOUBLE) END AS size FROM part")
def numeric_plausible(spark: SparkSession, folder: str) -> DataFrame:
    size = parsing.parse_number(F.concat(F.lit(" "), F.col("p_size").cast("string")))
    return table(spark, folder, "part").select(
        "p_partkey", parsing.plausible(size, 5.0, 40.0).alias("size")
    )


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id,
       'tt' || lpad(CAST(p_partkey AS VARCHAR),
         CAST(greatest(7, length(CAST(p_partkey AS VARCHAR))) AS INT), '0') AS imdb_id
FROM part
""")
def normalize_ids(spark: SparkSession, folder: str) -> DataFrame:
    stored = F.concat(F.lit(" "), F.col("p_partkey").cast("double").cast("decimal(20,1)").cast("string"))
    return table(spark, folder, "part").select(
        parsing.normalize_id(stored).alias("id"), parsing.imdb_id(stored).alias("imdb_id")
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS released FROM orders")
def rfc3339_date(spark: SparkSession, folder: str) -> DataFrame:
    return spread_table(spark, folder, "orders", "o_orderkey").select(
        "o_orderkey", parsing.rfc3339_date(F.col("o_orderdate")).alias("released")
    )


@query("""
SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS at
FROM events
""")
def rfc3339_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", parsing.rfc3339_timestamp(F.col("ts")).alias("at")
    )


@query(f"SELECT doc_id, {sql_flat('text')} AS text FROM documents")
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    dirty = F.concat(F.lit("  "), F.replace(F.col("text"), F.lit(" "), F.lit(" \t ")), F.lit("\n"))
    return spread_table(spark, folder, "documents", "doc_id").select("doc_id", text.clean_text(dirty).alias("text"))


@query(rf"""
SELECT doc_id, {sql_flat("regexp_replace(text, '[^\x00-\x7F]', '', 'g')")} AS text FROM documents
""")
def strip_non_ascii(spark: SparkSession, folder: str) -> DataFrame:
    return spread_table(spark, folder, "documents", "doc_id").select(
        "doc_id", text.clean_text(F.col("text"), repair=False, strip_non_ascii=True).alias("text")
    )


@query("SELECT doc_id, text FROM documents")
def repair_mojibake(spark: SparkSession, folder: str) -> DataFrame:
    misread = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    return spread_table(spark, folder, "documents", "doc_id").select("doc_id", text.repair_mojibake(misread).alias("text"))


@query(f"""
WITH d AS (SELECT doc_id, {sql_flat("text")} AS t FROM documents)
SELECT doc_id, CASE WHEN t IS NULL OR t = '' THEN '(no overview available)'
  WHEN length(t) <= 240 THEN t
  ELSE regexp_extract(t, '^(.{{0,237}}) ', 1) || '...' END AS card
FROM d
""")
def snippet(spark: SparkSession, folder: str) -> DataFrame:
    return spread_table(spark, folder, "documents", "doc_id").select("doc_id", text.snippet(F.col("text")).alias("card"))


@query(f"""
SELECT doc_id, trim(regexp_replace(concat_ws(' ', nullif(source, 'src7'), nullif(lang, 'en'),
  {sql_flat("text")}, array_to_string(list_slice({sql_words("text")}, 1, 3), ' ')), ' +', ' ', 'g')) AS body
FROM documents
""")
def combined_text(spark: SparkSession, folder: str) -> DataFrame:
    blank_source = F.when(F.col("source") != "src7", F.col("source")).otherwise(F.lit("  "))
    some_lang = F.when(F.col("lang") != "en", F.col("lang"))
    body = text.join_text(
        blank_source,
        some_lang,
        text.collapse_whitespace(F.col("text")),
        F.array_join(F.slice(words(F.col("text")), 1, 3), " "),
    )
    return spread_table(spark, folder, "documents", "doc_id").select("doc_id", body.alias("body"))


def _conversation_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Each turn with the words of its text as list text."""
    c = spread_table(spark, folder, "conversations", "conv_id", "turn")
    return c.select("conv_id", "turn", "role", nested.to_list_text(words(F.col("text"))).alias("list_text"))


_SQL_LIST = sql_list_text(sql_words("text"))
_SQL_NAMES = f"list_filter({sql_words('text')}, lambda w: w <> '')"


@query(f"""
SELECT conv_id, turn, CASE WHEN role = 'user' THEN {_SQL_LIST} ELSE '[]' END AS list_text
FROM conversations
""")
def validate_list_text(spark: SparkSession, folder: str) -> DataFrame:
    full = F.col("list_text")
    broken = (
        F.when(F.col("role") == "user", full)
        .when(F.col("role") == "assistant", F.substring_index(full, "]", 1))
    )
    lists = _conversation_lists(spark, folder)
    return lists.select("conv_id", "turn", nested.validate_list_text(broken).alias("list_text"))


@query(f"""
SELECT conv_id, turn, CASE WHEN role = 'system' THEN '' ELSE array_to_string({_SQL_NAMES}, ' ') END AS names
FROM conversations
""")
def repair_list_text(spark: SparkSession, folder: str) -> DataFrame:
    full = F.col("list_text")
    bare = F.regexp_replace(full, r"^\[|\]$", "")
    broken = (
        F.when(F.col("role") == "user", bare)
        .when(F.col("role") == "assistant", F.concat(F.lit("["), bare, F.lit(", {'name': 'cut of")))
    )
    lists = _conversation_lists(spark, folder)
    items = nested.parse_list_text(nested.repair_list_text(broken), ["name"])
    return lists.select("conv_id", "turn", F.array_join(nested.names_of(items), " ").alias("names"))


# An object with a keyword inside and outside quotes, quotes, a backslash and an escape.
_HARD_OBJECT = r"""{'id': None, "kind": "O'None, True", 'name': 'L\'%s \\ x\xe9', 'adult': False}"""


@query(rf"""
SELECT conv_id, turn, CAST(len({sql_words("text")}) AS BIGINT) AS n_items,
  array_to_string(list_transform({sql_words("text")}, lambda w: 'L''' || w || ' \ xé'), '|') AS names,
  'O''None, True' AS first_kind
FROM conversations
""")
def parse_list_text(spark: SparkSession, folder: str) -> DataFrame:
    turns = spread_table(spark, folder, "conversations", "conv_id", "turn")
    raw = nested.to_list_text(words(F.col("text")), _HARD_OBJECT)
    items = nested.parse_list_text(raw, ["name", "kind"])
    return turns.select("conv_id", "turn", items.alias("items")).select(
        "conv_id",
        "turn",
        F.size("items").cast("bigint").alias("n_items"),
        F.array_join(F.transform("items", lambda x: x["name"]), "|").alias("names"),
        F.get(F.col("items"), F.lit(0))["kind"].alias("first_kind"),
    )


@query(f"SELECT conv_id, turn, array_to_string({_SQL_NAMES}, '|') AS names FROM conversations")
def extract_names(spark: SparkSession, folder: str) -> DataFrame:
    items = nested.parse_list_text(F.col("list_text"), ["name"])
    return _conversation_lists(spark, folder).select(
        "conv_id", "turn", F.array_join(nested.names_of(items), "|").alias("names")
    )


@query(f"SELECT conv_id, turn, array_to_string({_SQL_NAMES}, '|') AS names FROM conversations")
def variant_names(spark: SparkSession, folder: str) -> DataFrame:
    """The names of lists whose shape is not declared."""
    lists = _conversation_lists(spark, folder)
    names = nested.variant_names(nested.parse_list_variant(F.col("list_text")))
    return lists.select("conv_id", "turn", F.array_join(names, "|").alias("names"))


@query(f"""
SELECT conv_id, turn,
  array_to_string(list_filter(list_slice({sql_words('text')}, 1, 5), lambda w: w <> ''), '|') AS names
FROM conversations
""")
def top_k_of_array(spark: SparkSession, folder: str) -> DataFrame:
    items = nested.parse_list_text(F.col("list_text"), ["name"])
    return _conversation_lists(spark, folder).select(
        "conv_id", "turn", F.array_join(nested.top_names(items, 5), "|").alias("names")
    )


def crew_text(role: Column, body: Column) -> Column:
    """Crew list text of one turn: an editor, an assistant director, then a director."""
    name = F.replace(F.element_at(words(body), -1), F.lit("'"), F.lit("\\'"))
    return F.concat(
        F.lit("[{'job': 'Editor', 'name': 'Ed'}, {'job': 'Assistant Director', 'name': '"),
        role,
        F.lit("'}, {'job': 'Director', 'name': '"),
        name,
        F.lit("', 'id': None}]"),
    )


@query(f"""
SELECT conv_id, turn, {sql_words('text')}[-1] AS director, role AS any_director FROM conversations
""")
def first_match_in_array(spark: SparkSession, folder: str) -> DataFrame:
    crew = nested.parse_list_text(crew_text(F.col("role"), F.col("text")), ["name", "job"])
    items = spread_table(spark, folder, "conversations", "conv_id", "turn").select("conv_id", "turn", crew.alias("crew"))
    return items.select(
        "conv_id",
        "turn",
        nested.first_match(F.col("crew"), "director").alias("director"),
        nested.first_match(F.col("crew"), "director", match="contains").alias("any_director"),
    )
