"""Query registry: a name, a function of (spark, folder) and optionally its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildmill.functions.text import collapse_whitespace
from gildmill.sources.readers import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, *keys: str) -> DataFrame:
    """A text table ready for heavy per-row work, whatever its file count."""
    return spread(table(spark, folder, name), *keys)


def words(c: Column) -> Column:
    """All words of a text."""
    return F.split(collapse_whitespace(c), " ")


def day_text(c: Column) -> Column:
    return c.cast("date").cast("string")


# SQL fragments shared by the oracles.
def sql_flat(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def sql_words(c: str) -> str:
    return f"string_split({sql_flat(c)}, ' ')"


def sql_list_text(array: str, template: str = "{'name': '%s'}") -> str:
    shape = template.replace("'", "''")
    escaped = r"replace(replace(w, '\', '\\'), '''', '\''')"
    return (
        f"'[' || array_to_string(list_transform({array}, "
        f"lambda w: replace('{shape}', '%s', {escaped})), ', ') || ']'"
    )


def sql_term_search(source: str, doc: str, text: str, query: str, k: int, where: str = "TRUE") -> str:
    """CTEs up to ``hits`` (id, rank, score): TF-IDF cosine of ``query`` over a table, ranks over some rows."""
    return rf"""
ask AS ({query}),
bag AS (SELECT {doc} AS id, {_sql_terms(text)} AS words FROM {source} WHERE {text} IS NOT NULL),
post AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(words) AS term FROM bag) GROUP BY id, term),
num AS (SELECT count(*) AS n FROM bag),
idfs AS (SELECT term, ln((max(n) + 1.0) / (count(*) + 1.0)) AS idf FROM post, num GROUP BY term),
lens AS (SELECT id, sqrt(sum(tf * idf * tf * idf)) AS norm FROM post JOIN idfs USING (term) GROUP BY id),
qtf AS (SELECT term, count(*) AS tf FROM (SELECT unnest({_sql_terms("q")}) AS term FROM ask) GROUP BY term),
qw AS (SELECT term, tf * coalesce(idf, ln(n + 1.0)) AS w, idf FROM qtf LEFT JOIN idfs USING (term), num),
dots AS (SELECT id, sum(tf * qw.idf * w) AS dot FROM post JOIN qw USING (term) GROUP BY id),
scores AS (
  SELECT bag.id, round(coalesce(dot / nullif(norm * (SELECT sqrt(sum(w * w)) FROM qw), 0), 0), 9) AS score
  FROM bag LEFT JOIN lens USING (id) LEFT JOIN dots USING (id)),
hits AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scores
         WHERE id IN (SELECT {doc} FROM {source} WHERE {where}) ORDER BY rank LIMIT {k})"""


def _sql_terms(text: str) -> str:
    broken = rf"string_split_regex(lower({text}), '[^\p{{L}}\p{{M}}\p{{N}}]+')"
    return f"list_filter({broken}, lambda t: t <> '')"
