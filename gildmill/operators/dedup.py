"""Deterministic duplicate removal.

``row_number() = 1`` is planned with a group limit before the shuffle: each map
task keeps one row per key, so a key that holds a third of all rows sends at
most one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gildmill.functions.text import all_of, fold_key


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; nulls are equal. Combined before the shuffle."""
    return df.distinct()


def total_order(df: DataFrame, first: list[str] | None = None) -> list[Column]:
    """Every column, ``first`` leading; rows that tie are equal in all columns."""
    lead = first or []
    return [F.col(c).asc_nulls_last() for c in [*lead, *[c for c in df.columns if c not in lead]]]


def fullest_first(df: DataFrame, first: list[str] | None = None) -> list[Column]:
    """A total order that prefers, after ``first``, the row with most filled columns.

    Null, blank text and the empty list text count as not filled.
    """
    text = {n for n, t in df.dtypes if t == "string"}

    def filled(name: str) -> str:
        c = f"`{name}`"
        test = f"trim({c}) NOT IN ('', '[]')" if name in text else f"{c} IS NOT NULL"
        return f"if({test}, 1, 0)"

    count = F.expr(" + ".join(filled(n) for n in df.columns))
    lead = [F.col(c).asc_nulls_last() for c in first or []]
    return [*lead, count.desc(), *total_order(df)]


def digest(c: Column) -> Column:
    """A short key in place of a long text; null stays null."""
    return F.sha2(c.cast("binary"), 256)


def first_per_key(
    df: DataFrame, keys: list[str | Column], order_by: list[str | Column] | None = None
) -> DataFrame:
    """The first row of each key under ``order_by`` (default: all columns)."""
    order = total_order(df) if order_by is None else order_by
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def near_duplicates_removed(
    df: DataFrame,
    title: str,
    extra_keys: list[str] | None = None,
    unique_key: list[str] | None = None,
    order_by: list[str | Column] | None = None,
    fold=fold_key,
) -> DataFrame:
    """One row per folded title and extra keys.

    Rows with an empty folded title or a null extra key are unlike each other, so
    they are never merged. Each is its own group by ``unique_key`` (default: all
    columns, which merges equal rows only); that also keeps them out of one hot
    group. The folded title is compared by its SHA-256, so keys stay short however long
    the text is.
    """
    extra_keys = extra_keys or []
    unique = unique_key or df.columns
    folded = F.coalesce(fold(F.col(title)), F.lit(""))
    mergeable = all_of([folded != "", *[F.col(k).isNotNull() for k in extra_keys]])
    apart = [F.when(~mergeable, F.col(c)) for c in unique]
    order = total_order(df, unique_key) if order_by is None else order_by
    return first_per_key(
        df, [mergeable, F.when(mergeable, digest(folded)), *[F.col(k) for k in extra_keys], *apart], order
    )
