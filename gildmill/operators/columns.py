"""Column shaping: casts, guarded rewrites, defaults for absent sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cast_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def rewrite_present(
    df: DataFrame, columns: list[str], rewrite: Callable[[Column], Column]
) -> DataFrame:
    """Apply ``rewrite`` to those of ``columns`` that the table has, in one projection."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: rewrite(F.col(c)) for c in present}) if present else df


def with_defaults(df: DataFrame, defaults: dict[str, tuple[object, str]]) -> DataFrame:
    """Add each absent column as a typed constant: ``{name: (value, type)}``."""
    absent = {n: d for n, d in defaults.items() if n not in df.columns}
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in absent.items()}) if absent else df


def empty_like(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A zero-row table with the given column types."""
    schema = ", ".join(f"`{n}` {t}" for n, t in columns.items())
    return df.sparkSession.createDataFrame([], schema)
