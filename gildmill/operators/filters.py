"""Row filters. Each is a plain predicate, so Catalyst can push it to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildmill.functions.text import any_of, fold_key


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def _year_start(year: int) -> Column:
    return F.make_date(F.lit(year), F.lit(1), F.lit(1))


def years_or_null(c: Column, first: int, last: int) -> Column:
    """Null dates pass; others must lie in the closed year range."""
    return c.isNull() | ((c >= _year_start(first)) & (c < _year_start(last + 1)))


def in_range(c: Column, low: float, high: float) -> Column:
    """Closed range; null and NaN fail."""
    return c.between(low, high)


def text_equals(c: Column, value: str, exact: bool = False) -> Column:
    return c == value if exact else fold_key(c) == fold_key(F.lit(value))


def array_has(c: Column, value: str, exact: bool = False) -> Column:
    if exact:
        return F.array_contains(c, value)
    return F.exists(c, lambda x: fold_key(x) == fold_key(F.lit(value)))


def in_year(c: Column, year: int) -> Column:
    """Half-open day range, which a scan can use where ``year(c) = y`` can not."""
    return (c >= _year_start(year)) & (c < _year_start(year + 1))


ANY_FIELD = "any"


def search_filter(
    field: str | None,
    value: str,
    text_fields: tuple[str, ...] = ("director",),
    array_fields: tuple[str, ...] = ("top_cast",),
    date_fields: dict[str, str] | None = None,
    exact: bool = False,
) -> Column | None:
    """The predicate of a named search field; None when nothing is filtered."""
    date_fields = {"year": "release_date"} if date_fields is None else date_fields
    if field is None or field == ANY_FIELD:
        return None
    if field in text_fields:
        return text_equals(F.col(field), value, exact)
    if field in array_fields:
        return array_has(F.col(field), value, exact)
    if field in date_fields:
        text = str(value).strip()
        if not (text.isascii() and text.isdigit() and len(text) <= 4):
            raise ValueError(f"{field} must be a whole year, not {value!r}")
        return in_year(F.col(date_fields[field]), int(text))
    known = [ANY_FIELD, *text_fields, *array_fields, *date_fields]
    raise ValueError(f"unknown search field {field!r}; known: {', '.join(known)}")


def non_blank(columns: list[str]) -> Column:
    """True when every column holds text other than whitespace."""
    blank = any_of([F.col(c).isNull() | (F.trim(F.col(c)) == "") for c in columns])
    return ~blank
