"""Tolerant parsing of dates, numbers, amounts and ids.

Each parser first tests the shape of the value and then converts with a
``try_`` function, so a bad value becomes null (or the default) under any ANSI
setting and no formatter exception is thrown on the common path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gildmill.functions.text import quoted, stepwise

# Accepted shapes.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
ISO_DAY_LOOSE = r"^(\d{4}-\d{1,2}-\d{1,2})$"
ISO_DATE_TIME = r"^(\d{4}-\d{1,2}-\d{1,2})[T ]\d{1,2}:\d{2}.*$"
SLASHED_DAY = r"^(\d{4})/(\d{1,2})/(\d{1,2})$"
US_DAY = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
EU_DAY = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
SHORT_MONTH_DAY = r"^[A-Za-z]{3} \d{1,2}, \d{4}$"
SHORT_MONTH_FORMAT = "MMM d, yyyy"
MONTH_NAME_DAY = r"^[A-Za-z]+ \d{1,2}, \d{4}$"
MONTH_NAME_FORMAT = "MMMM d, yyyy"
AMOUNT = r"^\s*-?\s*([€$£]|[A-Z]{3})?\s*-?[\d.,\s]*\d[\d.,\s]*([€$£]|[A-Z]{3})?\s*$"
EURO_CODE = r"^[\s-]*EUR|EUR\s*$"
NOT_AMOUNT = r"[^0-9.,\-]"
DOTS_GROUP = r"\..*[,.]"
EURO_TAIL = r"(^-?\d{1,3}\.\d{3}|,\d{1,2})$"
RFC3339_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def dotted_to_dashed(c: Column) -> Column:
    return F.translate(c, ".", "-")


def parse_iso_date(c: Column) -> Column:
    """``1995-10-30`` and ``1995.10.30``; anything else is null."""
    return stepwise(
        dotted_to_dashed(c), lambda t: F.when(t.rlike(ISO_DAY), t.try_cast("date"))
    )


_DAY = f"""t -> CASE
  WHEN rlike(t, {quoted(ISO_DAY_LOOSE)}) THEN try_cast(t AS DATE)
  WHEN rlike(t, {quoted(SLASHED_DAY)}) THEN try_cast(translate(t, '/', '-') AS DATE)
  WHEN rlike(t, {quoted(US_DAY)}) THEN try_cast(regexp_replace(t, {quoted(US_DAY)}, '$3-$1-$2') AS DATE)
  WHEN rlike(t, {quoted(EU_DAY)}) THEN try_cast(regexp_replace(t, {quoted(EU_DAY)}, '$3-$2-$1') AS DATE)
  WHEN rlike(t, {quoted(SHORT_MONTH_DAY)}) THEN try_to_date(t, {quoted(SHORT_MONTH_FORMAT)})
  WHEN rlike(t, {quoted(MONTH_NAME_DAY)}) THEN try_to_date(t, {quoted(MONTH_NAME_FORMAT)})
  WHEN rlike(t, {quoted(ISO_DATE_TIME)})
  THEN try_cast(regexp_extract(t, {quoted(ISO_DATE_TIME)}, 1) AS DATE) END"""


def parse_date(c: Column) -> Column:
    """ISO, dotted, slashed ``y/M/d``, US ``M/d/y``, European ``d-M-y`` and month-name dates.

    The separator decides the order, so one pattern applies to each value.
    """
    return stepwise(dotted_to_dashed(F.trim(c)), _DAY)


def parse_number(c: Column) -> Column:
    """Plain decimal text to double; ``NaN``, ``Infinity`` and ``12f`` are null."""
    return stepwise(F.trim(c.cast("string")), _NUMBER)


def _bounded(default: float | None, minimum: float | None):
    def apply(v: Column) -> Column:
        if minimum is not None:
            v = F.when(v >= minimum, v)
        return v if default is None else F.coalesce(v, F.lit(float(default)))

    return apply


def parse_currency(
    c: Column, default: float | None = 0.0, minimum: float | None = None
) -> Column:
    """Amounts with ``$``, grouping commas and spaces."""
    bare = F.regexp_replace(c.cast("string"), r"[\$,\s]", "")
    return stepwise(bare, _NUMBER, _bounded(default, minimum))


_AMOUNT_PARTS = f"""t -> CASE WHEN rlike(t, {quoted(AMOUNT)}) THEN named_struct(
  'euro', contains(t, '€') OR rlike(t, {quoted(EURO_CODE)}),
  'body', regexp_replace(t, {quoted(NOT_AMOUNT)}, '')) END"""
_PLAIN_AMOUNT = f"""p -> CASE
  WHEN rlike(p.body, {quoted(DOTS_GROUP)}) OR (p.euro AND rlike(p.body, {quoted(EURO_TAIL)}))
  THEN translate(p.body, ',.', '.') ELSE translate(p.body, ',', '') END"""
_NUMBER = f"t -> CASE WHEN rlike(t, {quoted(NUMBER)}) THEN try_cast(t AS DOUBLE) END"


def parse_currency_intl(
    c: Column, default: float | None = 0.0, minimum: float | None = None
) -> Column:
    """Amounts in either grouping style, with a sign or a three-letter code on either side.

    Dots group and the comma is the decimal sign when a dot stands before a
    comma, when there are several dots, or when a euro amount ends in ``.ddd``
    or ``,d``/``,dd``. Otherwise commas group. A lone ``1.500`` stays decimal.
    """
    steps = [_AMOUNT_PARTS, _PLAIN_AMOUNT, _NUMBER, _bounded(default, minimum)]
    return stepwise(c.cast("string"), *steps)


def positive_or_null(c: Column) -> Column:
    return stepwise(F.trim(c.cast("string")), _NUMBER, "v -> CASE WHEN v > 0 THEN v END")


def plausible(v: Column, low: float, high: float) -> Column:
    """The number when inside the closed range, else null."""
    return stepwise(v, lambda x: F.when(x.between(low, high), x))


def normalize_id(c: Column) -> Column:
    """Text id without a float tail: ``862.0`` becomes ``862``; blank becomes null."""
    t = F.trim(c.cast("string"))
    bare = F.when(t.endswith("0"), F.regexp_replace(t, r"\.0+$", "")).otherwise(t)
    return F.when(t != "", bare)


def imdb_id(c: Column) -> Column:
    """``tt`` and the digits padded to seven; longer numbers keep all digits."""
    return stepwise(
        F.regexp_replace(normalize_id(c), "^tt", ""),
        lambda d: F.concat(F.lit("tt"), F.lpad(d, F.greatest(F.lit(7), F.length(d)), "0")),
    )


def rfc3339_date(c: Column) -> Column:
    """A date as midnight UTC text; null stays null."""
    return F.concat(c.cast("date").cast("string"), F.lit("T00:00:00Z"))


def rfc3339_timestamp(c: Column) -> Column:
    """A zone-less timestamp read as UTC; a fraction is printed only when present."""
    wall = c.cast("timestamp_ntz")
    fraction = F.date_format(wall, "SSSSSS")
    return F.concat(
        F.date_format(wall, RFC3339_SECONDS),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("Z"),
    )


def rfc3339_text(c: Column) -> Column:
    """Text holding an ISO day or zone-less date-time; other text stays, blank is null."""
    t = F.nullif(F.trim(c), F.lit(""))
    day_like = t.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$")
    parsed = F.when(day_like, t.try_cast("timestamp_ntz"))
    return F.coalesce(rfc3339_timestamp(parsed), t)
