r"""Lists of objects held as Python-literal text, parsed without a Python worker.

The text is turned into JSON and read by ``from_json``. Keywords are rewritten
only outside quotes, and each rewrite is guarded by a substring or regex test, so
a plain cell goes straight to the JSON parser. Everything that
printing a Python list of dictionaries can produce is covered; named
``\N{...}`` escapes, which printing never produces, need ``exact=True``.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildmill.functions.text import quoted, stepwise

EMPTY_LIST = "[]"
_BACKSLASH = "\\"
_BLANKS = " \t\r\n"

# Quoted strings (possessive: linear and without deep recursion).
_QUOTED = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
# Python keywords and their JSON forms.
_KEYWORDS = {"None": "null", "True": "true", "False": "false"}
# An even run of backslashes before the one that starts an escape.
_EVEN = r"(?<!\\)((?:\\\\)*+)"
_HEX_ESCAPE = _EVEN + r"\\x([0-9a-fA-F]{2})"
_OTHER_ESCAPE = r"""(?s)""" + _EVEN + r"""\\[^'"\\nrtbfu]"""
_UNKNOWN_ESCAPE = r"""(?s)^\\[^'"\\nrtbfu]"""
# One escape sequence, or a run without backslashes.
_ESCAPE = r"(?s)(\\U[0-9a-fA-F]{8}|\\[0-7]{1,3}|\\.|[^\\]++|\\)"
_JSON_OPTIONS = "map('allowSingleQuotes', 'true', 'allowBackslashEscapingAnyCharacter', 'true')"


def _trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def _bracketed_or(other: str) -> str:
    """A step that keeps bracketed text and replaces other text."""
    return f"""t -> CASE WHEN startswith(t, '[') AND endswith(t, ']') AND length(t) > 1 THEN t
      ELSE {other} END"""


_VALID = _bracketed_or(quoted(EMPTY_LIST))
_COMPLETE_OBJECTS = (
    f"regexp_extract(regexp_replace(t, {quoted('^' + _BACKSLASH + '[')}, ''), "
    f"{quoted(r'(?s)^(.*\})')}, 1)"
)
_REPAIRED = _bracketed_or(f"concat('[', coalesce({_COMPLETE_OBJECTS}, ''), ']')")


def validate_list_text(c: Column) -> Column:
    """The text when it is bracketed, else the empty list."""
    return stepwise(_trimmed(c), _VALID)


def repair_list_text(c: Column) -> Column:
    """Add lost brackets and keep the complete objects of a truncated list."""
    return stepwise(_trimmed(c), _REPAIRED)


def _keyword_to_json(python: str, json: str) -> str:
    """Replace one keyword outside quotes; each match starts where the last one ended."""
    head, tail = python[0], python[1:]
    passed = rf"""(?s)\G((?:[^'"{head}]++|{_QUOTED}|{head}(?!{tail}\b))*+){python}"""
    return f"""t -> CASE WHEN contains(t, {quoted(python)})
      THEN regexp_replace(t, {quoted(passed)}, {quoted("$1" + json)}) ELSE t END"""


_HEX_TO_JSON = rf"""t -> CASE WHEN contains(t, {quoted(_BACKSLASH + "x")})
  THEN regexp_replace(t, {quoted(_HEX_ESCAPE)}, {quoted(r"$1\\u00$2")}) ELSE t END"""

# One token of text split at its escapes.
_ONE_ESCAPE = rf"""CASE
  WHEN NOT startswith(e, {quoted(_BACKSLASH)}) THEN e
  WHEN rlike(e, {quoted(r"^\\U0000.{4}$")}) THEN concat({quoted(_BACKSLASH + "u")}, substring(e, 7, 4))
  WHEN rlike(e, {quoted(r"^\\U00(0[1-9a-fA-F]|10).{4}$")})
  THEN decode(unhex(substring(e, 3, 8)), 'UTF-32')
  WHEN rlike(e, {quoted(r"^\\[0-7]")})
  THEN concat({quoted(_BACKSLASH + "u")}, lpad(conv(substring(e, 2, 3), 8, 16), 4, '0'))
  WHEN e = {quoted(r"\a")} THEN {quoted(r"\u0007")}
  WHEN e = {quoted(r"\v")} THEN {quoted(r"\u000b")}
  WHEN rlike(e, {quoted(_UNKNOWN_ESCAPE)}) THEN concat({quoted(_BACKSLASH)}, e)
  ELSE e END"""
_ESCAPES_TO_JSON = f"""t -> CASE
  WHEN NOT contains(t, {quoted(_BACKSLASH)}) THEN t
  WHEN rlike(t, {quoted(_OTHER_ESCAPE)})
  THEN array_join(transform(regexp_extract_all(t, {quoted(_ESCAPE)}, 1), e -> {_ONE_ESCAPE}), '')
  ELSE t END"""

_TO_JSON = [
    *[_keyword_to_json(p, j) for p, j in _KEYWORDS.items()],
    _HEX_TO_JSON,
    _ESCAPES_TO_JSON,
]


def literal_to_json(c: Column) -> Column:
    """Python-literal text as JSON text (single quotes are left to the parser)."""
    return stepwise(c, *_TO_JSON)


def _exact_parser(element: T.StructType):
    names = element.fieldNames()

    @F.pandas_udf(T.ArrayType(element))
    def parse(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            try:
                items = ast.literal_eval(text)
                return [
                    {n: None if i.get(n) is None else str(i[n]) for n in names}
                    if isinstance(i, dict)
                    else None  # keeps the places of the others
                    for i in items
                ]
            except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                return None

        return texts.map(one)

    return parse


def parse_list_text(c: Column, fields: list[str], exact: bool = False) -> Column:
    """List text to ``array<struct<fields...>>`` of strings; never null.

    A list holding something besides objects makes the typed parse fail, and is
    then read element by element. With ``exact`` the texts that still do not
    parse go through ``ast.literal_eval`` in an Arrow UDF; all other rows pass it
    as nulls.
    """
    element = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    lists = T.ArrayType(element)
    one = quoted(element.simpleString())
    read = f"""j -> coalesce(
      from_json(j, {quoted(lists.simpleString())}, {_JSON_OPTIONS}),
      transform(from_json(j, 'array<string>', {_JSON_OPTIONS}), e -> from_json(e, {one}, {_JSON_OPTIONS})))"""

    gated = validate_list_text(c)
    parsed = stepwise(gated, *_TO_JSON, read)
    if exact:
        odd = F.when(parsed.isNull() | gated.rlike(r"\\N\{"), gated)
        parsed = F.when(odd.isNotNull(), _exact_parser(element)(odd)).otherwise(parsed)
    return F.coalesce(parsed, F.array().cast(lists))


def parse_list_variant(c: Column) -> Column:
    """List text of any shape to ``array<variant>``; never null.

    No field is named until the list is asked for one, so lists whose objects differ, or hold
    objects themselves, need no schema. Text that is no list gives an empty one.
    """
    read = f"j -> from_json(j, 'array<variant>', {_JSON_OPTIONS})"
    return F.coalesce(stepwise(validate_list_text(c), *_TO_JSON, read), F.array().cast("array<variant>"))


def variant_values(items: Column, path: str, kind: str = "string") -> Column:
    """What each element holds at a path such as ``$.name`` or ``$.roles[0].id``; null where nothing fits."""
    return F.transform(items, lambda x: F.try_variant_get(x, path, kind))


def variant_names(items: Column, field: str = "name") -> Column:
    """The non-empty values of one field, in list order, as ``names_of`` of a typed list."""
    return F.coalesce(F.filter(variant_values(items, f"$.{field}"), lambda n: n != ""), F.array().cast("array<string>"))


def list_shape(df: DataFrame, items: str) -> str:
    """The merged type of all elements of a column of variant lists; ``VOID`` without any."""
    elements = df.select(F.explode(items).alias("x"))
    return elements.agg(F.schema_of_variant_agg("x")).first()[0] or "VOID"


def names_of(items: Column, field: str = "name") -> Column:
    """The non-empty values of one field, in list order."""
    names = f"a -> coalesce(filter(transform(a, x -> x.`{field}`), n -> n <> ''), array())"
    return stepwise(items, names)


def top_names(items: Column, k: int = 5, field: str = "name") -> Column:
    """Names among the first ``k`` elements; the slice comes before the name test."""
    return names_of(F.slice(items, 1, k), field)


def first_match(
    items: Column,
    value: str,
    match_field: str = "job",
    field: str = "name",
    match: str = "equals",
) -> Column:
    """``field`` of the first element whose ``match_field`` equals or contains ``value``."""
    if match not in ("equals", "contains"):
        raise ValueError(f"match must be 'equals' or 'contains', not {match!r}")
    wanted = value.lower()

    def test(x: Column) -> Column:
        have = F.lower(x[match_field])
        return have.contains(wanted) if match == "contains" else F.trim(have) == wanted

    return F.get(F.filter(items, test), F.lit(0))[field]


def to_list_text(values: Column, template: str = "{'name': '%s'}") -> Column:
    """Render strings as Python-literal list text (the form the parsers read)."""
    quoted = F.transform(
        values,
        lambda v: F.replace(
            F.lit(template),
            F.lit("%s"),
            F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")),
        ),
    )
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
