"""Text normalisation as native expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Windows-1252 characters for bytes 0x80-0x9F, and those bytes.
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e"
    "\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
)
# A UTF-8 lead byte followed by a continuation byte, both read as characters.
_MISREAD = "[\u00c2-\u00f4][\u0080-\u00bf" + CP1252_CHARS + "]"

# Fixed values of the search result layout.
SNIPPET_WIDTH = 240
SNIPPET_MARKER = "..."
NO_OVERVIEW = "(no overview available)"


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stepwise(c: Column, *steps: str | Callable[[Column], Column]) -> Column:
    """Apply ``steps`` in turn, computing each intermediate value once.

    A step that names its input several times would otherwise repeat the whole
    expression before it; a lambda variable holds the computed value. A step is a
    SQL lambda such as ``"t -> upper(t)"``, which reaches the JVM in one call
    however long it is, or a function of a Column.
    """
    held = F.array(c)
    for step in steps:
        if isinstance(step, str):
            held = F.call_function("transform", held, F.expr(step))
        else:
            held = F.transform(held, step)
    return F.get(held, F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def collapse_whitespace(c: Column) -> Column:
    """Every whitespace run becomes one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


_TO_BYTES = f"translate(t, {quoted(CP1252_CHARS)}, {quoted(CP1252_BYTES)})"
_REREAD = f"""t -> CASE
  WHEN NOT rlike(t, {quoted(_MISREAD)}) THEN t
  WHEN NOT rlike({_TO_BYTES}, {quoted(r"[^\x00-\xFF]")})
  THEN coalesce(try_validate_utf8(CAST(encode({_TO_BYTES}, 'ISO-8859-1') AS STRING)), t)
  ELSE t END"""


def repair_mojibake(c: Column, passes: int = 2) -> Column:
    """UTF-8 text that was read as Latin-1 or Windows-1252, restored.

    Text is changed only when all of it fits one byte per character and those
    bytes are valid UTF-8, so well-read text stays as it is. The first test is one
    regex scan; only suspicious values are translated. Two passes also restore
    text that was misread twice.
    """
    return stepwise(c, *[_REREAD] * passes)


def clean_text(c: Column, repair: bool = True, strip_non_ascii: bool = False) -> Column:
    """Repair, optionally drop non-ASCII, then collapse: in this order no gap is left."""
    if repair:
        c = repair_mojibake(c)
    if strip_non_ascii:
        c = ascii_only(c)
    return collapse_whitespace(c)


def fold_key(c: Column) -> Column:
    """Case-insensitive matching key."""
    return F.lower(F.trim(c))


def fold_key_no_punctuation(c: Column) -> Column:
    """Matching key that also ignores punctuation, as in ``Toy Story.``"""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}]+", " "))


def join_text(*parts: Column) -> Column:
    """The non-blank parts joined by one space; null and blank parts leave no gap."""
    return F.concat_ws(" ", *[blank_to_null(p) for p in parts])


def snippet(c: Column, width: int = SNIPPET_WIDTH, empty: str = NO_OVERVIEW) -> Column:
    """At most ``width`` characters, cut between words and marked with dots."""
    room = width - len(SNIPPET_MARKER)

    def card(flat: Column) -> Column:
        words = F.regexp_extract(flat, rf"^(.{{0,{room}}})(?= )", 1)
        return (
            F.when(flat.isNull() | (flat == ""), F.lit(empty))
            .when(F.length(flat) <= width, flat)
            .otherwise(F.concat(words, F.lit(SNIPPET_MARKER)))
        )

    return stepwise(collapse_whitespace(c), card)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
