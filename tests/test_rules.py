"""Rule tables: one example per corruption, as (input, expected)."""

from __future__ import annotations

import ast
import textwrap
from datetime import date

import pytest
from pyspark.sql import functions as F

from gildmill.functions import nested, parsing, text


def apply(spark, values, build, kind="string"):
    """The results of an expression on each value, in order, under either ANSI setting."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    results = []
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            got = df.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        results.append([r["r"] for r in got])
    assert results[0] == results[1]
    return results[0]


def check(spark, build, table, kind="string"):
    got = apply(spark, [v for v, _ in table], build, kind)
    assert got == [want for _, want in table]


DAY = date(1995, 10, 30)


def test_iso_dates(spark):
    check(
        spark,
        parsing.parse_iso_date,
        [
            ("1995-10-30", DAY),
            ("1995.10.30", DAY),
            ("10/30/1995", None),
            ("30-10-1995", None),
            ("October 30, 1995", None),
            ("1995-02-30", None),
            ("0000-00-00", None),
            ("", None),
            (None, None),
        ],
    )


def test_mixed_dates(spark):
    check(
        spark,
        parsing.parse_date,
        [
            ("1995-10-30", DAY),
            (" 1995-10-30 ", DAY),
            ("1995.10.30", DAY),
            ("10/30/1995", DAY),
            ("30-10-1995", DAY),
            ("October 30, 1995", DAY),
            ("1995-10-30T12:30:00", DAY),
            ("1995-10-30 12:30:00.5", DAY),
            ("1995-1-5", date(1995, 1, 5)),
            ("12/15/1995", date(1995, 12, 15)),
            ("15/12/1995", None),
            ("17-11-1995", date(1995, 11, 17)),
            ("0000-00-00", None),
            ("1995-02-30", None),
            ("Octember 30, 1995", None),
            ("1995", None),
            ("junk", None),
            ("", None),
            (None, None),
        ],
    )


def test_currency(spark):
    check(
        spark,
        parsing.parse_currency,
        [
            ("30000000", 30000000.0),
            ("$30,000,000", 30000000.0),
            (" $ 65,000,000 ", 65000000.0),
            ("16777217", 16777217.0),
            ("NaN", 0.0),
            ("Infinity", 0.0),
            ("12f", 0.0),
            ("free", 0.0),
            ("", 0.0),
            (None, 0.0),
            ("-1", -1.0),
        ],
    )
    assert apply(spark, ["-1", "7"], lambda c: parsing.parse_currency(c, minimum=0.0)) == [0.0, 7.0]


def test_slashed_and_short_month_dates(spark):
    raw = ["1995/10/30", "1995/1/5", "Oct 30, 1995", "May 5, 1995", "May 50, 1995", "1995/13/01", "Foo 1, 1995"]
    got = apply(spark, raw, lambda c: parsing.parse_date(c).cast("string"))
    assert got == ["1995-10-30", "1995-01-05", "1995-10-30", "1995-05-05", None, None, None]


def test_currency_of_other_countries(spark):
    check(
        spark,
        parsing.parse_currency_intl,
        [
            ("$30,000,000", 30000000.0),
            ("€1.500.000", 1500000.0),
            ("30,000,000.00 USD", 30000000.0),
            ("€1.234,50", 1234.5),
            ("1.234,50 EUR", 1234.5),
            ("€12,50", 12.5),
            ("€1.500", 1500.0),
            ("€1.50", 1.5),
            ("€30,000,000", 30000000.0),
            ("1.234,50 €", 1234.5),
            ("30.000.000€", 30000000.0),
            ("USD 1,234", 1234.0),
            ("EUR 1.500", 1500.0),
            ("-EUR 12,50", -12.5),
            ("12 dollars", 0.0),
            ("1.500", 1.5),
            ("1,234.50", 1234.5),
            ("-5", -5.0),
            ("1e3", 0.0),
            ("12 monkeys", 0.0),
            ("$", 0.0),
            ("", 0.0),
            (None, 0.0),
        ],
    )


def test_runtime(spark):
    rule = lambda c: parsing.plausible(parsing.positive_or_null(c), 0.0, 1440.0)
    check(
        spark,
        rule,
        [("81", 81.0), ("-90", None), ("0", None), ("99999", None), ("NaN", None), ("x", None), (None, None)],
    )


def test_ids(spark):
    check(
        spark,
        parsing.normalize_id,
        [("862", "862"), ("862.0", "862"), (" 862.00 ", "862"), ("100", "100"), ("1.5", "1.5"), ("", None), (None, None)],
    )
    check(
        spark,
        parsing.imdb_id,
        [("114709", "tt0114709"), ("tt0114709", "tt0114709"), ("12345678", "tt12345678"), (None, None)],
    )


def test_text(spark):
    check(
        spark,
        text.clean_text,
        [
            ("  Toy   Story ", "Toy Story"),
            ("Toy\n\tStory", "Toy Story"),
            ("AmÃ©lie", "Amélie"),
            ("naÃ¯ve", "naïve"),
            ("donâ€™t", "don’t"),
            ("The KingÃ¢â‚¬â„¢s Speech", "The King’s Speech"),
            ("Amélie", "Amélie"),
            ("東京", "東京"),
            ("é Foo", "é Foo"),
            ("", ""),
            (None, None),
        ],
    )
    strip = lambda c: text.clean_text(c, repair=False, strip_non_ascii=True)
    check(spark, strip, [("é Foo", "Foo"), ("AmÃ©lie", "Amlie"), ("a é b", "a b"), ("東京", "")])
    fold = text.fold_key_no_punctuation
    check(spark, fold, [("Toy Story.", "toy story"), (" TOY-STORY!", "toy story"), ("...", "")])


def test_cleaning_is_idempotent(spark):
    values = ["  a  b ", "AmÃ©lie", "The KingÃ¢â‚¬â„¢s Speech", "x\n y", "„Ö“", "Ã", None]
    once = apply(spark, values, text.clean_text)
    assert apply(spark, once, text.clean_text) == once


def test_snippet_matches_textwrap(spark):
    words = "the quick brown fox jumped over a lazy dog and ran home to sleep "
    values = [words * n for n in range(1, 9)] + ["x" * 240, "x" * 241, "x" * 300 + " y", "ab " * 80]
    got = apply(spark, values, text.snippet)
    assert got == [textwrap.shorten(v, width=240, placeholder="...") for v in values]
    assert apply(spark, [None, "", "  "], text.snippet) == [text.NO_OVERVIEW] * 3


def test_rfc3339(spark):
    check(spark, parsing.rfc3339_date, [(DAY, "1995-10-30T00:00:00Z"), (None, None)], "date")
    check(
        spark,
        parsing.rfc3339_text,
        [
            ("1995-10-30", "1995-10-30T00:00:00Z"),
            ("1995-10-30 01:02:03", "1995-10-30T01:02:03Z"),
            ("1995-10-30T01:02:03.5", "1995-10-30T01:02:03.500000Z"),
            ("soon", "soon"),
            (" ", None),
            (None, None),
        ],
    )


def test_join_text_leaves_no_gap(spark):
    df = spark.createDataFrame([("a", None, "", "  ", "b")], "a string, b string, c string, d string, e string")
    assert df.select(text.join_text(*[F.col(c) for c in df.columns])).first()[0] == "a b"


GOOD = "[{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': 'Comedy'}]"


def names(c):
    return nested.names_of(nested.parse_list_text(c, ["name"]))


def test_list_text(spark):
    check(
        spark,
        names,
        [
            (GOOD, ["Animation", "Comedy"]),
            ('[{"id": 16, "name": "Animation"}]', ["Animation"]),
            ("[{'id': 1, 'name': \"O'Brien\", 'p': None}]", ["O'Brien"]),
            ("[{'id': 1, 'name': 'x: None, True', 'q': True}]", ["x: None, True"]),
            ("[1, {'name': 'k'}]", ["k"]),
            ("[{'name': ''}, {'name': None}, {'id': 2}, {'name': 'z'}]", ["z"]),
            ("[{'id': 16, 'name': 'Anim", []),
            ("{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': 'Comedy'}", []),
            ("[]", []),
            ("", []),
            ("junk", []),
            (None, []),
        ],
    )


def test_variant_lists(spark):
    check(
        spark,
        lambda c: nested.variant_names(nested.parse_list_variant(c)),
        [
            (GOOD, ["Animation", "Comedy"]),
            ("[{'id': 1, 'name': \"O'Brien\", 'p': None}]", ["O'Brien"]),
            ("[{'id': 1, 'name': 'x: None, True', 'q': True}]", ["x: None, True"]),
            ("[1, {'name': 'k'}, 'name', [2]]", ["k"]),
            ("[{'name': ''}, {'name': None}, {'id': 2}, {'name': 'z'}]", ["z"]),
            ("[{'id': 16, 'name': 'Anim", []),
            ("[]", []),
            ("junk", []),
            (None, []),
        ],
    )


def test_variant_fields_are_chosen_at_query_time(spark):
    texts = ["[{'name': 'a', 'roles': [{'id': 7}, {'id': 8}]}, {'name': 'b', 'year': 1995}]", "[{'year': 'x'}]", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    items = df.select(nested.parse_list_variant(F.col("t")).alias("items"))
    got = items.select(
        nested.variant_values(F.col("items"), "$.roles[1].id", "int").alias("role"),
        nested.variant_values(F.col("items"), "$.year", "int").alias("year"),
    ).collect()
    assert [r["role"] for r in got] == [[8, None], [None], []]
    assert [r["year"] for r in got] == [[None, 1995], [None], []]
    shape = nested.list_shape(items, "items")
    assert "name: STRING" in shape and "roles: ARRAY<OBJECT<id: BIGINT>>" in shape
    assert nested.list_shape(items.where("size(items) = 0"), "items") == "VOID"


def test_list_repair(spark):
    check(
        spark,
        lambda c: names(nested.repair_list_text(c)),
        [
            (GOOD, ["Animation", "Comedy"]),
            (GOOD[1:-1], ["Animation", "Comedy"]),
            (GOOD[:-1], ["Animation", "Comedy"]),
            (GOOD[:45], ["Animation"]),
            ("[{'id': 16, 'name': 'Anim", []),
            ("junk", []),
            ("", []),
            (None, []),
        ],
    )


def test_list_validation(spark):
    check(
        spark,
        nested.validate_list_text,
        [(GOOD, GOOD), ("", "[]"), (None, "[]"), ("[", "[]"), ("[1\n]", "[1\n]"), (GOOD[1:], "[]")],
    )


HARD_NAMES = [
    "plain",
    "O'Brien",
    'say "x"',
    "both ' and \"",
    "back\\slash",
    "two\\\\slashes",
    "tail\\",
    "line\nbreak\ttab\rreturn",
    "None, True: False",
    "'None'",
    "\x00\x07\x0b\x7f\xa0\xad",
    "caf\xe9 東京 ​ \U0001f600 \U000e0067",
    "{'a': [1]}",
    "\\x41 \\n \\U0001f600 \\d",
    "n" * 200_000,
]


def test_list_parsing_equals_python(spark):
    """Everything that printing a list of dictionaries can produce."""
    rows = [[{"id": i, "name": n, "flag": i % 2 == 0, "none": None}] for i, n in enumerate(HARD_NAMES)]
    rows.append([{"name": n} for n in HARD_NAMES[:-1]])
    texts = [repr(r) for r in rows]
    want = [[d["name"] for d in ast.literal_eval(t)] for t in texts]
    assert apply(spark, texts, names) == want


@pytest.mark.parametrize(
    "literal",
    [r"[{'name': '\101\7z'}]", r"[{'name': '\a\v\d\/'}]", r"[{'name': '\U0001f600é\x41'}]", r"[{'name': '\\\x41'}]"],
)
def test_list_escapes_equal_python(spark, literal):
    want = [d["name"] for d in ast.literal_eval(literal)]
    assert apply(spark, [literal], names) == [want]


def test_exact_list_parsing(spark):
    literals = [r"[{'name': '\N{BULLET}'}]", "[{'name': 'a' 'b'}]", GOOD, "[{'name': 'Anim", None]
    exact = lambda c: nested.names_of(nested.parse_list_text(c, ["name"], exact=True))
    assert apply(spark, literals, exact) == [["•"], ["ab"], ["Animation", "Comedy"], [], []]


def test_first_match_and_top_names(spark):
    crew = (
        "[{'job': 'Editor', 'name': 'E'}, {'job': 'Director of Photography', 'name': 'P'}, "
        "{'job': 'Director', 'name': 'D'}]"
    )
    parsed = lambda c: nested.parse_list_text(c, ["name", "job"])
    equals = lambda c: nested.first_match(parsed(c), "director")
    contains = lambda c: nested.first_match(parsed(c), "director", match="contains")
    assert apply(spark, [crew, "[]", None], equals) == ["D", None, None]
    assert apply(spark, [crew, "[]", None], contains) == ["P", None, None]
    cast = repr([{"name": n} if n else {"id": 0} for n in ["a", None, "c", "d", "e", "f", "g"]])
    assert apply(spark, [cast], lambda c: nested.top_names(parsed(c), 5)) == [["a", "c", "d", "e"]]
    with pytest.raises(ValueError):
        nested.first_match(F.col("v"), "director", match="like")


def test_rendered_list_text_reads_back(spark):
    df = spark.createDataFrame([(HARD_NAMES[:7],)], "v array<string>")
    got = df.select(names(nested.to_list_text(F.col("v"))).alias("r")).first()["r"]
    assert got == HARD_NAMES[:7]
