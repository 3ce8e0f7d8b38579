"""Scalar layer: Python string/number semantics reproduced with Spark expressions."""

import datetime as dt
import urllib.parse
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.functions import (
    amount_from_text, amount_from_variant, avg_half_even, casefold_key, date_from_text, lines_of,
    money_text, py_repr, share_half_even, url_quote, ustrip,
)
from tallyframe.functions.text import WHITESPACE


def one_col(spark, values, expr, ddl="s string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr(F.col(df.columns[0]))).collect()]


def test_ustrip_matches_str_strip_for_every_whitespace(spark):
    values = [f"{w}a{w}b{w}" for w in WHITESPACE] + ["  Bread  ", " Market ", "\t\n", "", "x"]
    assert one_col(spark, values, ustrip) == [v.strip() for v in values]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(WHITESPACE) + list("ab ß")), max_size=8), min_size=1, max_size=20))
def test_ustrip_property(spark, values):
    assert one_col(spark, values, ustrip) == [v.strip() for v in values]


def test_casefold_key_groups_like_casefold(spark):
    values = ["food", "FOOD", "  Food  ", "straße", "STRASSE"]
    keys = one_col(spark, values, casefold_key)
    assert keys[0] == keys[1] == keys[2]
    assert keys[3] == keys[4]


def test_casefold_key_over_all_letters(spark):
    # capitals that Unicode 16 added fold in the JVM and not yet in Python 3.13; U+FDD0 is no character
    newer = {0xFDD0, 0xA7CB, 0xA7CC, 0xA7CD, 0xA7DA, 0xA7DB, 0xA7DC, 0x264, 0x19B, 0x1C89, 0x1C8A, *range(0x10D50, 0x10D86)}
    letters = [chr(i) for i in range(0x20000) if not 0xD800 <= i < 0xE000 and not chr(i).isspace() and i not in newer and (chr(i).isalpha() or i > 0x2FF)]
    keys = one_col(spark, letters, casefold_key)
    by_fold, by_key = {}, {}
    for letter, key in zip(letters, keys):
        by_fold.setdefault(letter.casefold(), set()).add(key)
        by_key.setdefault(key, set()).add(letter.casefold())
    assert [f for f, k in by_fold.items() if len(k) > 1] == [] and [k for k, f in by_key.items() if len(f) > 1] == []
    assert len(set(one_col(spark, ["Dıning", "Dining"], casefold_key))) == 2
    assert len(set(one_col(spark, ["ẞ", "ss", "SS", "ß"], casefold_key))) == 1


@pytest.mark.parametrize("raw,expected", [
    ("1__0", "10.00"), ("_10", "10.00"), ("10_", "10.00"),
    ("20", "20.00"), ("20.5", "20.50"), ("20.555", "20.56"), ("20.554", "20.55"), ("2.5", "2.50"),
    ("7", "7.00"), ("0.005", "0.01"), ("0.004", "0.00"), ("1e3", "1000.00"), (".5", "0.50"),
    ("5.", "5.00"), ("+5", "5.00"), ("1_000", "1000.00"), (" 12　", "12.00"),
])
def test_money_from_text_rounds_half_up(spark, raw, expected):
    assert one_col(spark, [raw], amount_from_text) == [Decimal(expected)]


@pytest.mark.parametrize("raw", ["", "abc", "12.3.4", "₹20", None, "NaN", "Infinity", "-Infinity", "1" * 40])
def test_money_from_text_refuses(spark, raw):
    assert one_col(spark, [raw], amount_from_text) == [None]


def test_money_from_variant_keeps_json_types_apart(spark):
    docs = ['20', '"20"', '20.0', '19.99', 'true', 'null', '[]', '{}', '"abc"', '123456789012345678901234',
            '"-500.00"']
    got = one_col(spark, docs, lambda c: amount_from_variant(F.parse_json(c)))
    assert got == [Decimal("20.00"), Decimal("20.00"), None, None, None, None, None, None, None,
                   Decimal("123456789012345678901234.00"), Decimal("-500.00")]


@pytest.mark.parametrize("raw,expected", [
    ("2026-01-05", dt.date(2026, 1, 5)), ("2024-02-29", dt.date(2024, 2, 29)), ("2026-1-5", dt.date(2026, 1, 5)),
    ("2026-01- 5", dt.date(2026, 1, 5)),
    ("2026-13-45", None), ("2026-02-30", None), ("2025-02-29", None), ("05-01-2026", None), ("2026/01/05", None),
    ("not-a-date", None), ("", None), (None, None), ("2026", None), ("2026-01", None), ("2026-01-05T00:00", None),
    (" 2026-01-05", None), ("2026-01-05 ", None), ("0000-01-01", None),
])
def test_date_from_text_follows_strptime(spark, raw, expected):
    assert one_col(spark, [raw], date_from_text) == [expected]
    if raw is not None:
        try:
            py = dt.datetime.strptime(raw, "%Y-%m-%d").date()
        except ValueError:
            py = None
        assert py == expected


def test_money_text(spark):
    got = one_col(spark, [Decimal("1234567.50"), Decimal("0.10"), Decimal("20.00")], money_text, "a decimal(28,2)")
    assert got == ["₹1,234,567.50", "₹0.10", "₹20.00"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=10))
def test_url_quote_matches_urllib(spark, values):
    assert one_col(spark, values, url_quote) == [urllib.parse.quote(v) for v in values]


def test_py_repr_simple_strings(spark):
    values = ["abc", "it's", 'say "hi"', "a\\b", "tab\there", "both ' and \""]
    assert one_col(spark, values, py_repr) == [repr(v) for v in values]


def test_lines_of_matches_splitlines(spark):
    text = "a\r\nb\rc\nd\x0be\x0cf\x1cg\x1dh\x1ei\x85j k l"
    got = one_col(spark, [text], lines_of)[0]
    assert got == text.splitlines()


def _py_avg(cents_total, n):
    return (Decimal(cents_total) / 100 / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN)


def _py_share(a, g):
    return (Decimal(a) / Decimal(g) * 100).quantize(Decimal("0.1"), rounding=ROUND_HALF_EVEN)


def test_average_half_even_fixtures(spark):
    rows = [(Decimal("5860.98"), 5), (Decimal("31.00"), 2), (Decimal("30.25"), 2), (Decimal("30.26"), 2),
            (Decimal("15.125") * 2, 2)]
    df = spark.createDataFrame(rows, "t decimal(38,2), n bigint")
    got = [r[0] for r in df.select(avg_half_even(F.col("t"), F.col("n"))).collect()]
    assert got == [Decimal("1172.20"), Decimal("15.50"), Decimal("15.12"), Decimal("15.13"), Decimal("15.12")]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**15), st.integers(1, 10**6)), min_size=1, max_size=30))
def test_average_half_even_property(spark, pairs):
    df = spark.createDataFrame([(Decimal(c) / 100, n) for c, n in pairs], "t decimal(38,2), n bigint")
    got = [r[0] for r in df.select(avg_half_even(F.col("t"), F.col("n"))).collect()]
    assert got == [_py_avg(c, n) for c, n in pairs]


def test_share_trap_and_fixtures(spark):
    rows = [("3000.00", "2000000.01"), ("4300.00", "5860.98"), ("1452.43", "5860.98"), ("108.55", "5860.98"),
            ("25.00", "100.00"), ("75.00", "100.00")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in rows], "a decimal(38,2), g decimal(38,2)")
    got = [r[0] for r in df.select(share_half_even(F.col("a"), F.col("g"))).collect()]
    assert got == [Decimal("0.1"), Decimal("73.4"), Decimal("24.8"), Decimal("1.9"), Decimal("25.0"), Decimal("75.0")]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**12), st.integers(0, 10**12)), min_size=1, max_size=30))
def test_share_property(spark, pairs):
    rows = [(Decimal(a) / 100, Decimal(a + extra) / 100) for a, extra in pairs]
    df = spark.createDataFrame(rows, "a decimal(38,2), g decimal(38,2)")
    got = [r[0] for r in df.select(share_half_even(F.col("a"), F.col("g"))).collect()]
    assert got == [_py_share(a, g) for a, g in rows]
