"""Text functions with Python string semantics, built from Spark expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip()/str.isspace() treat as whitespace.  Derived
# from the rule itself so it cannot drift from the interpreter.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
assert sys.maxunicode >= 0x3000

# Line boundaries used by Python's str.splitlines().
LINE_BREAKS = "\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029"
LINE_BREAK_PATTERN = "\r\n|[" + LINE_BREAKS + "]"
# Whitespace that can occur inside one line.
INLINE_WHITESPACE = "".join(ch for ch in WHITESPACE if ch not in LINE_BREAKS)

RUPEE = "₹"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c: Column | str) -> Column:
    """``str.strip()``: remove Unicode whitespace (NBSP, U+3000, \\x1c-\\x1f, ...) at both ends.

    Spark's one-argument ``trim`` removes only U+0020, so the character set is
    passed explicitly; this stays a codegen'd string op, not a regex.
    """
    return F.trim(_col(c), F.lit(WHITESPACE))


# Signs that are letters (kelvin, angstrom, capital theta symbol, ohm).
_SIGNS, _SIGN_LETTERS = "\u212a\u212b\u03f4\u2126", "kå\u03b8\u03c9"


def casefold_key(c: Column | str) -> Column:
    """Case-insensitive match key: equal for two texts exactly when ``str.casefold`` is.

    ``upper`` folds like ``casefold`` (ß to SS, final sigma, ligatures) but for a
    few letters: dotless i is kept apart, since it would become a plain one, and
    sharp capital S, dotted capital I and four signs are written out first.
    """
    apart = F.translate(ustrip(c), "ı" + _SIGNS, "\ufdd0" + _SIGN_LETTERS)
    return F.upper(F.replace(F.replace(apart, F.lit("ẞ"), F.lit("ss")), F.lit("İ"), F.lit("i\u0307")))


def money_text(c: Column | str) -> Column:
    """``₹`` + Western thousands separators + exactly two decimals."""
    return F.concat(F.lit(RUPEE), F.format_number(_col(c), 2))


def url_quote(c: Column | str) -> Column:
    """Percent-quote a path, leaving ``/`` and RFC 3986 unreserved characters alone.

    ``url_encode`` is form encoding; four differences are repaired.  A literal
    ``+`` in the input is always encoded as ``%2B``, so any ``+`` left is a space.
    """
    enc = F.url_encode(_col(c))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    enc = F.replace(enc, F.lit("%7E"), F.lit("~"))
    return F.replace(enc, F.lit("%2F"), F.lit("/"))


def regex_literal(s: str) -> str:
    """Quote a Python string for use inside a Java regex."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def replacement_literal(c: Column | str) -> Column:
    """Escape ``\\`` and ``$`` so a column is inserted literally by ``regexp_replace``."""
    return F.regexp_replace(_col(c), r"([\\$])", r"\\$1")


def lines_of(c: Column | str) -> Column:
    """``str.splitlines()`` as an array column."""
    return F.split(_col(c), LINE_BREAK_PATTERN)


def char_class(chars: str) -> str:
    """A Java regex character class body matching exactly ``chars``."""
    return "".join(f"\\x{{{ord(ch):x}}}" for ch in chars)


def py_repr(c: Column | str) -> Column:
    """``repr(str)`` for ordinary strings: single quotes unless the text holds
    one and no double quote; backslashes, quotes and \\n \\r \\t escaped."""
    s = _col(c)
    esc = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        esc = F.replace(esc, F.lit(raw), F.lit(shown))
    use_double = F.contains(s, F.lit("'")) & ~F.contains(s, F.lit('"'))
    return (
        F.when(s.isNull(), F.lit("None"))
        .when(use_double, F.concat(F.lit('"'), esc, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )


def pad_right(c: Column | str, width: int) -> Column:
    """Left-justify to ``width`` without ever truncating (``rpad`` truncates)."""
    return F.format_string(f"%-{width}s", _col(c))


def pad_left(c: Column | str, width: int) -> Column:
    """Right-justify to ``width`` without ever truncating (``lpad`` truncates)."""
    return F.format_string(f"%{width}s", _col(c))
