"""Money and date parsing with the ledger's validation semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.text import ustrip

MONEY = "decimal(28,2)"

# The ISO date shape accepted by strptime('%Y-%m-%d'):
# four-digit year, month 1-12 with optional zero, day with optional zero or a
# leading space.
DATE_PATTERN = r"^([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_from_text(c: Column | str) -> Column:
    """Text → ``decimal(28,2)`` rounded half-up, or null if it is not a finite number.

    Mirrors ``Decimal(str)``: Unicode whitespace is stripped and ``_`` is
    ignored wherever it stands.  NaN/Infinity and over-large values give null.
    """
    s = ustrip(_col(c))
    s = F.replace(s, F.lit("_"), F.lit(""))
    return s.try_cast(MONEY)


def _integral_json(t: Column) -> Column:
    # JSON integers arrive as BIGINT; ones too large for BIGINT arrive as
    # DECIMAL(p,0) with p > 18.  A literal such as 20.0 arrives as DECIMAL(2,0),
    # which is a float in JSON terms and must be refused.
    big = F.regexp_extract(t, r"^DECIMAL\((\d+),0\)$", 1)
    return t.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | (
        (big != "") & (big.cast("int") > 18))


def amount_from_variant(v: Column | str) -> Column:
    """Variant → money.  Only JSON strings and integers are money; floats,
    booleans, null, objects and arrays are refused (null result)."""
    v = _col(v)
    t = F.schema_of_variant(v)
    as_text = F.try_variant_get(v, "$", "string")
    return (
        F.when(t == "STRING", amount_from_text(as_text))
        .when(_integral_json(t), as_text.try_cast(MONEY))
    )


def date_from_text(c: Column | str) -> Column:
    """Text → date with ``strptime('%Y-%m-%d')`` rules; null when invalid.

    The shape (digits, optional zero or space padding) is checked by one
    regex; the calendar check (no 2026-02-30) is Spark's cast, after dropping a
    space-padded day's space.
    """
    s = _col(c)
    ok = s.rlike(DATE_PATTERN) & ~s.startswith("0000")
    return F.when(ok, F.replace(s, F.lit("- "), F.lit("-")).try_cast("date"))
