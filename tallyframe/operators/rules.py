"""Validation rules and error policies.

A rule is ``(code, Column)`` where the column is a message when the row breaks
the rule and null otherwise.  ``first_error`` folds rules into one ``coalesce``
in the given order, so the first failing rule wins no matter how Catalyst
orders the surrounding filters.

Policies (what happens to a row that fails):

* ``strict``: the whole input is rejected with the error of the lowest
  position (ledger load).  One bounded ``min_by`` aggregate decides it.
* ``prefix``: rows before the first failing position pass (fail-fast stream).
  The cut-off is a scalar subquery, so no data goes through the driver.
* ``quarantine``: failing rows go to a second output, the rest pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def first_error(rules: list[Rule]) -> tuple[Column, Column]:
    """``(error_code, error_message)`` of the first failing rule, else nulls."""
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    code = F.coalesce(*[F.when(msg.isNotNull(), F.lit(c)) for c, msg in rules])
    message = F.coalesce(*[msg for _, msg in rules])
    return code, message


def with_errors(df: DataFrame, rules: list[Rule], code_col: str = "error_code",
                msg_col: str = "error") -> DataFrame:
    code, msg = first_error(rules)
    return df.withColumns({code_col: code, msg_col: msg})


class ValidationError(ValueError):
    """Raised by the strict policy; carries the offending position and code."""

    def __init__(self, position, code, message):
        self.position, self.code = position, code
        super().__init__(message)


def first_failure(df: DataFrame, pos_col: str = "pos", msg_col: str = "error",
                  code_col: str = "error_code") -> DataFrame:
    """One row: lowest failing position with its code and message (or nulls)."""
    bad = F.col(msg_col).isNotNull()
    return df.agg(
        F.min(F.when(bad, F.col(pos_col))).alias("position"),
        F.min_by(F.when(bad, F.col(code_col)), F.when(bad, F.col(pos_col))).alias("code"),
        F.min_by(F.when(bad, F.col(msg_col)), F.when(bad, F.col(pos_col))).alias("message"),
    )


def strict(df: DataFrame, pos_col: str = "pos", msg_col: str = "error",
           code_col: str = "error_code") -> DataFrame:
    """Raise ``ValidationError`` if any row fails; else return the rows without error columns."""
    row = first_failure(df, pos_col, msg_col, code_col).first()
    if row is not None and row["position"] is not None:
        raise ValidationError(row["position"], row["code"], row["message"])
    return df.drop(msg_col, code_col)


def prefix(df: DataFrame, pos_col: str = "pos", msg_col: str = "error",
           code_col: str = "error_code") -> DataFrame:
    """Rows strictly before the first failing position (all rows if none fails)."""
    cut = df.where(F.col(msg_col).isNotNull()).agg(F.min(pos_col)).scalar()
    # the subquery is referenced exactly once, so it runs once; no failure
    # (null cut) keeps every row
    keep = F.coalesce(F.col(pos_col) < cut, F.lit(True))
    return df.where(keep).drop(msg_col, code_col)


@dataclass
class Split:
    good: DataFrame
    bad: DataFrame


def quarantine(df: DataFrame, msg_col: str = "error", code_col: str = "error_code") -> Split:
    """Two outputs split on the error column; nothing is dropped."""
    return Split(good=df.where(F.col(msg_col).isNull()).drop(msg_col, code_col),
                 bad=df.where(F.col(msg_col).isNotNull()))


def apply_policy(df: DataFrame, mode: str, pos_col: str = "pos", msg_col: str = "error",
                 code_col: str = "error_code"):
    if mode == "strict":
        return strict(df, pos_col, msg_col, code_col)
    if mode == "prefix":
        return prefix(df, pos_col, msg_col, code_col)
    if mode == "quarantine":
        return quarantine(df, msg_col, code_col)
    raise ValueError(f"unknown error policy {mode!r}")
