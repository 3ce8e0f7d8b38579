"""Status updates by key, row labels, and add/remove of collection rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_status(catalogue: DataFrame, commands: DataFrame, key: str = "key",
                 seq: str = "seq", value: str = "is_borrowed") -> DataFrame:
    """Replay a command log onto a catalogue.

    The last command per key (highest ``seq``) decides the status of **every**
    catalogue row with that key; keys nobody commanded keep their status and
    commands for unknown keys change nothing.  ``max_by`` is combined
    map-side, so a key holding a third of the log is still one small row per
    task before the shuffle.
    """
    latest = commands.groupBy(key).agg(F.max_by(F.col(value), F.col(seq)).alias("__new"))
    return (catalogue.join(latest, key, "left")
            .withColumn(value, F.coalesce(F.col("__new"), F.col(value))).drop("__new"))


def status_label(title: Column | str = "title", author: Column | str = "author",
                 borrowed: Column | str = "is_borrowed") -> Column:
    """``title by author (Borrowed)`` or ``(Available)``."""
    b = F.col(borrowed) if isinstance(borrowed, str) else borrowed
    return F.concat(F.col(title) if isinstance(title, str) else title, F.lit(" by "),
                    F.col(author) if isinstance(author, str) else author,
                    F.when(b, F.lit(" (Borrowed)")).otherwise(F.lit(" (Available)")))


def task_label(title: Column | str = "title", priority: Column | str = "priority") -> Column:
    """``title (Priority: p)``."""
    t = F.col(title) if isinstance(title, str) else title
    p = F.col(priority) if isinstance(priority, str) else priority
    return F.format_string("%s (Priority: %s)", t, p)


def add_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows (identity semantics: equal rows stay separate)."""
    return df.unionByName(rows)


def remove_row(df: DataFrame, pos: int, pos_col: str = "pos") -> DataFrame:
    """Remove the row at ``pos``; an absent row is an error, as in ``list.remove``."""
    if df.where(F.col(pos_col) == pos).isEmpty():
        raise ValueError(f"row {pos} not in collection")
    return df.where(F.col(pos_col) != pos)
