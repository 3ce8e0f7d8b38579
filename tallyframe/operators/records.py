"""Record pipelines: ordered steps over a DataFrame of records.

A step is ``DataFrame -> DataFrame``.  Transform steps rewrite columns;
validating steps leave the record unchanged and fill the ``error`` column if
it is still empty, so the first failing step wins and later steps see the
values earlier steps produced.  ``run`` folds the steps with
``DataFrame.transform``: the whole pipeline is one narrow stage, no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyframe.functions.text import ustrip
from tallyframe.session import shared_table

Step = Callable[[DataFrame], DataFrame]

RECORD_DDL = "id bigint, name string, value double"
ERROR = "error"


def _fail_if(rule: Callable[[], Column]) -> Step:
    def step(df: DataFrame) -> DataFrame:
        return df.withColumn(ERROR, F.coalesce(F.col(ERROR), rule()))
    return step


def validating(rule: Callable[[], Column]) -> Step:
    """A user validation: ``rule()`` returns a message column, null when the
    record is fine.  The record itself passes through unchanged."""
    return _fail_if(rule)


def required_name() -> Step:
    """The name must not be blank after stripping."""
    return _fail_if(lambda: F.when(
        F.col("name").isNull() | (ustrip("name") == ""),
        F.concat(F.lit("record "), F.col("id").cast("string"), F.lit(" has an empty name"))))


def require_non_negative_value() -> Step:
    """``value < 0`` fails; zero and NaN pass."""
    return _fail_if(lambda: F.when(
        F.col("value") < 0, F.concat(F.lit("negative value in record "), F.col("id").cast("string"))))


def normalize() -> Step:
    """Strip and lowercase the name; every other column passes through."""
    return lambda df: df.withColumn("name", F.lower(ustrip("name")))


def scale(factor: float) -> Step:
    """``value * factor`` in double arithmetic."""
    return lambda df: df.withColumn("value", F.col("value") * F.lit(float(factor)))


_SEEN = "__tf_seen_"


def spy(what: Observation | str) -> Step:
    """Count the records that reach this point without an error; changes nothing.

    A name counts through the written result (``spied``): whatever stage runs
    again, only what the committer kept is added up.  An ``Observation`` counts
    per execution of the plan, for interactive use: a stage that samples its
    input is observed twice.
    """
    def step(df: DataFrame) -> DataFrame:
        passing = F.col(ERROR).isNull() if ERROR in df.columns else F.lit(True)
        if isinstance(what, str):
            return df.withColumn(_SEEN + what, passing)
        return df.observe(what, F.count(F.lit(1)).alias("records"))
    return step


def spied(df: DataFrame, steps: list[Step]) -> tuple[DataFrame, DataFrame]:
    """The written result of ``steps``, and one row with the count of every named spy."""
    written = shared_table(run(df, steps), "spied")
    names = [c for c in written.columns if c.startswith(_SEEN)]
    counts = written.agg(*[F.count_if(F.col(c)).alias(c.removeprefix(_SEEN)) for c in names])
    return written.drop(*names), counts


def python_step(fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> Step:
    """Arbitrary Python record logic with no column form, batched through Arrow."""
    def step(df: DataFrame) -> DataFrame:
        return df.mapInPandas(lambda batches: (fn(b) for b in batches), schema)
    return step


def default_steps() -> list[Step]:
    """Name check, value check, normalise, scale by 1.1."""
    return [required_name(), require_non_negative_value(), normalize(), scale(1.1)]


def run(df: DataFrame, steps: list[Step]) -> DataFrame:
    """Apply ``steps`` in list order; no steps is the identity (plus an empty
    ``error`` column)."""
    start = df if ERROR in df.columns else df.withColumn(ERROR, F.lit(None).cast("string"))
    return reduce(DataFrame.transform, steps, start)


# -- output -------------------------------------------------------------------

def _ascii_json(c: Column) -> Column:
    """A JSON string with every character above ASCII written as ``\\uXXXX`` (pairs above the BMP)."""
    def units(ch: Column) -> Column:
        wide = F.encode(ch, "UTF-16BE")
        word = F.lower(F.hex(wide))
        return F.when(F.octet_length(wide) == 2, F.concat(F.lit("\\u"), word)).otherwise(
            F.concat(F.lit("\\u"), F.substring(word, 1, 4), F.lit("\\u"), F.substring(word, 5, 4)))

    quoted = F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    escaped = F.array_join(F.transform(F.split(quoted, ""), lambda ch: F.when(F.ascii(ch) > 126, units(ch)).otherwise(ch)), "")
    return F.when(quoted.rlike(r"[^\x00-\x7e]"), escaped).otherwise(quoted)


def _json_float(c: Column) -> Column:
    """``repr(float)``: plain digits from 1e-4 up to 1e16, else an exponent of two digits at least."""
    text = c.cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, r"E(-?)[0-9]+$", 1)
    number = F.regexp_extract(text, r"E-?([0-9]+)$", 1)
    exponent = F.concat(F.when(c < 0, "-").otherwise(""), digits, F.lit("e"), F.when(power == "-", "-").otherwise("+"),
                        F.when(F.length(number) < 2, F.concat(F.lit("0"), number)).otherwise(number))
    plain = F.regexp_replace(text.cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    size = F.abs(c)
    return (F.when(c.isNull(), "null").when(F.isnan(c), "NaN").when(size == float("inf"), F.when(c > 0, "Infinity").otherwise("-Infinity"))
            .when(~text.contains("E"), text).when((size >= 1e-4) & (size < 1e16), plain).otherwise(exponent))


def _json_value(c: Column, dtype: str) -> Column:
    if dtype in ("double", "float"):
        return _json_float(c)
    if dtype == "boolean":
        return F.when(c.isNull(), F.lit("null")).when(c, F.lit("true")).otherwise(F.lit("false"))
    if dtype in ("tinyint", "smallint", "int", "bigint") or dtype.startswith("decimal"):
        return F.coalesce(c.cast("string"), F.lit("null"))
    return F.when(c.isNull(), "null").otherwise(_ascii_json(c.cast("string")))


def pretty_json(df: DataFrame, indent: int = 2) -> Column:
    """One JSON document per row in the layout of ``json.dumps(obj, indent=2)``."""
    pad = " " * indent
    fields = [F.concat(F.lit(f"{pad}{json.dumps(f.name)}: "), _json_value(F.col(f.name), f.dataType.simpleString()))
              for f in df.schema.fields]
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *fields), F.lit("\n}"))


def read_records(spark, path: str, json_lines: bool = False) -> DataFrame:
    """JSON records with the fixed record schema (no inference).  A single
    top-level array is one task; JSON Lines splits across tasks."""
    reader = spark.read.schema(RECORD_DDL)
    if not json_lines:
        reader = reader.option("multiLine", True)
    return reader.json(path)


# -- error-capturing map ------------------------------------------------------

def capture_map(df: DataFrame, fn: Callable, arg_cols: list[str], pos_col: str = "pos",
                result_type: str = "double") -> DataFrame:
    """Apply a Python function to every row; each row yields its result **or**
    its error (``TypeName: message``) and one failure never stops the others."""
    schema = f"{pos_col} {df.schema[pos_col].dataType.simpleString()}, result {result_type}, error string"

    def per_batch(batches):
        for b in batches:
            results, errors = [], []
            for args in zip(*(b[c] for c in arg_cols)):
                try:
                    result = fn(*(None if a is pd.NA or a is pd.NaT or a != a else a for a in args))
                    if result is None:
                        raise ValueError("no result")
                    results.append(result)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the error is the output
                    results.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({pos_col: b[pos_col], "result": pd.Series(results, dtype="object"),
                                "error": errors})

    return df.select(pos_col, *arg_cols).mapInPandas(per_batch, schema)
