"""Ledger storage: strict JSON loading and versioned, all-or-nothing saves.

Load (``load_ledger``):

* a missing path is an empty ledger (first run);
* one JSON array per file (the interchange form) is cut into its elements by
  many tasks (``sources.json_array``), JSON Lines (``json_lines=True``) holds one
  record per line; both are parsed as Variant so ``20``, ``"20"`` and ``20.0``
  stay distinguishable;
* every element is checked in a fixed order — shape, missing fields, title,
  category, amount type, amount value, date, description — and the first
  failure per element is kept with its position;
* ``mode="strict"`` raises for the lowest failing position (one aggregate),
  ``mode="quarantine"`` returns good and bad rows.

Save (``save_ledger``) writes a new version directory and never touches the
one being read; the job committer's ``_SUCCESS`` marker makes a version
visible only when it is complete, so readers see the whole old or the whole
new ledger.  The storage folder must be shared by the cluster.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.text import py_repr, ustrip
from tallyframe.functions.values import amount_from_text, amount_from_variant, date_from_text
from tallyframe.operators import ledger as L
from tallyframe.operators.rules import Split, ValidationError, first_error, first_failure, quarantine
from tallyframe.session import shared_table
from tallyframe.sources.json_array import ArraySyntaxError, NotAnArray, read_array

REQUIRED = ["amount", "category", "date", "description", "title", "txn_id"]

# JSON value kinds as Python names them after json.load.
PY_TYPE = {"OBJECT": "dict", "ARRAY": "list", "STRING": "str", "BIGINT": "int", "BOOLEAN": "bool",
           "VOID": "NoneType", "DOUBLE": "float"}


class LoadError(ValueError):
    """The stored data cannot be read or is not a list of records."""


class SaveError(OSError):
    """The ledger could not be written."""


def _kind(v: Column) -> Column:
    t = F.schema_of_variant(v)
    return (F.when(t.startswith("OBJECT"), "OBJECT").when(t.startswith("ARRAY"), "ARRAY")
            .when(t.startswith("DECIMAL"), "DECIMAL").otherwise(t))


def _py_type(kind: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in PY_TYPE.items() for x in kv])
    return F.coalesce(F.element_at(m, kind), F.when(kind == "DECIMAL", F.lit("float")), F.lit("object"))


FIELD_NAMES = ["title", "category", "amount", "date", "description"]


def _stage(elements: DataFrame, v: str = "v") -> DataFrame:
    """Extract every field's variant, JSON kind and text once per element, so
    the rules below only read columns (small generated code, no repeated
    variant lookups)."""
    val = F.col(v)
    cols = {"__kind": _kind(val)}
    for name in REQUIRED:
        cols[f"__has_{name}"] = F.variant_get(val, f"$.{name}", "variant").isNotNull()
    for name in FIELD_NAMES:
        cols[f"__v_{name}"] = F.variant_get(val, f"$.{name}", "variant")
    staged = elements.withColumns(cols)
    more = {"__k_id": _kind(F.variant_get(val, "$.txn_id", "variant"))}
    for name in FIELD_NAMES:
        fv = F.col(f"__v_{name}")
        more[f"__k_{name}"] = _kind(fv)
        more[f"__s_{name}"] = F.try_variant_get(fv, "$", "string")
    staged = staged.withColumns(more)
    return staged.withColumns({
        "__money": amount_from_variant(F.col("__v_amount")),
        "__date": F.when(F.col("__k_date") == "STRING", date_from_text(F.col("__s_date"))),
    })


def _staged_rules() -> list[tuple[str, Column]]:
    """Rules over staged columns, in the order the reference checks them."""
    c = F.col
    missing = F.array_sort(F.filter(
        F.array(*[F.when(~c(f"__has_{k}"), F.lit(k)) for k in REQUIRED]), lambda x: x.isNotNull()))

    def text_rule(name: str, allow_blank: bool) -> Column:
        bad = c(f"__k_{name}") != "STRING"
        if not allow_blank:
            bad = bad | (ustrip(c(f"__s_{name}")) == "")
        return F.when(bad, L.text_error(name))

    def shown(name: str) -> Column:
        fv, fk = c(f"__v_{name}"), c(f"__k_{name}")
        return (F.when(fk == "VOID", F.lit("None"))
                .when(fk == "STRING", py_repr(c(f"__s_{name}")))
                .when(fk == "BOOLEAN", F.when(c(f"__s_{name}") == "true", "True").otherwise("False"))
                .otherwise(F.to_json(fv)))

    as_str = F.when(c("__k_amount") == "STRING", c("__s_amount")).otherwise(F.to_json(c("__v_amount")))
    return [
        (L.E_LOAD, F.when(c("v").isNull(), F.lit("invalid JSON"))),
        (L.E_CORRUPT, F.when(c("__kind") != "OBJECT", F.concat(F.lit("expected an object, got "),
                                                              _py_type(c("__kind"))))),
        (L.E_CORRUPT, F.when(F.size(missing) > 0,
                             F.concat(F.lit("missing field(s): "), F.array_join(missing, ", ")))),
        (L.E_CORRUPT, F.when(~F.coalesce(c("__k_id"), F.lit("VOID")).isin("BIGINT", "VOID"),
                             F.concat(F.lit("txn_id must be an integer or null, got "), _py_type(c("__k_id"))))),
        (L.E_TEXT, text_rule("title", False)),
        (L.E_TEXT, text_rule("category", False)),
        (L.E_AMOUNT_TYPE, F.when(c("__money").isNull(), L.amount_type_error(shown("amount"),
                                                                           _py_type(c("__k_amount"))))),
        (L.E_AMOUNT_VALUE, F.when(c("__money") <= 0, L.amount_value_error(as_str))),
        (L.E_DATE, F.when(c("__date").isNull(), F.concat(
            F.lit("Invalid date: "), shown("date"),
            F.lit(". Date must be a real calendar date in YYYY-MM-DD format.")))),
        (L.E_TEXT, text_rule("description", True)),
    ]


# How the schema of a record of the stored form reads, amounts as text.
_PLAIN = [f"OBJECT<amount: STRING, category: STRING, date: STRING, description: STRING, {pos}title: STRING, txn_id: {txn_id}>"
          for pos in ("", "pos: BIGINT, ") for txn_id in ("BIGINT", "VOID")]


def _stripped(name: str) -> Column:
    """``ustrip``, which goes through a text sign by sign, only where the first or the last byte may be blank."""
    c = F.col(name)
    visible = [F.ascii(end).between(33, 126) for end in (F.left(c, F.lit(1)), F.right(c, F.lit(1)))]
    return F.when(visible[0] & visible[1], c).otherwise(ustrip(c))


def _apart(df: DataFrame) -> DataFrame:
    """The same rows out of a generator: filters are not pushed through it, and code in front of and behind it becomes methods of its own."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _checked(elements: DataFrame, v: str = "v", with_errors_: bool = True) -> DataFrame:
    """``pos``, typed ledger columns and (``with_errors_``) ``error_code, reason`` of every element.

    One look at an element's schema tells whether it has the stored form; such
    an element is good if its five values are.  Only what is left is taken apart
    field by field for the rules.  Fields and results come out of generators, which
    filters are not pushed through: a filter on the error would copy the whole
    chain of rules, and what it reads, into itself.  In one method the chain would be
    too long for the JVM's compiler (8,000 bytes) and be interpreted for every element.
    """
    doc = F.col("__doc")
    seen = elements.select("pos", F.col(v).alias("__doc"), F.schema_of_variant(F.col(v)).isin(_PLAIN).alias("__plain"))
    read = _apart(seen).select("*", *[F.when(F.col("__plain"), F.variant_get(doc, f"$.{name}", "string")).alias(f"__t_{name}") for name in FIELD_NAMES])
    valued = _apart(read).withColumns({
        **{f"__t_{name}": _stripped(f"__t_{name}") for name in ("title", "category", "description")},
        "__t_amount": amount_from_text(F.col("__t_amount")), "__t_date": date_from_text(F.col("__t_date"))})
    ok = F.coalesce(F.col("__plain") & (F.col("__t_title") != "") & (F.col("__t_category") != "") & (F.col("__t_amount") > 0) & F.col("__t_date").isNotNull(), F.lit(False))
    staged = _stage(_apart(valued.withColumn("__ok", ok)).withColumn("v", F.when(~F.col("__ok"), doc)))

    def one(name: str, checked: Column) -> Column:
        return F.when(F.col("__ok"), F.col(f"__t_{name}")).otherwise(checked).alias(name)

    staged = _apart(staged)
    columns = [
        F.col("pos"), F.try_variant_get(doc, "$.txn_id", "bigint").alias("txn_id"), one("date", F.col("__date")),
        one("title", ustrip(F.col("__s_title"))), one("category", ustrip(F.col("__s_category"))), one("amount", F.col("__money")),
        one("description", ustrip(F.col("__s_description")))]
    if with_errors_:
        columns += [F.when(~F.col("__ok"), e).alias(name) for name, e in zip(("error_code", "reason"), first_error(_staged_rules()))]
    checked = staged.select(*columns)
    return _apart(checked) if with_errors_ else checked


def typed_values(elements: DataFrame) -> DataFrame:
    """Typed ledger columns only (for input already known to be valid)."""
    return _checked(elements, with_errors_=False).withColumn("pos", F.col("pos").cast("bigint"))


def typed_elements(elements: DataFrame, v: str = "v") -> DataFrame:
    """``pos, v`` (variant) → typed ledger columns plus ``error_code``/``error``."""
    checked = _checked(elements, v)
    return checked.select(F.col("pos").cast("bigint").alias("pos"), *[c for c in checked.columns if c not in ("pos", "reason")],
                          _message(F.col("error_code"), F.col("reason"), F.col("pos")).alias("error"))


def _message(code: Column, reason: Column, position: Column) -> Column:
    """Full error text: shape problems name their position; value errors
    are reported as they are."""
    return (F.when(code == L.E_CORRUPT, F.concat(F.lit("Record at position "), position.cast("string"),
                                                  F.lit(" is invalid: "), reason))
            .when(code == L.E_LOAD, F.concat(F.lit("invalid JSON at line "), (position + 1).cast("string")))
            .otherwise(reason))


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], L.LEDGER_DDL)


def read_elements(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame | None:
    """``pos, v`` per stored element, or ``None`` when the path does not exist."""
    try:
        if json_lines:
            # ``pos`` here is a struct in file order (path, split, row): it
            # orders like the numeric key of ``read_log_text`` without the
            # file-table join; numbering happens only if it is needed
            lines = spark.read.text(path).select(
                F.struct(F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("block"),
                         (F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)).alias("row")).alias("pos"),
                "value")
            lines = lines.where(ustrip("value") != "")
            return lines.select("pos", F.try_parse_json("value").alias("v"))
        return read_array(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise LoadError(f"Could not load expenses from {path}: {e}") from e
    except ArraySyntaxError as e:
        raise LoadError(f"Could not load expenses from {path}: {e}") from e
    except NotAnArray as e:
        raise LoadError(f"Could not load expenses from {path}: expected a list of records, got {e.kind}") from e


def load_ledger(spark: SparkSession, path: str, mode: str = "strict",
                json_lines: bool = False) -> DataFrame | Split:
    """Load a stored ledger with the reference's validation.

    ``strict`` returns the typed ledger or raises ``ValidationError`` naming
    the lowest failing position; ``quarantine`` returns ``Split(good, bad)``.
    A versioned folder written by ``save_ledger`` loads its latest version.
    """
    own_pos = False  # only what ``save_ledger`` wrote carries positions of its own
    latest = latest_version(spark, path)
    if latest is not None:
        if _is_parquet(spark, latest):
            typed = spark.read.option("basePath", latest).parquet(latest).select(*L.LEDGER_DDL_COLS)
            return typed if mode == "strict" else Split(typed, typed.limit(0).withColumns(
                {"error_code": F.lit(None).cast("string"), "error": F.lit(None).cast("string")}))
        path, json_lines, own_pos = latest, True, True
    elements = read_elements(spark, path, json_lines)
    if elements is None:
        empty = _empty(spark)
        return empty if mode == "strict" else Split(empty, empty.withColumns(
            {"error_code": F.lit(None).cast("string"), "error": F.lit(None).cast("string")}))
    if json_lines:
        return _load_lines(spark, path, elements, mode, own_pos)
    typed = shared_table(typed_elements(elements), "ledger-checked")
    if mode == "strict":
        _raise_first(path, typed.select("pos", "error_code", "error"))
        return typed.drop("error_code", "error")
    if mode == "quarantine":
        return quarantine(typed)
    raise ValueError(f"unknown mode {mode!r}")


def _raise_first(path: str, checked: DataFrame) -> None:
    row = first_failure(checked).first()
    if row is None or row["position"] is None:
        return
    if row["code"] == L.E_LOAD:
        raise LoadError(f"Could not load expenses from {path}: {row['message']}")
    raise ValidationError(row["position"], row["code"], row["message"])


def _load_lines(spark: SparkSession, path: str, elements: DataFrame, mode: str, own_pos: bool):
    """JSON Lines.  A saved version carries positions, which ``save_ledger``
    found to be distinct; any other file is numbered by line, whatever its
    records say.  Lines are parsed and checked once, on the file-order key; the
    line of a failure is counted only when there is one."""
    from tallyframe.operators.numbering import with_row_number
    from tallyframe.sources.logs import read_log_text

    if own_pos:
        own = F.try_variant_get(F.col("v"), "$.pos", "bigint")
        elements = elements.withColumn("pos", F.struct("pos.*", own.alias("own")))
    else:
        elements = read_log_text(spark, path).where(ustrip("value") != "").select("pos", F.try_parse_json("value").alias("v"))
    checked = shared_table(_checked(elements), "ledger-checked")  # parsed once: the checks and all later reads take it from here

    def numbered() -> DataFrame:
        if own_pos:
            return checked.withColumn("pos", F.col("pos.own"))
        return with_row_number(checked, "pos", "__line").withColumn("pos", F.col("__line") - 1).drop("__line")

    if mode == "strict":
        failed = F.when(F.col("error_code").isNotNull(), F.col("pos"))
        probe = checked.agg(F.min(failed).alias("position"), F.min_by(F.struct("error_code", "reason"), failed).alias("what")).first()
        if probe["position"] is not None:
            first, (code, reason) = probe["position"], probe["what"]
            if own_pos:
                first = F.struct(*[F.lit(v).alias(k) for k, v in first.asDict().items()])
            index = checked.where(F.col("pos") < first).count()
            msg = spark.range(1).select(_message(F.lit(code), F.lit(reason), F.lit(index))).first()[0]
            if code == L.E_LOAD:
                raise LoadError(f"Could not load expenses from {path}: {msg}")
            raise ValidationError(index, code, msg)
        return numbered().drop("error_code", "reason")
    if mode == "quarantine":
        told = numbered().withColumn("error", _message(F.col("error_code"), F.col("reason"), F.col("pos"))).drop("reason")
        return quarantine(told)
    raise ValueError(f"unknown mode {mode!r}")


# -- versioned save -----------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str, bool]]:
    """Number, folder and completeness of every version, the unfinished ones too."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v") and name[1:].isdigit():
            done = jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            out.append((int(name[1:]), st.getPath().toString(), fs.exists(done)))
    return sorted(out)


def latest_version(spark: SparkSession, path: str) -> str | None:
    done = [folder for _, folder, complete in _versions(spark, path) if complete]
    return done[-1] if done else None


def _is_parquet(spark: SparkSession, version_dir: str) -> bool:
    fs, p, _ = _fs(spark, version_dir)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.endswith(".parquet") or (st.isDirectory() and name.startswith("month=")):
            return True
    return False


def _claim(spark: SparkSession, path: str) -> int:
    """The next version number, taken by creating its claim file: of two writers only one can.

    Numbers of unfinished versions and of claims that came to nothing are not
    used again.  The store's exclusive create decides (on a local path the
    operating system's).
    """
    fs, folder, jvm = _fs(spark, f"{path.rstrip('/')}/_claims")
    fs.mkdirs(folder)
    while True:
        n = _next_number(spark, path)
        claim = jvm.org.apache.hadoop.fs.Path(folder, f"v{n:06d}")
        try:
            if fs.getUri().getScheme() == "file":
                jvm.java.nio.file.Files.createFile(jvm.java.io.File(fs.makeQualified(claim).toUri().getPath()).toPath(), spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
            else:
                fs.create(claim, False).close()
            return n
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise


def _next_number(spark: SparkSession, path: str) -> int:
    fs, folder, _ = _fs(spark, f"{path.rstrip('/')}/_claims")
    claimed = [int(st.getPath().getName()[1:]) for st in fs.listStatus(folder)]
    return max([*claimed, *(v for v, _, _ in _versions(spark, path))], default=0) + 1


def save_ledger(df: DataFrame, path: str, fmt: str = "json") -> str:
    """Write ``df`` as the next version of the ledger at ``path``; returns the
    version folder.  ``json``: JSON Lines with amounts and dates as strings,
    in ``pos`` order; ``parquet``: the typed columns."""
    spark = df.sparkSession
    try:
        if not df.where("pos is null").isEmpty() or not df.groupBy("pos").count().where("count > 1").isEmpty():
            raise ValueError("positions must be distinct and not null")
        target = f"{path.rstrip('/')}/v{_claim(spark, path):06d}"
        if fmt == "parquet":
            # laid out by month, a large month in several files
            (df.select(*L.LEDGER_DDL_COLS).withColumn("month", F.date_format("date", "yyyy-MM"))
             .repartitionByRange("month", "pos").write.mode("errorifexists").partitionBy("month").parquet(target))
        else:
            # each line also carries ``pos`` (readers of the plain format
            # ignore unknown keys), so loading needs no renumbering
            out = df.orderBy("pos").select(L.serialize(df, with_pos=True).alias("value"))
            out.write.mode("errorifexists").text(target)
        return target
    except Exception as e:  # noqa: BLE001 - storage failures become one error type
        raise SaveError(f"Could not save expenses to {path}: {e}") from e


@dataclass
class Storage:
    """A pluggable ledger store: a load function and a save function."""

    load: Callable[[SparkSession, str], DataFrame]
    save: Callable[[DataFrame, str], object]


JSON_STORAGE = Storage(load=lambda spark, path: load_ledger(spark, path), save=save_ledger)
PARQUET_STORAGE = Storage(load=lambda spark, path: load_ledger(spark, path),
                          save=lambda df, path: save_ledger(df, path, fmt="parquet"))

__all__ = ["JSON_STORAGE", "PARQUET_STORAGE", "LoadError", "SaveError", "Storage", "ValidationError",
           "latest_version", "load_ledger", "save_ledger", "typed_elements"]
