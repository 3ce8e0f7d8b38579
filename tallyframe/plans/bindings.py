"""How each operator family reads the driver's parquet tables.

Every binding is a projection of a given table (or a join of two), so the
work of each registered query grows with the tables.  The DuckDB text of the
same projection lives next to it so the oracle SQL is built from one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- log family: events as log lines -----------------------------------------

def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pos = event_id``, ``value = 'YYYY-MM-DD HH:MM:SS LEVEL props'``."""
    ev = table(spark, sf_dir, "events")
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                       F.upper("event_type"), F.col("props"))
    return ev.select(F.col("event_id").alias("pos"), line.alias("value"))


LOG_LINES_SQL = """(SELECT event_id AS pos,
        strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || upper(event_type) || ' ' || props AS value
   FROM events)"""


def faulty_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with one in 997 cut short, from the 400th on."""
    bad = (F.col("pos") % 997 == 400)
    return log_lines(spark, sf_dir).withColumn("value", F.when(bad, F.concat(F.lit("cut "), F.col("pos").cast("string"))).otherwise(F.col("value")))


FAULTY_LOG_LINES_SQL = f"""(SELECT pos, CASE WHEN pos % 997 = 400 THEN 'cut ' || CAST(pos AS VARCHAR) ELSE value END AS value FROM {LOG_LINES_SQL})"""


# -- record family: customers as pipeline records -----------------------------

def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id = c_custkey``, padded ``name`` (blank for nation 7), ``value = c_acctbal``."""
    c = table(spark, sf_dir, "customer")
    name = F.when(F.col("c_nationkey") == 7, F.lit(" \u3000 ")).otherwise(
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
    return c.select(F.col("c_custkey").alias("id"), name.alias("name"),
                    F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("segment"))


RECORDS_SQL = """(SELECT c_custkey AS id,
        CASE WHEN c_nationkey = 7 THEN ' ' || chr(12288) || ' ' ELSE '  ' || c_name || ' ' END AS name,
        c_acctbal AS value, c_mktsegment AS segment FROM customer)"""


# -- ledger family: orders as expenses ----------------------------------------

def ledger(spark: SparkSession, sf_dir: str, id_col: str = "o_orderkey") -> DataFrame:
    """Typed ledger.  The double→decimal cast belongs to this binding; the
    ledger functions themselves never accept doubles as money."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("pos"),
        F.col(id_col).alias("txn_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").cast("decimal(28,2)").alias("amount"),
        F.col("o_orderstatus").alias("description"),
    )


LEDGER_SQL = """(SELECT o_orderkey AS pos, o_orderkey AS txn_id, CAST(o_orderdate AS DATE) AS date,
        'order ' || CAST(o_orderkey AS VARCHAR) AS title, o_orderpriority AS category,
        CAST(o_totalprice AS DECIMAL(28,2)) AS amount, o_orderstatus AS description
   FROM orders)"""


def ledger_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same rows keyed by customer: ``txn_id = o_custkey`` repeats, which is
    the duplicate-id case (first match by ``pos`` wins)."""
    return ledger(spark, sf_dir, id_col="o_custkey")


LEDGER_BY_CUSTOMER_SQL = """(SELECT o_orderkey AS pos, o_custkey AS txn_id, CAST(o_orderdate AS DATE) AS date,
        'order ' || CAST(o_orderkey AS VARCHAR) AS title, o_orderpriority AS category,
        CAST(o_totalprice AS DECIMAL(28,2)) AS amount, o_orderstatus AS description
   FROM orders)"""


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger fields as unvalidated text, with faults derived from the data:
    blank titles for status P, three-decimal amounts, zero, negative and non-numeric
    amounts for the cheapest orders, unpadded dates and impossible days."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    amount = (
        F.when(F.col("o_totalprice") < 1500, F.lit("0.004"))
        .when(F.col("o_totalprice") < 2500, F.concat(F.lit("-"), F.col("o_custkey").cast("string")))
        .when(F.col("o_totalprice") < 5000, F.concat(F.lit("USD "), F.col("o_custkey").cast("string")))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("."),
                            F.lpad(F.pmod(F.col("o_orderkey") * 7, F.lit(1000)).cast("string"), 3, "0"))))
    day = F.dayofmonth(d) + F.when(F.dayofmonth(d) >= 28, F.lit(3)).otherwise(F.lit(0))
    date_raw = F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"), day.cast("string"))
    title = F.when(F.col("o_orderstatus") == "P", F.lit(" \t ")).otherwise(
        F.concat(F.lit("  order "), F.col("o_orderkey").cast("string"), F.lit("\u00a0")))
    return o.select(
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderkey").alias("txn_id"),
        title.alias("title"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("category"),
        amount.alias("amount"),
        date_raw.alias("date"),
        F.col("o_orderstatus").alias("description"),
    )


RAW_LEDGER_SQL = """(SELECT o_orderkey AS pos, o_orderkey AS txn_id,
        CASE WHEN o_orderstatus = 'P' THEN ' ' || chr(9) || ' '
             ELSE '  order ' || CAST(o_orderkey AS VARCHAR) || chr(160) END AS title,
        ' ' || o_orderpriority AS category,
        CASE WHEN o_totalprice < 1500 THEN '0.004'
             WHEN o_totalprice < 2500 THEN '-' || CAST(o_custkey AS VARCHAR)
             WHEN o_totalprice < 5000 THEN 'USD ' || CAST(o_custkey AS VARCHAR)
             ELSE CAST(o_custkey AS VARCHAR) || '.' || lpad(CAST((o_orderkey * 7) % 1000 AS VARCHAR), 3, '0') END AS amount,
        CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-' ||
        CAST(day(o_orderdate) + CASE WHEN day(o_orderdate) >= 28 THEN 3 ELSE 0 END AS VARCHAR) AS date,
        o_orderstatus AS description
   FROM orders)"""


def stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pos, value``: orders as stored JSON records, of which the key mod 11 picks the fault:
    no object, missing fields, amounts of every JSON kind, a day that does not
    exist, a blank title, an id that is no number, a negative amount."""
    kind = F.pmod(F.col("o_orderkey"), F.lit(11))
    amount = (F.when(kind == 2, (F.col("o_custkey") + 1).cast("string")).when(kind == 3, F.lit("1.5")).when(kind == 4, F.lit("true"))
              .when(kind == 5, F.lit("null")).when(kind == 9, F.lit('"-5"'))
              .otherwise(F.format_string('" %s "', F.col("o_totalprice").cast("decimal(28,2)").cast("string"))))
    day = F.when(kind == 6, F.lit("2026-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    title = F.when(kind == 7, F.lit("  ")).otherwise(F.concat(F.lit(" order "), F.col("o_orderkey").cast("string")))
    number = F.when(kind == 8, F.lit('"abc"')).otherwise(F.col("o_orderkey").cast("string"))
    some = F.format_string('{"txn_id": %s, "title": "%s", "category": "%s", "description": "%s"', number, title, F.col("o_orderpriority"), F.col("o_orderstatus"))
    text = (F.when(kind == 0, F.lit('"not a record"')).when(kind == 1, F.concat(some, F.lit("}")))
            .otherwise(F.concat(some, F.format_string(', "amount": %s, "date": "%s"}', amount, day))))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), text.alias("value"))


# -- status family: customers as a catalogue, events as commands --------------

def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("title"),
                    F.col("c_mktsegment").alias("author"),
                    F.lit(False).alias("is_borrowed"))


def status_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``purchase`` borrows, ``view`` returns; other events are not commands."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "view"))
    return ev.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"),
                     (F.col("event_type") == "purchase").alias("is_borrowed"))


# -- responses and intervals from events --------------------------------------

def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("request_id"), F.col("props").alias("text"),
                     F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"))


def event_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event opens ``[ts, ts + 10 minutes)``; one in fifty never ends."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("ts").alias("start"),
                     F.when(F.col("event_id") % 50 != 7, F.col("ts") + F.expr("INTERVAL 10 MINUTES")).alias("end"))


# -- corpus family: documents as folders with a README ------------------------

def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name`` is a folder name with a space (so quoting matters); the README
    text gets a heading since the documents have none."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id"),
        F.concat(F.col("source"), F.lit(" "), F.col("lang"), F.lit("-"), F.col("doc_id").cast("string")).alias("name"),
        F.concat(F.lit("# "), F.col("source"), F.lit(" "), F.col("doc_id").cast("string"), F.lit("\n"),
                 F.col("text")).alias("text"),
    )


CORPUS_SQL = """(SELECT doc_id, source || ' ' || lang || '-' || CAST(doc_id AS VARCHAR) AS name,
        '# ' || source || ' ' || CAST(doc_id AS VARCHAR) || chr(10) || text AS text
   FROM documents)"""
