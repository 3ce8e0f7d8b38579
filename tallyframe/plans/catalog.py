"""Registered queries (one per operator in SURVEY §2) and their DuckDB text.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole driver tables.
Ordered results carry their order key or an explicit rank column, because the
driver compares results without regard to row order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import logs, rules
from tallyframe.plans import bindings as B
from tallyframe.session import checkpoint_dir, shared_table
from tallyframe.sources.logs import LEVELS, fake_log_lines, first_page_of, read_log_text, write_lines

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# Log family (SRC-1, PRJ-1, FLT-1, AGG-1, AGG-2, WIN-1, LIM-1, LIM-3, SRC-5)
# ---------------------------------------------------------------------------

ERROR_LEVEL = "ERROR"
PAGE_SIZE = 5

_PARSED_SQL = f"""(SELECT pos,
        CASE WHEN len(string_split(value, ' ')) >= 4
             THEN split_part(value, ' ', 1) || ' ' || split_part(value, ' ', 2) END AS ts,
        CASE WHEN len(string_split(value, ' ')) >= 4 THEN split_part(value, ' ', 3) END AS level,
        CASE WHEN len(string_split(value, ' ')) >= 4
             THEN substr(value, len(split_part(value, ' ', 1)) + len(split_part(value, ' ', 2))
                                + len(split_part(value, ' ', 3)) + 4) END AS msg,
        len(string_split(value, ' ')) < 4 AS malformed
   FROM {B.LOG_LINES_SQL})"""


def parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_lines(B.log_lines(spark, sf_dir))


@register("log_parse", f"SELECT pos, ts, level, msg, malformed FROM {_PARSED_SQL}")
def log_parse(spark, sf_dir):
    return parsed_log(spark, sf_dir).select("pos", "ts", "level", "msg", "malformed")


@register("log_only", f"SELECT pos, ts, level, msg FROM {_PARSED_SQL} WHERE level = '{ERROR_LEVEL}'")
def log_only(spark, sf_dir):
    return logs.only(parsed_log(spark, sf_dir), ERROR_LEVEL).select("pos", "ts", "level", "msg")


@register("log_level_counts", f"""
SELECT level, n, first_pos, CAST(row_number() OVER (ORDER BY n DESC, first_pos) AS BIGINT) AS rank
  FROM (SELECT level, count(*) AS n, min(pos) AS first_pos FROM {_PARSED_SQL}
         WHERE NOT malformed GROUP BY level)""")
def log_level_counts(spark, sf_dir):
    return logs.level_counts(parsed_log(spark, sf_dir))


@register("log_metrics", f"""
SELECT CAST(count(*) AS BIGINT) AS lines_read, CAST(count_if(malformed) AS BIGINT) AS malformed,
       CAST(count(DISTINCT level) FILTER (WHERE NOT malformed) AS BIGINT) AS levels
  FROM {_PARSED_SQL}""")
def log_metrics(spark, sf_dir):
    return logs.line_metrics(parsed_log(spark, sf_dir))


_FAULTY_SQL = _PARSED_SQL.replace(B.LOG_LINES_SQL, B.FAULTY_LOG_LINES_SQL)


def _faulty(spark, sf_dir):
    return logs.line_errors(logs.parse_lines(B.faulty_log_lines(spark, sf_dir)))


@register("log_prefix", f"""
SELECT pos, ts, level, msg FROM {_FAULTY_SQL}
 WHERE pos < coalesce((SELECT min(pos) FROM {_FAULTY_SQL} WHERE malformed), 9223372036854775807)""")
def log_prefix(spark, sf_dir):
    """Lines before the first malformed one, as a reader that stops there sees them."""
    return rules.prefix(_faulty(spark, sf_dir)).select("pos", "ts", "level", "msg")


@register("log_quarantine", f"SELECT pos, ts, level, msg FROM {_FAULTY_SQL} WHERE NOT malformed")
def log_quarantine(spark, sf_dir):
    return rules.quarantine(_faulty(spark, sf_dir)).good.select("pos", "ts", "level", "msg")


@register("log_rejects", f"""
SELECT pos, 'line at position ' || CAST(pos AS VARCHAR) || ' has fewer than four fields' AS error FROM {_FAULTY_SQL} WHERE malformed""")
def log_rejects(spark, sf_dir):
    return rules.quarantine(_faulty(spark, sf_dir)).bad.select("pos", "error")


@register("log_text_read", f"SELECT value, count(*) AS n FROM {B.LOG_LINES_SQL} GROUP BY value")
def log_text_read(spark, sf_dir):
    """Lines written as text files and read back, counted by text."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/log-{uuid.uuid4().hex[:12]}"
    write_lines(B.log_lines(spark, sf_dir), folder)
    return read_log_text(spark, folder).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@register("log_pages", f"""
SELECT pos, ts, level, msg,
       CAST((rn - 1) // {PAGE_SIZE} + 1 AS BIGINT) AS page_no, CAST((rn - 1) % {PAGE_SIZE} + 1 AS BIGINT) AS slot
  FROM (SELECT *, row_number() OVER (ORDER BY pos) AS rn FROM {_PARSED_SQL} WHERE level = '{ERROR_LEVEL}')""")
def log_pages(spark, sf_dir):
    return logs.pages(parsed_log(spark, sf_dir), ERROR_LEVEL, PAGE_SIZE).select(
        "pos", "ts", "level", "msg", "page_no", "slot")


@register("log_page_summary", f"""
SELECT CAST((rn - 1) // {PAGE_SIZE} + 1 AS BIGINT) AS page_no, CAST(count(*) AS BIGINT) AS n_rows,
       min(pos) AS first_pos, max(pos) AS last_pos
  FROM (SELECT *, row_number() OVER (ORDER BY pos) AS rn FROM {_PARSED_SQL} WHERE level = '{ERROR_LEVEL}')
 GROUP BY 1""")
def log_page_summary(spark, sf_dir):
    """One row per page (the page's rows are an ordered array in ``rows``;
    the registered result keeps the scalar columns)."""
    from tallyframe.operators.numbering import collect_pages
    paged = logs.pages(parsed_log(spark, sf_dir), ERROR_LEVEL, PAGE_SIZE).select("page_no", "slot", "pos")
    pages = collect_pages(paged)
    return pages.select("page_no", "n_rows", F.col("rows")[0]["pos"].alias("first_pos"),
                        F.element_at("rows", -1)["pos"].alias("last_pos"))


@register("log_first_page", f"""
SELECT pos, ts, level, msg FROM {_PARSED_SQL} WHERE level = '{ERROR_LEVEL}' ORDER BY pos LIMIT {PAGE_SIZE}""")
def log_first_page(spark, sf_dir):
    return logs.first_page(parsed_log(spark, sf_dir), ERROR_LEVEL, PAGE_SIZE).select("pos", "ts", "level", "msg")


@register("log_text_first_page", f"""
WITH placed AS (SELECT *, row_number() OVER (ORDER BY pos) AS line FROM {_PARSED_SQL}),
head AS (SELECT * FROM placed WHERE level = '{ERROR_LEVEL}' ORDER BY line LIMIT {PAGE_SIZE})
SELECT ts, level, msg, CAST((SELECT CASE WHEN count(*) < {PAGE_SIZE} THEN (SELECT count(*) FROM placed) ELSE max(line) END FROM head) AS BIGINT) AS lines_read FROM head""")
def log_text_first_page(spark, sf_dir):
    """The log written as text files in order; the first page and how many lines it took, read no further."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/log-{uuid.uuid4().hex[:12]}"
    write_lines(B.log_lines(spark, sf_dir).orderBy("pos"), folder)
    page = first_page_of(spark, folder, ERROR_LEVEL, PAGE_SIZE)
    return page.rows.select("ts", "level", "msg", F.lit(page.lines_read).cast("bigint").alias("lines_read"))


@register("log_scan_depth", f"""
WITH head AS (SELECT pos FROM {_PARSED_SQL} WHERE level = '{ERROR_LEVEL}' ORDER BY pos LIMIT {PAGE_SIZE})
SELECT CAST(CASE WHEN (SELECT count(*) FROM head) >= {PAGE_SIZE}
                 THEN count_if(pos <= (SELECT max(pos) FROM head)) ELSE count(*) END AS BIGINT) AS lines_read,
       CAST((SELECT count(*) FROM head) AS BIGINT) AS matches_in_page
  FROM {B.LOG_LINES_SQL}""")
def log_scan_depth(spark, sf_dir):
    return logs.scan_depth(parsed_log(spark, sf_dir), ERROR_LEVEL, PAGE_SIZE)


_DRAWN_SQL = f"""(SELECT event_id, list_extract({LEVELS}, CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':42'), 1, 7))::INT % 6 + 1 AS INT)) AS level
   FROM events)"""


@register("log_generate", f"""
SELECT level, n, first_pos, CAST(row_number() OVER (ORDER BY n DESC, first_pos) AS BIGINT) AS rank
  FROM (SELECT level, count(*) AS n, min(event_id) AS first_pos FROM {_DRAWN_SQL} GROUP BY level)""")
def log_generate(spark, sf_dir):
    """Synthetic lines, one per event id (so the volume follows the table),
    parsed and counted per level."""
    ids = B.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return logs.level_counts(logs.parse_lines(fake_log_lines(ids)))


# ---------------------------------------------------------------------------
# DuckDB helpers for the oracle text
# ---------------------------------------------------------------------------

from tallyframe.functions.text import WHITESPACE  # noqa: E402
from tallyframe.functions.values import DATE_PATTERN  # noqa: E402

_WS = "||".join(f"chr({ord(ch)})" for ch in WHITESPACE)


def sql_strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def sql_half_even(num: str, den: str) -> str:
    """round_half_even(num / den) on hugeint, as text."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    q, r = f"({n} // {d})", f"({n} % {d})"
    return f"({q} + CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"


def sql_avg(total: str, n: str) -> str:
    return f"CAST(CAST({sql_half_even(f'{total} * 100', n)} AS DECIMAL(38,0)) * 0.01 AS DECIMAL(38,2))"


def sql_share(part: str, whole: str) -> str:
    tenths = sql_half_even(f"CAST({part} * 100 AS HUGEINT) * 1000", f"{whole} * 100")
    return f"CAST(CAST({tenths} AS DECIMAL(38,0)) * 0.1 AS DECIMAL(5,1))"


def sql_money_text(x: str) -> str:
    return f"'₹' || format('{{:,.2f}}', {x})"


def sql_amount(x: str) -> str:
    return f"TRY_CAST({sql_strip(x)} AS DECIMAL(28,2))"


def sql_date(x: str) -> str:
    p = DATE_PATTERN
    iso = (f"regexp_extract({x}, '{p}', 1) || '-' || lpad(regexp_extract({x}, '{p}', 2), 2, '0') || '-' || "
           f"lpad(trim(regexp_extract({x}, '{p}', 3)), 2, '0')")
    return (f"CASE WHEN regexp_full_match({x}, '{p}') AND regexp_extract({x}, '{p}', 1) <> '0000' "
            f"THEN CAST(try_strptime({iso}, '%Y-%m-%d') AS DATE) END")


# ---------------------------------------------------------------------------
# Ledger family
# ---------------------------------------------------------------------------

from tallyframe.operators import ledger as L  # noqa: E402
from tallyframe.operators import reports as R  # noqa: E402

import datetime as _dt  # noqa: E402

CATEGORY = "  2-high "
MONTH = "1996-3"
RANGE = (_dt.date(1996, 1, 5), _dt.date(1996, 2, 1))
LIST_CATEGORY, LIST_MONTH = "3-MEDIUM", "1997-07"
LAST_CATEGORY, LAST_N = "5-low", 10

_LEDGER_COLS = "pos, txn_id, date, title, category, amount, description"


@register("ledger_money", f"""
SELECT pos, amount AS raw, {sql_amount('amount')} AS money,
       {sql_amount('amount')} > 0 AS positive FROM {B.RAW_LEDGER_SQL}""")
def ledger_money(spark, sf_dir):
    from tallyframe.functions.values import amount_from_text
    raw = B.raw_ledger(spark, sf_dir)
    money = amount_from_text("amount")
    return raw.select("pos", F.col("amount").alias("raw"), money.alias("money"), (money > 0).alias("positive"))


@register("ledger_date", f"SELECT pos, date AS raw, {sql_date('date')} AS parsed FROM {B.RAW_LEDGER_SQL}")
def ledger_date(spark, sf_dir):
    from tallyframe.functions.values import date_from_text
    raw = B.raw_ledger(spark, sf_dir)
    return raw.select("pos", F.col("date").alias("raw"), date_from_text("date").alias("parsed"))


@register("ledger_clean", f"""
SELECT pos, {sql_strip('title')} AS title, {sql_strip('category')} AS category,
       {sql_strip('description')} AS description FROM {B.RAW_LEDGER_SQL}""")
def ledger_clean(spark, sf_dir):
    return L.clean(B.raw_ledger(spark, sf_dir)).select("pos", "title", "category", "description")


_VALIDATE_SQL = f"""
SELECT pos, txn_id, {sql_date('date')} AS date, {sql_strip('title')} AS title,
       {sql_strip('category')} AS category, {sql_amount('amount')} AS amount,
       {sql_strip('description')} AS description,
       CASE WHEN title IS NULL OR {sql_strip('title')} = '' THEN 'text'
            WHEN category IS NULL OR {sql_strip('category')} = '' THEN 'text'
            WHEN {sql_amount('amount')} IS NULL THEN 'amount_type'
            WHEN {sql_amount('amount')} <= 0 THEN 'amount_value'
            WHEN {sql_date('date')} IS NULL THEN 'date'
            WHEN description IS NULL THEN 'text' END AS error_code,
       CASE WHEN title IS NULL OR {sql_strip('title')} = '' THEN 'Invalid title: must be a non-empty string.'
            WHEN category IS NULL OR {sql_strip('category')} = '' THEN 'Invalid category: must be a non-empty string.'
            WHEN {sql_amount('amount')} IS NULL
              THEN 'Invalid amount type: ''str'' (''' || amount || '''). Amount must be a Decimal, int, or numeric string.'
            WHEN {sql_amount('amount')} <= 0 THEN 'Invalid amount: ' || amount || '. Amount must be greater than zero.'
            WHEN {sql_date('date')} IS NULL
              THEN 'Invalid date: ''' || date || '''. Date must be a real calendar date in YYYY-MM-DD format.'
            WHEN description IS NULL THEN 'Invalid description: must be a non-empty string.' END AS error
  FROM {B.RAW_LEDGER_SQL}"""


@register("ledger_validate", _VALIDATE_SQL)
def ledger_validate(spark, sf_dir):
    return L.validate_text(B.raw_ledger(spark, sf_dir))


@register("ledger_serialize", f"""
SELECT pos, to_json(struct_pack(txn_id := txn_id, date := strftime(date, '%Y-%m-%d'), title := title,
       category := category, amount := CAST(amount AS VARCHAR), description := description))::VARCHAR AS json
  FROM {B.LEDGER_SQL}""")
def ledger_serialize(spark, sf_dir):
    lg = B.ledger(spark, sf_dir)
    return lg.select("pos", L.serialize(lg).alias("json"))


@register("ledger_label", f"""
SELECT pos, concat_ws(' | ', coalesce(CAST(txn_id AS VARCHAR), '--'), strftime(date, '%Y-%m-%d'), title,
       category, {sql_money_text('amount')}) AS label, {sql_money_text('amount')} AS money
  FROM {B.LEDGER_SQL}""")
def ledger_label(spark, sf_dir):
    from tallyframe.functions.text import money_text
    lg = B.ledger(spark, sf_dir)
    return lg.select("pos", L.label(lg).alias("label"), money_text("amount").alias("money"))


@register("ledger_by_category", f"""
SELECT {_LEDGER_COLS} FROM {B.LEDGER_SQL}
 WHERE upper({sql_strip('category')}) = upper({sql_strip("'" + CATEGORY + "'")})""")
def ledger_by_category(spark, sf_dir):
    return L.by_category(B.ledger(spark, sf_dir), CATEGORY)


@register("ledger_by_month", f"""
SELECT {_LEDGER_COLS} FROM {B.LEDGER_SQL} WHERE date >= DATE '1996-03-01' AND date < DATE '1996-04-01'""")
def ledger_by_month(spark, sf_dir):
    return L.by_month(B.ledger(spark, sf_dir), MONTH)


@register("ledger_between", f"""
SELECT {_LEDGER_COLS} FROM {B.LEDGER_SQL}
 WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""")
def ledger_between(spark, sf_dir):
    return L.between(B.ledger(spark, sf_dir), *RANGE)


@register("ledger_list", f"""
SELECT {_LEDGER_COLS} FROM {B.LEDGER_SQL}
 WHERE upper({sql_strip('category')}) = upper('{LIST_CATEGORY}')
   AND date >= DATE '1997-07-01' AND date < DATE '1997-08-01'""")
def ledger_list(spark, sf_dir):
    return L.list_rows(B.ledger(spark, sf_dir), LIST_CATEGORY, LIST_MONTH)


_LAST_SQL = f"""(SELECT * FROM {B.LEDGER_SQL}
  WHERE upper({sql_strip('category')}) = upper('{LAST_CATEGORY}')
  ORDER BY date DESC, coalesce(txn_id, 0) DESC, pos DESC LIMIT {LAST_N})"""


@register("ledger_last_n", f"SELECT {_LEDGER_COLS} FROM {_LAST_SQL}")
def ledger_last_n(spark, sf_dir):
    return L.last_n(L.by_category(B.ledger(spark, sf_dir), LAST_CATEGORY), LAST_N)


@register("ledger_list_footer", f"""
SELECT CAST(count(*) AS BIGINT) AS n, coalesce(sum(amount), 0)::DECIMAL(38,2) AS total FROM {_LAST_SQL}""")
def ledger_list_footer(spark, sf_dir):
    return L.totals(L.last_n(L.by_category(B.ledger(spark, sf_dir), LAST_CATEGORY), LAST_N))


@register("ledger_total", f"""
SELECT CAST(count(*) AS BIGINT) AS n, coalesce(sum(amount), 0)::DECIMAL(38,2) AS total FROM {B.LEDGER_SQL}""")
def ledger_total(spark, sf_dir):
    return L.totals(B.ledger(spark, sf_dir))


@register("ledger_category_total", f"""
SELECT CAST(count(*) AS BIGINT) AS n, coalesce(sum(amount), 0)::DECIMAL(38,2) AS total FROM {B.LEDGER_SQL}
 WHERE upper({sql_strip('category')}) = upper({sql_strip("'" + CATEGORY + "'")})""")
def ledger_category_total(spark, sf_dir):
    return L.totals(L.by_category(B.ledger(spark, sf_dir), CATEGORY))


@register("ledger_summary", f"""
SELECT n, total, earliest, latest, CASE WHEN n > 0 THEN {sql_avg('total', 'n')} END AS average
  FROM (SELECT CAST(count(*) AS BIGINT) AS n, coalesce(sum(amount), 0)::DECIMAL(38,2) AS total,
               min(date) AS earliest, max(date) AS latest FROM {B.LEDGER_SQL})""")
def ledger_summary(spark, sf_dir):
    return R.summary(B.ledger(spark, sf_dir))


@register("ledger_category", f"""
SELECT category, n, total, first_pos, {sql_share('total', f'(SELECT sum(amount) FROM {B.LEDGER_SQL})')} AS share,
       CAST(row_number() OVER (ORDER BY total DESC, first_pos) AS BIGINT) AS rank
  FROM (SELECT category, CAST(count(*) AS BIGINT) AS n, sum(amount) AS total, min(pos) AS first_pos
          FROM {B.LEDGER_SQL} GROUP BY category)""")
def ledger_category(spark, sf_dir):
    return R.category_breakdown(B.ledger(spark, sf_dir))


@register("ledger_monthly", f"""
SELECT strftime(date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS n, sum(amount) AS total
  FROM {B.LEDGER_SQL} GROUP BY 1""")
def ledger_monthly(spark, sf_dir):
    return R.monthly(B.ledger(spark, sf_dir))


@register("ledger_category_rollup", f"""
SELECT CASE WHEN grouping(category) = 1 THEN 'TOTAL' ELSE category END AS label,
       grouping(category) = 1 AS is_total, CAST(count(*) AS BIGINT) AS n, sum(amount) AS total
  FROM {B.LEDGER_SQL} GROUP BY ROLLUP (category)""")
def ledger_category_rollup(spark, sf_dir):
    return R.category_rollup(B.ledger(spark, sf_dir))


@register("ledger_monthly_rollup", f"""
SELECT CASE WHEN grouping(month) = 1 THEN 'TOTAL' ELSE month END AS label,
       grouping(month) = 1 AS is_total, CAST(count(*) AS BIGINT) AS n, sum(amount) AS total
  FROM (SELECT strftime(date, '%Y-%m') AS month, amount FROM {B.LEDGER_SQL}) GROUP BY ROLLUP (month)""")
def ledger_monthly_rollup(spark, sf_dir):
    return R.monthly_rollup(B.ledger(spark, sf_dir))


@register("ledger_categories", f"SELECT DISTINCT category FROM {B.LEDGER_SQL}")
def ledger_categories(spark, sf_dir):
    return L.categories(B.ledger(spark, sf_dir))


@register("ledger_next_id", f"""
SELECT CAST(coalesce(max(txn_id), 0) + 1 AS BIGINT) AS next_id FROM {B.LEDGER_SQL}""")
def ledger_next_id(spark, sf_dir):
    lg = B.ledger(spark, sf_dir)
    return spark.range(1).select(L.next_id(lg).alias("next_id"))


_COARSE_SQL = f"""(SELECT NULL::BIGINT AS txn_id, CAST(date_trunc('year', o_orderdate) AS DATE) AS date,
        o_orderstatus AS title, o_orderpriority AS category,
        CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) * 100000 + 100 AS DECIMAL(28,2)) AS amount,
        '' AS description FROM orders)"""


def _coarse_ledger(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    return o.select(
        F.lit(None).cast("bigint").alias("txn_id"), F.trunc(F.col("o_orderdate").cast("date"), "year").alias("date"),
        F.col("o_orderstatus").alias("title"), F.col("o_orderpriority").alias("category"),
        (F.floor(F.col("o_totalprice") / 100000).cast("bigint") * 100000 + 100).cast("decimal(28,2)").alias("amount"),
        F.lit("").alias("description"))


@register("ledger_distinct", f"""
SELECT DISTINCT txn_id, date, title, category, amount, description FROM (
  SELECT txn_id, date, title, category, amount, description FROM {B.LEDGER_SQL}
  UNION ALL SELECT txn_id, date, title, category, amount, description FROM {B.LEDGER_SQL}
  UNION ALL SELECT * FROM {_COARSE_SQL})""")
def ledger_distinct(spark, sf_dir):
    lg = B.ledger(spark, sf_dir).select(*L.FIELDS)
    return L.distinct_rows(lg.unionByName(lg).unionByName(_coarse_ledger(spark, sf_dir)))


@register("ledger_show", f"""
SELECT pos, field_no, label, value FROM (
  SELECT pos, unnest([1, 2, 3, 4, 5, 6])::BIGINT AS field_no,
         unnest(['Transaction', 'Date', 'Title', 'Category', 'Amount', 'Description']) AS label,
         unnest([CAST(txn_id AS VARCHAR), strftime(date, '%Y-%m-%d'), title, category,
                 {sql_money_text('amount')}, coalesce(nullif(description, ''), '(none)')]) AS value
    FROM {B.LEDGER_SQL})""")
def ledger_show(spark, sf_dir):
    return L.show_rows(B.ledger(spark, sf_dir))


def _keys(spark, sf_dir):
    """Every customer key, plus one negative key per nation that never matches."""
    cust = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("txn_id"))
    absent = B.table(spark, sf_dir, "nation").select((-1 - F.col("n_nationkey")).cast("bigint").alias("txn_id"))
    return cust.unionByName(absent)


_KEYS_SQL = "(SELECT c_custkey AS txn_id FROM customer UNION ALL SELECT CAST(-1 - n_nationkey AS BIGINT) FROM nation)"


@register("ledger_get", f"""
SELECT k.txn_id, f.pos, f.date, f.title, f.category, f.amount, f.description,
       CASE WHEN f.pos IS NULL THEN 'not_found' END AS error_code,
       CASE WHEN f.pos IS NULL THEN 'No expense found with transaction ID ' || CAST(k.txn_id AS VARCHAR) || '.' END AS error
  FROM (SELECT DISTINCT txn_id FROM {_KEYS_SQL}) k
  LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY pos) AS rn
                              FROM {B.LEDGER_BY_CUSTOMER_SQL}) WHERE rn = 1) f ON k.txn_id = f.txn_id""")
def ledger_get(spark, sf_dir):
    return L.get_many(B.ledger_by_customer(spark, sf_dir), _keys(spark, sf_dir))


@register("ledger_contains", f"""
SELECT c_custkey AS key, c_custkey IN (SELECT txn_id FROM {B.LEDGER_BY_CUSTOMER_SQL}) AS contains FROM customer""")
def ledger_contains(spark, sf_dir):
    keys = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return L.contains(B.ledger_by_customer(spark, sf_dir), keys, "key")


_FIRSTS_SQL = f"""(SELECT min(pos) AS pos FROM {B.LEDGER_BY_CUSTOMER_SQL}
   WHERE txn_id IN (SELECT txn_id FROM {_KEYS_SQL}) GROUP BY txn_id)"""


@register("ledger_remove", f"""
SELECT {_LEDGER_COLS} FROM {B.LEDGER_BY_CUSTOMER_SQL} WHERE pos NOT IN {_FIRSTS_SQL}""")
def ledger_remove(spark, sf_dir):
    return L.remove(B.ledger_by_customer(spark, sf_dir), _keys(spark, sf_dir))[0]


@register("ledger_removed_rows", f"""
SELECT {_LEDGER_COLS} FROM {B.LEDGER_BY_CUSTOMER_SQL} WHERE pos IN {_FIRSTS_SQL}""")
def ledger_removed_rows(spark, sf_dir):
    return L.remove(B.ledger_by_customer(spark, sf_dir), _keys(spark, sf_dir))[1]


@register("ledger_missing_ids", f"""
SELECT DISTINCT txn_id FROM {_KEYS_SQL}
 WHERE txn_id NOT IN (SELECT txn_id FROM {B.LEDGER_BY_CUSTOMER_SQL})""")
def ledger_missing_ids(spark, sf_dir):
    return L.remove(B.ledger_by_customer(spark, sf_dir), _keys(spark, sf_dir))[2]


def _new_expenses(spark, sf_dir):
    c = B.table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("pos"), F.lit(None).cast("bigint").alias("txn_id"),
        F.lit(_dt.date(2026, 1, 5)).alias("date"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("category"),
        (F.abs(F.col("c_acctbal")) + 1).cast("decimal(28,2)").alias("amount"),
        F.lit("").alias("description"))


@register("ledger_append", f"""
SELECT {_LEDGER_COLS} FROM {B.LEDGER_SQL}
UNION ALL
SELECT (SELECT max(pos) FROM {B.LEDGER_SQL}) + rn AS pos,
       CAST((SELECT coalesce(max(txn_id), 0) + 1 FROM {B.LEDGER_SQL}) + rn - 1 AS BIGINT) AS txn_id,
       DATE '2026-01-05' AS date, c_name AS title, c_mktsegment AS category,
       CAST(abs(c_acctbal) + 1 AS DECIMAL(28,2)) AS amount, '' AS description
  FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer)""")
def ledger_append(spark, sf_dir):
    return L.append(B.ledger(spark, sf_dir), _new_expenses(spark, sf_dir))


# ---------------------------------------------------------------------------
# Record pipeline family (PRJ-2, PRJ-3, VAL-1, VAL-2, VAL-9, UDF-1..6, SNK-3)
# ---------------------------------------------------------------------------


from tallyframe.operators import records as P  # noqa: E402
from tallyframe.operators import rules  # noqa: E402

SCALE = 1.1

_PIPE_ERR = (f"CASE WHEN name IS NULL OR {sql_strip('name')} = '' THEN 'record ' || id || ' has an empty name' "
             f"WHEN value < 0 THEN 'negative value in record ' || id END")
_PIPE_RUN_SQL = f"""(SELECT id, lower({sql_strip('name')}) AS name, value * {SCALE} AS value, segment,
        {_PIPE_ERR} AS error FROM {B.RECORDS_SQL})"""


def _pipe_run(spark, sf_dir):
    return P.run(B.records(spark, sf_dir), P.default_steps())


@register("pipe_normalize", f"SELECT id, lower({sql_strip('name')}) AS name, value, segment FROM {B.RECORDS_SQL}")
def pipe_normalize(spark, sf_dir):
    return P.normalize()(B.records(spark, sf_dir))


@register("pipe_scale", f"SELECT id, name, value * {SCALE} AS value, segment FROM {B.RECORDS_SQL}")
def pipe_scale(spark, sf_dir):
    return P.scale(SCALE)(B.records(spark, sf_dir))


@register("pipe_validate", f"SELECT id, name, value, segment, {_PIPE_ERR} AS error FROM {B.RECORDS_SQL}")
def pipe_validate(spark, sf_dir):
    return P.run(B.records(spark, sf_dir), [P.required_name(), P.require_non_negative_value()])


@register("pipe_run", f"SELECT * FROM {_PIPE_RUN_SQL}")
def pipe_run(spark, sf_dir):
    return _pipe_run(spark, sf_dir)


@register("pipe_prefix", f"""
SELECT id, name, value, segment FROM {_PIPE_RUN_SQL}
 WHERE id < coalesce((SELECT min(id) FROM {_PIPE_RUN_SQL} WHERE error IS NOT NULL), 9223372036854775807)""")
def pipe_prefix(spark, sf_dir):
    return rules.prefix(_pipe_run(spark, sf_dir), pos_col="id", code_col="__none")


@register("pipe_quarantine", f"SELECT id, name, value, segment FROM {_PIPE_RUN_SQL} WHERE error IS NULL")
def pipe_quarantine(spark, sf_dir):
    return rules.quarantine(_pipe_run(spark, sf_dir), code_col="__none").good


@register("pipe_rejects", f"SELECT id, error FROM {_PIPE_RUN_SQL} WHERE error IS NOT NULL")
def pipe_rejects(spark, sf_dir):
    return rules.quarantine(_pipe_run(spark, sf_dir), code_col="__none").bad.select("id", "error")


@register("pipe_step_counts", f"""
SELECT CAST(count(*) AS BIGINT) AS seen_first,
       CAST(count(*) FILTER (WHERE NOT (name IS NULL OR {sql_strip('name')} = '')) AS BIGINT) AS ok_after_name,
       CAST(count(*) FILTER (WHERE {_PIPE_ERR} IS NULL) AS BIGINT) AS ok_after_value
  FROM {B.RECORDS_SQL}""")
def pipe_step_counts(spark, sf_dir):
    """How many records pass each step, counted by spies in the written result."""
    steps = [P.spy("seen_first"), P.required_name(), P.spy("ok_after_name"), P.require_non_negative_value(), P.spy("ok_after_value"), P.normalize(), P.scale(SCALE)]
    return P.spied(B.records(spark, sf_dir), steps)[1]


def _letters(records):
    return records.assign(letters=["".join(sorted(set(name))) for name in records["name"]])[["id", "letters"]]


@register("pipe_python_step", f"SELECT id, array_to_string(list_sort(list_distinct(string_split(name, ''))), '') AS letters FROM {B.RECORDS_SQL}")
def pipe_python_step(spark, sf_dir):
    """A step in Python, batch by batch: the different letters of each name."""
    return P.python_step(_letters, "id bigint, letters string")(B.records(spark, sf_dir))


@register("pipe_to_json", f"""
SELECT id, '{{' || chr(10) || '  "id": ' || CAST(id AS VARCHAR) || ',' || chr(10) ||
       '  "name": ' || to_json(name)::VARCHAR || ',' || chr(10) ||
       '  "value": ' || CAST(value AS VARCHAR) || ',' || chr(10) ||
       '  "segment": ' || to_json(segment)::VARCHAR || chr(10) || '}}' AS json
  FROM {_PIPE_RUN_SQL} WHERE error IS NULL""")
def pipe_to_json(spark, sf_dir):
    good = rules.quarantine(_pipe_run(spark, sf_dir), code_col="__none").good
    return good.select("id", P.pretty_json(good).alias("json"))


def _divide_by_id(value, event_id):
    return value / (event_id % 7)


@register("map_capture", """
SELECT event_id AS pos, CASE WHEN event_id % 7 <> 0 THEN value / (event_id % 7) END AS result,
       CASE WHEN event_id % 7 = 0 THEN 'ZeroDivisionError: float division by zero' END AS error
  FROM events""")
def map_capture(spark, sf_dir):
    ev = B.table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), "value", "event_id")
    return P.capture_map(ev, _divide_by_id, ["value", "event_id"])


# ---------------------------------------------------------------------------
# Responses and intervals (FLT-9, AGG-13, AGG-14)
# ---------------------------------------------------------------------------

from tallyframe.operators import events as EV  # noqa: E402


@register("response_summary", """
SELECT CAST(count(*) AS BIGINT) AS completed,
       CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS successful FROM events""")
def response_summary(spark, sf_dir):
    return EV.response_summary(B.responses(spark, sf_dir))


@register("peak_overlap", """
WITH d AS (SELECT ts AS t, 1 AS d FROM events
           UNION ALL SELECT ts + INTERVAL 10 MINUTE, -1 FROM events WHERE event_id % 50 <> 7)
SELECT CAST(greatest(coalesce(max(r), 0), 0) AS BIGINT) AS peak
  FROM (SELECT sum(d) OVER (ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS r FROM d)""")
def peak_overlap(spark, sf_dir):
    return EV.peak_overlap(B.event_intervals(spark, sf_dir))


# ---------------------------------------------------------------------------
# Status updates and labels (DML-5, PRJ-14, PRJ-15)
# ---------------------------------------------------------------------------

from tallyframe.operators import changes as C  # noqa: E402

_STATUS_SQL = """(SELECT c_custkey AS key, c_name AS title, c_mktsegment AS author,
        coalesce(l.v, false) AS is_borrowed
   FROM customer LEFT JOIN (SELECT user_id, arg_max(event_type = 'purchase', event_id) AS v
                              FROM events WHERE event_type IN ('purchase', 'view') GROUP BY user_id) l
     ON l.user_id = c_custkey)"""


def _status(spark, sf_dir):
    return C.apply_status(B.catalogue(spark, sf_dir), B.status_commands(spark, sf_dir))


@register("status_apply", f"SELECT key, title, author, is_borrowed FROM {_STATUS_SQL}")
def status_apply(spark, sf_dir):
    return _status(spark, sf_dir).select("key", "title", "author", "is_borrowed")


@register("status_label", f"""
SELECT key, title || ' by ' || author || CASE WHEN is_borrowed THEN ' (Borrowed)' ELSE ' (Available)' END AS label
  FROM {_STATUS_SQL}""")
def status_label(spark, sf_dir):
    return _status(spark, sf_dir).select("key", C.status_label().alias("label"))


@register("task_label", """
SELECT o_orderkey AS pos, 'order ' || CAST(o_orderkey AS VARCHAR) || ' (Priority: ' || o_orderpriority || ')' AS label
  FROM orders""")
def task_label(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    tasks = o.select(F.col("o_orderkey").alias("pos"),
                     F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
                     F.col("o_orderpriority").alias("priority"))
    return tasks.select("pos", C.task_label().alias("label"))


# ---------------------------------------------------------------------------
# Corpus family (SRC-6, SNK-4, PRJ-16..19, FLT-8, JN-1)
# ---------------------------------------------------------------------------

from tallyframe.operators import corpus as K  # noqa: E402

_LINE_BREAK_RE2 = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
_SKIP_SQL = " OR ".join(f"starts_with(s, '{p}')" for p in K.SKIP_PREFIXES)
_IGNORE_SQL = ", ".join(f"'{n}'" for n in K.IGNORE)


def sql_title(text: str, name: str) -> str:
    pat = r"(?m)^#\s+(.+)$"
    return (f"CASE WHEN regexp_matches({text}, '{pat}') "
            f"THEN {sql_strip(f'regexp_extract({text}, {chr(39)}{pat}{chr(39)}, 1)')} ELSE {name} END")


def sql_blurb(text: str) -> str:
    lines = f"string_split_regex({text}, '{_LINE_BREAK_RE2}')"
    stripped = f"list_transform({lines}, lambda x: {sql_strip('x')})"
    return f"coalesce(list_filter({stripped}, lambda s: s <> '' AND NOT ({_SKIP_SQL}))[1], '')"


def sql_quote(x: str) -> str:
    return f"replace(url_encode({x}), '%2F', '/')"


_INDEX_SQL = f"""(SELECT doc_id, name, {sql_title('text', 'name')} AS title, {sql_blurb('text')} AS blurb, text
   FROM {B.CORPUS_SQL} WHERE name NOT IN ({_IGNORE_SQL}) AND NOT starts_with(name, '.'))"""


def sql_index_row() -> str:
    return (f"'| [' || title || '](./' || {sql_quote('name')} || ') | ' || "
            f"CASE WHEN blurb = '' THEN '{K.PLACEHOLDER}' ELSE blurb END || ' |'")


def _index(spark, sf_dir):
    docs = B.corpus(spark, sf_dir)
    return docs.where(K.visible("name")).select(
        "doc_id", "name", "text", K.title_of("text", "name").alias("title"), K.blurb_of("text").alias("blurb"))


_PLACED_SQL = f"(SELECT *, row_number() OVER (ORDER BY name) - 1 AS pos FROM {_INDEX_SQL})"


@register("corpus_index", f"SELECT name, title, blurb, pos FROM {_PLACED_SQL}")
def corpus_index(spark, sf_dir):
    return K.index(B.corpus(spark, sf_dir))


@register("corpus_index_rows", f"SELECT name, pos, {sql_index_row()} AS row FROM {_PLACED_SQL}")
def corpus_index_rows(spark, sf_dir):
    return K.index(B.corpus(spark, sf_dir)).select("name", "pos", K.index_row().alias("row"))


@register("corpus_table", f"""
WITH placed AS {_PLACED_SQL}
SELECT pos, {sql_index_row()} AS line FROM placed
UNION ALL SELECT * FROM (VALUES (-4, '{K.START}'), (-3, ''), (-2, '| Project | What it covers |'), (-1, '| --- | --- |'))
UNION ALL SELECT count(*), '' FROM placed UNION ALL SELECT count(*) + 1, '{K.END}' FROM placed""")
def corpus_table(spark, sf_dir):
    """The whole marked block, a line a row."""
    return K.index_table(K.index(B.corpus(spark, sf_dir)))


@register("url_quote", f"SELECT doc_id, {sql_quote('name')} AS quoted_name, {sql_quote('text')} AS quoted_text FROM {B.CORPUS_SQL}")
def url_quote(spark, sf_dir):
    from tallyframe.functions.text import url_quote as q
    docs = B.corpus(spark, sf_dir)
    return docs.select("doc_id", q("name").alias("quoted_name"), q("text").alias("quoted_text"))


_README_SQL = f"""(SELECT i.*, CASE WHEN l.doc_id IS NOT NULL
          THEN 'Intro' || chr(10) || '{K.START}' || chr(10) || 'stale' || chr(10) || '{K.END}' || chr(10) || i.text
          ELSE i.text END AS readme
   FROM {_INDEX_SQL} i LEFT JOIN labels l ON l.doc_id = i.doc_id)"""


@register("block_replace", f"""
SELECT doc_id,
       CASE WHEN regexp_matches(readme, '{K.block_pattern()}')
            THEN regexp_replace(readme, '{K.block_pattern()}', replace(block, '\\', '\\\\'), 'g') ELSE readme END AS new_text,
       regexp_matches(readme, '{K.block_pattern()}')
         AND regexp_replace(readme, '{K.block_pattern()}', replace(block, '\\', '\\\\'), 'g') <> readme AS changed,
       CASE WHEN NOT regexp_matches(readme, '{K.block_pattern()}')
            THEN 'Markers not found. Add {K.START} and {K.END} to README.md.' END AS error
  FROM (SELECT *, '{K.START}' || chr(10) || chr(10) || '| Project | What it covers |' || chr(10) || '| --- | --- |'
                  || chr(10) || {sql_index_row()} || chr(10) || chr(10) || '{K.END}' AS block FROM {_README_SQL})""")
def block_replace(spark, sf_dir):
    idx = _index(spark, sf_dir)
    labelled = B.table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("__has"))
    readme = F.when(F.col("__has"), F.concat(F.lit(f"Intro\n{K.START}\nstale\n{K.END}\n"), F.col("text"))).otherwise(
        F.col("text"))
    docs = idx.join(labelled, "doc_id", "left").withColumn("readme", readme)
    out = K.replace_block(docs, "readme", K.marked_block(K.index_row()))
    return out.select("doc_id", "new_text", "changed", "error")


@register("corpus_left_join", """
SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic, l.doc_id IS NOT NULL AS labelled
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def corpus_left_join(spark, sf_dir):
    d = B.table(spark, sf_dir, "documents").select("doc_id")
    lab = B.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.lit(True).alias("labelled"))
    return d.join(lab, "doc_id", "left").select(
        "doc_id", F.coalesce("quality", F.lit(0)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
        F.coalesce("labelled", F.lit(False)).alias("labelled"))


# ---------------------------------------------------------------------------
# Streaming (STR-2): the level count as a Structured Streaming query
# ---------------------------------------------------------------------------

@register("log_stream_counts", f"""
SELECT level, CAST(count(*) AS BIGINT) AS n FROM {_PARSED_SQL} WHERE NOT malformed GROUP BY level""")
def log_stream_counts(spark, sf_dir):
    """The events file read as a stream (``availableNow``), turned into log
    lines and counted per level in complete mode; each micro-batch writes a version
    under the shared checkpoint dir, the last complete one is returned."""
    from tallyframe.streaming.logs import latest_counts, start_level_counts

    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    # the file source follows a folder; the glob filter picks the one table
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.upper("event_type"), F.col("props"))
    name = f"tf_stream_counts_{uuid.uuid4().hex[:8]}"
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    q = start_level_counts(spark, sf_dir, name, checkpoint=f"{base}/checkpoint", sink_path=f"{base}/counts",
                           source=logs.parse_lines(events.select(line.alias("value"))))
    q.awaitTermination()
    return latest_counts(spark, f"{base}/counts").select("level", F.col("n").cast("bigint").alias("n"))


@register("log_follow", f"SELECT ts, level, msg, malformed FROM {_PARSED_SQL} WHERE level = '{ERROR_LEVEL}'")
def log_follow(spark, sf_dir):
    """A log folder followed in two runs, with files added between them: the second goes on from the
    first one's checkpoint, and the sink holds every record once."""
    from tallyframe.streaming.logs import start_follow

    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/follow-{uuid.uuid4().hex[:8]}"
    lines = B.log_lines(spark, sf_dir)
    for part in range(2):
        write_lines(lines.where(F.col("pos") % 2 == part), f"{base}/log/{part}")
        start_follow(spark, f"{base}/log/*", ERROR_LEVEL, f"{base}/found", checkpoint=f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/found").select("ts", "level", "msg", "malformed")


# ---------------------------------------------------------------------------
# Stored ledger records (SRC-3, PRJ-8, VAL-6, VAL-7, SET-2), other tables (DML-3, DML-6, DML-7, ORD-2, SRC-2, UDF-5, UDF-7, UDF-8)
# ---------------------------------------------------------------------------

from tallyframe.operators import numbering as N  # noqa: E402
from tallyframe.operators import reports as R  # noqa: E402
from tallyframe.sources import ledger_store as S  # noqa: E402
from tallyframe.sources.documents import write_arrays  # noqa: E402

_STORED_SQL = """(SELECT *, CASE kind WHEN 0 THEN 'corrupt' WHEN 1 THEN 'corrupt' WHEN 8 THEN 'corrupt' WHEN 3 THEN 'amount_type' WHEN 4 THEN 'amount_type'
          WHEN 5 THEN 'amount_type' WHEN 6 THEN 'date' WHEN 7 THEN 'text' WHEN 9 THEN 'amount_value' END AS error_code,
        CASE kind WHEN 0 THEN said || 'expected an object, got str' WHEN 1 THEN said || 'missing field(s): amount, date'
          WHEN 8 THEN said || 'txn_id must be an integer or null, got str'
          WHEN 3 THEN 'Invalid amount type: ''float'' (1.5)' || kinds WHEN 4 THEN 'Invalid amount type: ''bool'' (True)' || kinds
          WHEN 5 THEN 'Invalid amount type: ''NoneType'' (None)' || kinds
          WHEN 6 THEN 'Invalid date: ''2026-02-30''. Date must be a real calendar date in YYYY-MM-DD format.'
          WHEN 7 THEN 'Invalid title: must be a non-empty string.' WHEN 9 THEN 'Invalid amount: -5. Amount must be greater than zero.' END AS error
   FROM (SELECT o_orderkey AS pos, o_orderkey % 11 AS kind, 'Record at position ' || CAST(o_orderkey AS VARCHAR) || ' is invalid: ' AS said,
                '. Amount must be a Decimal, int, or numeric string.' AS kinds, * FROM orders))"""


def _stored(spark, sf_dir):
    files = 2 * spark.sparkContext.defaultParallelism  # several, as a ledger has
    lines = shared_table(B.stored_records(spark, sf_dir).repartition(files), "stored")
    return S.typed_elements(lines.select("pos", F.try_parse_json("value").alias("v")))


@register("ledger_load_good", f"""
SELECT pos, pos AS txn_id, CAST(o_orderdate AS DATE) AS date, 'order ' || CAST(pos AS VARCHAR) AS title, o_orderpriority AS category,
       CASE WHEN kind = 2 THEN CAST(o_custkey + 1 AS DECIMAL(28,2)) ELSE CAST(o_totalprice AS DECIMAL(28,2)) END AS amount, o_orderstatus AS description
  FROM {_STORED_SQL} WHERE error IS NULL""")
def ledger_load_good(spark, sf_dir):
    return rules.quarantine(_stored(spark, sf_dir)).good.select(*L.LEDGER_DDL_COLS)


@register("ledger_load_rejects", f"SELECT pos, error_code, error FROM {_STORED_SQL} WHERE error IS NOT NULL")
def ledger_load_rejects(spark, sf_dir):
    return rules.quarantine(_stored(spark, sf_dir)).bad.select("pos", "error_code", "error")


@register("ledger_load_first_error", f"""
SELECT pos AS position, error_code AS code, error AS message FROM {_STORED_SQL} WHERE error IS NOT NULL ORDER BY pos LIMIT 1""")
def ledger_load_first_error(spark, sf_dir):
    return rules.first_failure(_stored(spark, sf_dir))


def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@register("ledger_array_load", f"SELECT txn_id, date, title, category, amount, description FROM {B.LEDGER_SQL}")
def ledger_array_load(spark, sf_dir):
    """The ledger written as JSON array files and loaded by the strict rules; every file numbers its own records."""
    folder, rows = _folder(spark, "ledger-arrays"), B.ledger(spark, sf_dir)
    write_arrays(rows.select(L.serialize(rows).alias("value")), folder)
    return S.load_ledger(spark, folder).drop("pos")


@register("ledger_lines_load", f"""
SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, txn_id, date, title, category, amount, description FROM {B.LEDGER_SQL}""")
def ledger_lines_load(spark, sf_dir):
    """The ledger written as JSON Lines and loaded by the strict rules, numbered by line."""
    folder, rows = _folder(spark, "ledger-lines"), B.ledger(spark, sf_dir)
    write_lines(rows.orderBy("pos").select(L.serialize(rows).alias("value")), folder)
    return S.load_ledger(spark, folder, json_lines=True)


@register("ledger_store_roundtrip", f"SELECT * FROM {B.LEDGER_SQL}")
def ledger_store_roundtrip(spark, sf_dir):
    """The ledger saved to the parquet store and loaded again."""
    folder = _folder(spark, "ledger")
    S.PARQUET_STORAGE.save(B.ledger(spark, sf_dir), folder)
    return S.PARQUET_STORAGE.load(spark, folder)


@register("ledger_clear", f"SELECT * FROM {B.LEDGER_SQL} WHERE false")
def ledger_clear(spark, sf_dir):
    return L.empty_like(B.ledger(spark, sf_dir))


@register("ledger_in_order", f"SELECT pos, title, row_number() OVER (ORDER BY pos) AS place FROM {B.LEDGER_SQL}")
def ledger_in_order(spark, sf_dir):
    return N.with_row_number(B.ledger(spark, sf_dir).select("pos", "title"), "pos", "place")


@register("ledger_report", f"""
SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, sum(amount) AS total FROM {B.LEDGER_SQL} GROUP BY 1""")
def ledger_report(spark, sf_dir):
    return R.get_report("monthly")(B.ledger(spark, sf_dir))


@register("rows_add", "SELECT o_orderkey AS pos FROM orders UNION ALL SELECT l_orderkey FROM lineitem")
def rows_add(spark, sf_dir):
    return C.add_rows(B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos")),
                      B.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pos")))


@register("rows_remove", "SELECT c_custkey AS pos, c_name FROM customer WHERE c_custkey <> (SELECT max(c_custkey) FROM customer)")
def rows_remove(spark, sf_dir):
    rows = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), "c_name")
    return C.remove_row(rows, rows.agg(F.max("pos")).first()[0])


@register("records_read", f"SELECT id, name, value FROM {B.RECORDS_SQL}")
def records_read(spark, sf_dir):
    """Records written as JSON Lines and read back with the fixed schema."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/records-{uuid.uuid4().hex[:12]}"
    B.records(spark, sf_dir).select("id", "name", "value").write.json(folder)
    return P.read_records(spark, folder, json_lines=True)
