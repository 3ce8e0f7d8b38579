"""Ledger files: strict Variant boundary, positions, versioned saves."""

import json
import os
from decimal import Decimal

import pytest

from tallyframe.operators import ledger as L
from tallyframe.operators.rules import ValidationError
from tallyframe.sources import ledger_store as S
from tallyframe.sources.ledger_store import LoadError, load_ledger, save_ledger

GOOD = [
    {"txn_id": 1, "date": "2026-01-08", "title": "Bread", "category": "Market", "amount": "31.40", "description": ""},
    {"txn_id": 2, "date": "2026-01-19", "title": "Train pass", "category": "Travel", "amount": "812.35",
     "description": "ten rides"},
    {"txn_id": 7, "date": "2026-02-03", "title": "Water bill", "category": "Utility", "amount": "4300.00",
     "description": ""},
]


def write(tmp, content, name="expenses.json"):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(content if isinstance(content, str) else json.dumps(content))
    return p


def test_load_three_records(spark, tmp):
    df = load_ledger(spark, write(tmp, GOOD))
    assert [r.txn_id for r in df.orderBy("pos").collect()] == [1, 2, 7]
    assert spark.range(1).select(L.next_id(df)).first()[0] == 8
    assert load_ledger(spark, write(tmp, GOOD)).count() == 3  # loading again replaces, never appends


def test_pretty_printed_array(spark, tmp):
    df = load_ledger(spark, write(tmp, json.dumps(GOOD, indent=2)))
    assert [r.txn_id for r in df.orderBy("pos").collect()] == [1, 2, 7]


def test_empty_array_and_missing_file(spark, tmp):
    assert load_ledger(spark, write(tmp, [])).count() == 0
    missing = load_ledger(spark, os.path.join(tmp, "nope.json"))
    assert missing.count() == 0
    assert spark.range(1).select(L.next_id(missing)).first()[0] == 1


@pytest.mark.parametrize("content,needle", [
    ("{not json at all", "invalid JSON"),
    ('{"a": 1}', "expected a list of records, got dict"),
])
def test_load_errors(spark, tmp, content, needle):
    with pytest.raises(LoadError, match=needle):
        load_ledger(spark, write(tmp, content))


def test_missing_fields_reported_sorted(spark, tmp):
    with pytest.raises(ValidationError) as e:
        load_ledger(spark, write(tmp, [{"txn_id": 1, "title": "x", "category": "y", "description": ""}]))
    assert str(e.value) == "Record at position 0 is invalid: missing field(s): amount, date"


def test_not_an_object_by_position(spark, tmp):
    with pytest.raises(ValidationError) as e:
        load_ledger(spark, write(tmp, [GOOD[0], GOOD[1], "not a record"]))
    assert e.value.position == 2
    assert str(e.value) == "Record at position 2 is invalid: expected an object, got str"


def test_value_errors_propagate(spark, tmp):
    bad_date = dict(GOOD[0], date="2026-13-45")
    with pytest.raises(ValidationError, match="Invalid date: '2026-13-45'"):
        load_ledger(spark, write(tmp, [bad_date]))
    neg = dict(GOOD[0], amount="-500.00")
    with pytest.raises(ValidationError, match="Invalid amount: -500.00"):
        load_ledger(spark, write(tmp, [neg]))


def test_json_types_of_amount(spark, tmp):
    rows = [dict(GOOD[0], amount=a) for a in (20, "20", 20.0, True, None, 19.99)]
    split = load_ledger(spark, write(tmp, rows), mode="quarantine")
    good = {r.pos: r.amount for r in split.good.collect()}
    assert good == {0: Decimal("20.00"), 1: Decimal("20.00")}
    bad = {r.pos: r.error for r in split.bad.collect()}
    assert bad[2] == "Invalid amount type: 'float' (20.0). Amount must be a Decimal, int, or numeric string." \
        or bad[2].startswith("Invalid amount type: 'float'")
    assert bad[3].startswith("Invalid amount type: 'bool' (True)")
    assert bad[4].startswith("Invalid amount type: 'NoneType' (None)")


def test_save_replaces_and_roundtrips(spark, tmp):
    store = os.path.join(tmp, "store")
    df = load_ledger(spark, write(tmp, GOOD))
    save_ledger(df, store)
    back = load_ledger(spark, store)
    assert sorted((r.txn_id, r.amount, r.description) for r in back.collect()) == [
        (1, Decimal("31.40"), ""), (2, Decimal("812.35"), "ten rides"), (7, Decimal("4300.00"), "")]
    save_ledger(back.where("txn_id = 2"), store)  # new version; the one being read is untouched
    assert [r.txn_id for r in load_ledger(spark, store).collect()] == [2]


def test_json_lines_form(spark, tmp):
    p = write(tmp, "\n".join(json.dumps(r) for r in GOOD) + "\n", "lines.jsonl")
    df = load_ledger(spark, p, json_lines=True)
    assert [r.txn_id for r in df.orderBy("pos").collect()] == [1, 2, 7]


def test_parquet_storage_versions(spark, tmp):
    from tallyframe.sources.ledger_store import JSON_STORAGE, PARQUET_STORAGE
    store = os.path.join(tmp, "pq")
    df = JSON_STORAGE.load(spark, write(tmp, GOOD))
    PARQUET_STORAGE.save(df, store)
    back = PARQUET_STORAGE.load(spark, store)
    PARQUET_STORAGE.save(back.where("txn_id > 1"), store)  # reads v1 while writing v2
    assert sorted(r.txn_id for r in PARQUET_STORAGE.load(spark, store).collect()) == [2, 7]


def test_json_lines_errors_name_the_line(spark, tmp):
    good = [json.dumps(r) for r in GOOD]
    p = write(tmp, "\n".join(good + ["{broken", good[0]]) + "\n", "bad.jsonl")
    with pytest.raises(LoadError, match="invalid JSON at line 4"):
        load_ledger(spark, p, json_lines=True)
    q = write(tmp, "\n".join(good[:2] + ['"not a record"'] + good) + "\n", "bad2.jsonl")
    with pytest.raises(ValidationError) as e:
        load_ledger(spark, q, json_lines=True)
    assert e.value.position == 2
    assert str(e.value) == "Record at position 2 is invalid: expected an object, got str"
    split = load_ledger(spark, q, json_lines=True, mode="quarantine")
    assert split.good.count() == 5 and [r.pos for r in split.bad.collect()] == [2]


def test_parquet_store_keeps_the_ledger_columns(spark, tmp):
    import datetime as dt

    from tallyframe.sources.ledger_store import PARQUET_STORAGE
    store = os.path.join(tmp, "bymonth")
    df = load_ledger(spark, write(tmp, GOOD))
    PARQUET_STORAGE.save(df, store)
    back = PARQUET_STORAGE.load(spark, store)
    assert back.columns == L.LEDGER_DDL_COLS
    assert sorted(r.txn_id for r in L.by_month(back, "2026-01").collect()) == [1, 2]
    assert sorted(r.txn_id for r in L.between(back, dt.date(2026, 1, 19), dt.date(2026, 2, 3)).collect()) == [2, 7]
    more = L.append(back, spark.createDataFrame([(0, None, dt.date(2026, 2, 2), "t", "c", Decimal("1.00"), "")], L.LEDGER_DDL))
    PARQUET_STORAGE.save(more, store)
    assert sorted(r.txn_id for r in L.by_month(PARQUET_STORAGE.load(spark, store), "2026-02").collect()) == [7, 8]


def test_a_crashed_save_does_not_block_the_next(spark, tmp):
    store = os.path.join(tmp, "crash")
    df = load_ledger(spark, write(tmp, GOOD))
    save_ledger(df, store)
    os.makedirs(os.path.join(store, "v000002"))  # no _SUCCESS: unfinished
    assert load_ledger(spark, store).count() == 3
    assert save_ledger(df.where("txn_id = 1"), store).endswith("v000003")
    assert load_ledger(spark, store).count() == 1


def test_plain_lines_are_numbered_by_line_in_both_modes(spark, tmp):
    rows = [dict(GOOD[0], pos=5), dict(GOOD[1], pos=5), GOOD[2]]
    p = write(tmp, "\n".join(json.dumps(r) for r in rows) + "\n", "own.jsonl")
    strict = load_ledger(spark, p, json_lines=True)
    good = load_ledger(spark, p, json_lines=True, mode="quarantine").good
    assert sorted(r.pos for r in strict.collect()) == sorted(r.pos for r in good.collect()) == [0, 1, 2]
    remaining, _, _ = L.remove(strict, spark.createDataFrame([(1,)], "txn_id long"))
    assert sorted(r.txn_id for r in remaining.collect()) == [2, 7]


def test_equal_positions_are_not_saved(spark, tmp):
    from tallyframe.sources.ledger_store import SaveError
    df = load_ledger(spark, write(tmp, GOOD))
    with pytest.raises(SaveError, match="distinct"):
        save_ledger(df.union(df), os.path.join(tmp, "twice"))


@pytest.mark.parametrize("value,kind", [(1.7, "float"), (True, "bool"), ("abc", "str"), ([1], "list")])
def test_an_id_that_is_no_integer_is_rejected(spark, tmp, value, kind):
    with pytest.raises(ValidationError, match=f"txn_id must be an integer or null, got {kind}"):
        load_ledger(spark, write(tmp, [GOOD[0], dict(GOOD[1], txn_id=value)]))
    assert load_ledger(spark, write(tmp, [dict(GOOD[0], txn_id=None)])).first().txn_id is None


def test_two_writers_of_one_version_get_two(spark, tmp, monkeypatch):
    from tallyframe.sources import ledger_store as S

    store = os.path.join(tmp, "shared")
    df = load_ledger(spark, write(tmp, GOOD))
    real, stale = S._next_number, []

    def late(spark, path):  # both writers look before either has claimed
        stale.append(1)
        return 1 if len(stale) <= 2 else real(spark, path)
    monkeypatch.setattr(S, "_next_number", late)
    one, two = save_ledger(df.where("txn_id = 1"), store), save_ledger(df.where("txn_id > 1"), store)
    assert [os.path.basename(p) for p in (one, two)] == ["v000001", "v000002"] and len(stale) == 3
    assert sorted(r.txn_id for r in load_ledger(spark, store).collect()) == [2, 7]


def test_the_rules_stand_in_the_plan_once(spark):
    from tallyframe.operators.rules import quarantine
    from tallyframe.sources.ledger_store import typed_elements

    lines = spark.createDataFrame([(0, json.dumps(GOOD[0])), (1, "{}")], "pos long, value string")
    from pyspark.sql import functions as F
    both = quarantine(typed_elements(lines.select("pos", F.try_parse_json("value").alias("v"))))
    for part in (both.good, both.bad):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("missing field(s)") == 1 and plan.count("try_parse_json") + plan.count("parse_json") <= 2
    assert both.good.count() == 1 and both.bad.first().error.startswith("Record at position 1 is invalid: missing field(s)")


def test_texts_stripped_as_python_does(spark):
    ends = ["", " ", "\t", "\x1f", "\u00a0", "\u3000", "\u200b", "é", "~", "!", "😀", "\x7f"]
    texts = [None, "", *[a + b + c for a in ends for b in ("", "x", "x y") for c in ends]]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S._stripped("t").alias("s")).collect()
    assert [r.s for r in found] == [None if r.t is None else r.t.strip() for r in found] and len(found) == len(texts)
