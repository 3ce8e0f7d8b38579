"""Record pipeline: step order, rules, policies, spies, capture map, JSON output."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyframe.operators import records as P
from tallyframe.operators import rules

ROWS = [(1, "a", 1.0), (2, "b", 2.0), (3, "  MiXed ", 0.0), (4, "   ", 1.0), (5, "x", -0.5), (6, "y", 3.0)]


@pytest.fixture()
def recs(spark):
    return spark.createDataFrame(ROWS, P.RECORD_DDL)


def test_default_pipeline_messages_and_values(recs):
    out = {r.id: r for r in P.run(recs, P.default_steps()).collect()}
    assert out[2].value == pytest.approx(2.2) and out[2].value == 2.0 * 1.1
    assert out[3].name == "mixed" and out[3].error is None  # zero passes
    assert out[4].error == "record 4 has an empty name"
    assert out[5].error == "negative value in record 5"


def test_no_steps_is_identity(recs):
    assert P.run(recs, []).drop("error").collect() == recs.collect()


def test_prefix_policy_emits_rows_before_first_failure(recs):
    ran = P.run(recs, P.default_steps())
    assert [r.id for r in rules.prefix(ran, pos_col="id").orderBy("id").collect()] == [1, 2, 3]


def test_quarantine_and_strict(recs):
    ran = P.run(recs, P.default_steps())
    split = rules.quarantine(ran)
    assert sorted(r.id for r in split.good.collect()) == [1, 2, 3, 6]
    assert sorted(r.id for r in split.bad.collect()) == [4, 5]
    with pytest.raises(rules.ValidationError) as e:
        rules.strict(ran.withColumn("error_code", F.lit("x")), pos_col="id")
    assert e.value.position == 4 and str(e.value) == "record 4 has an empty name"


def test_step_order_matters(recs):
    # scaling before the check sees scaled values: -0.5 * 10 is still negative, 0.0 stays allowed
    ran = P.run(recs, [P.scale(10), P.require_non_negative_value()])
    assert sorted(r.id for r in ran.where("error IS NOT NULL").collect()) == [5]


def test_spy_sees_each_record_once(recs):
    obs = Observation("spy")
    ids = sorted(r.id for r in P.run(recs.where("id <= 2"), [P.spy(obs)]).collect())
    assert ids == [1, 2] and obs.get["records"] == 2


def test_python_step(recs):
    def double(pdf):
        return pdf.assign(value=pdf["value"] * 2)
    out = P.run(recs, [P.python_step(double, "id bigint, name string, value double, error string")])
    assert sorted(r.value for r in out.collect())[-1] == 6.0


def test_capture_map_keeps_order_and_isolates_errors(spark):
    params = spark.createDataFrame([(0, "3"), (1, "5"), (2, "q"), (3, "2"), (4, "9")], "pos long, p string")
    out = P.capture_map(params, lambda p: f"Job result: {int(p)}", ["p"], result_type="string")
    got = out.orderBy("pos").collect()
    assert [r.result for r in got] == ["Job result: 3", "Job result: 5", None, "Job result: 2", "Job result: 9"]
    assert got[2].error.startswith("ValueError: invalid literal for int()")
    assert sum(r.error is not None for r in got) == 1


def test_pretty_json_matches_json_dumps(spark):
    df = spark.createDataFrame([(1, 'a "q"', 2.2000000000000002), (2, "b", -0.5)], P.RECORD_DDL)
    got = [r[0] for r in df.orderBy("id").select(P.pretty_json(df)).collect()]
    assert got == [json.dumps({"id": 1, "name": 'a "q"', "value": 2.2000000000000002}, indent=2),
                   json.dumps({"id": 2, "name": "b", "value": -0.5}, indent=2)]


def test_read_records_array_and_lines(spark, tmp):
    import os
    p = os.path.join(tmp, "r.json")
    with open(p, "w") as f:
        json.dump([{"id": 1, "name": "a", "value": 1.0}, {"id": 2, "name": "b", "value": 2.0, "extra": 1}], f)
    assert [r.id for r in P.read_records(spark, p).collect()] == [1, 2]
    q = os.path.join(tmp, "r.jsonl")
    with open(q, "w") as f:
        f.write('{"id": 1, "name": "a", "value": 1.0}\n{"id": 2, "name": "b", "value": 2.0}\n')
    assert P.read_records(spark, q, json_lines=True).count() == 2


def test_pretty_json_equals_json_dumps(spark):
    import json
    values = [0.0, -0.0, 1.5, 12345678.9, 1e7, 0.0001, 0.00012345, 1e-5, 1.25e-7, 1e15, 123456789012345680.0, 1e16, 1e22, -2.5e300, 3.0, 100000.0]
    names = ["plain", "é₹ \U0001f642", 'q"\\/\n\t', "\x01\x7f", "", None]
    rows = [(i, names[i % len(names)], v, i % 2 == 0) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, 'id long, `n"é` string, value double, ok boolean')
    got = [r[0] for r in df.orderBy("id").select(P.pretty_json(df)).collect()]
    want = [json.dumps({"id": i, 'n"é': n, "value": v, "ok": o}, indent=2) for i, n, v, o in rows]
    assert got == want


def test_capture_map_gives_a_result_or_an_error_for_nulls(spark):
    df = spark.createDataFrame([(1, 4), (2, None), (3, 0)], "pos long, x int")
    got = {r.pos: (r.result, r.error) for r in P.capture_map(df, lambda x: 8 / x, ["x"]).collect()}
    assert got[1] == (2.0, None) and got[2][0] is None and got[2][1].startswith("TypeError") and got[3][1].startswith("ZeroDivisionError")
    assert all((r is None) != (e is None) for r, e in got.values())
