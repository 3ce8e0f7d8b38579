"""Array files cut by the structural scan against the same files parsed whole."""

import json
import os
import random
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.sources import json_array as A


def write(tmp, text, name="a.json"):
    path = os.path.join(tmp, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


@pytest.fixture()
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    for k, v in zip(kept, ("97", "1", "3")):
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


NASTY = ["plain", "a, b", "}{][", 'q"u"o', "back\\", '\\"', "}\\", "\\\\", '",{"', "line\nbreak", "é✓ 😀", "", "]", "[", "x" * 300]


def some_values(seed):
    rnd = random.Random(seed)

    def value(deep):
        kind = rnd.randrange(6 if deep else 4)
        if kind < 2:
            return rnd.choice(NASTY)
        if kind == 2:
            return rnd.choice([1, -2.5, True, False, None])
        if kind == 3:
            return {rnd.choice(NASTY[:8]): rnd.choice(NASTY)}
        return [value(False) for _ in range(rnd.randrange(3))] if kind == 4 else {k: value(False) for k in rnd.sample(NASTY[:9], rnd.randrange(3))}
    return [value(True) for _ in range(rnd.randrange(1, 60))]


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_file_parsed_whole(spark, tmp, small_splits, seed):
    values = some_values(seed)
    layout = [{}, {"indent": 4}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": 1}][seed]
    path = write(tmp, random.Random(seed).choice(["", " \n"]) + json.dumps(values, **layout) + random.Random(seed + 1).choice(["", "\n", " \r\n "]))
    got = A.read_array(spark, path).select("pos", F.to_json("v").alias("v")).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(len(values)))
    assert [json.loads(r.v) for r in got] == values


def test_many_tasks_share_a_file(spark, tmp):
    rows = [{"id": i, "text": NASTY[i % len(NASTY)] * 3} for i in range(20000)]
    path = write(tmp, json.dumps(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert A._chunks(spark, path).rdd.getNumPartitions() > 8
        got = A.read_array(spark, path)
        assert got.count() == 20000
        found = got.select("pos", F.variant_get("v", "$.id", "long").alias("id"), F.variant_get("v", "$.text", "string").alias("text"))
        assert all(r.id == r.pos and r.text == rows[r.pos]["text"] for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_arrays(spark, tmp):
    for text in ("[]", " [ \n ] \n", "[\n]"):
        assert A.read_array(spark, write(tmp, text)).count() == 0


GOOD = '{"a": 1}'
BROKEN = ["", "  \n ", "[1,\n", "[1\n,\n]", "[1,\n\n,2]", f"[{GOOD}\n {GOOD}]", f"[{GOOD},\n{{\"b\": }}, 3]", f"[{GOOD}] x", f"[{GOOD}\n}}", f"[{GOOD}]\n [1]",
          f'[{GOOD},\n"ab\n', "{not json at all", f"[{GOOD},\n\n\n{{\"b\": [1, 2}}]]", '[1,\n"a" 2]', f'[{GOOD},\n{{"k": "v}}"\n']


@pytest.mark.parametrize("text", BROKEN)
def test_broken_files_name_the_line(spark, tmp, small_splits, text):
    with pytest.raises(json.JSONDecodeError) as want:
        json.loads(text)
    with pytest.raises(A.ArraySyntaxError) as got:
        A.read_array(spark, write(tmp, text))
    assert got.value.line == want.value.lineno


@pytest.mark.parametrize("text,kind", [('{"a": [1]}', "dict"), (" null", "NoneType")])
def test_other_values(spark, tmp, text, kind):
    with pytest.raises(A.NotAnArray) as e:
        A.read_array(spark, write(tmp, text))
    assert e.value.kind == kind


def test_no_python_step_for_each_element():
    """A batch is measured and cut by as many calls, whatever number of elements it holds."""
    def steps(fn, n, keys):
        chunks = [b'[{"a": "x, y"'] + [b',\n{"a": "x, y"'] * (n - 1)
        columns = [pa.array([k] * n) for k in keys.values()] + [pa.array(chunks, pa.binary())]
        batch = pa.RecordBatch.from_arrays(columns, names=[*keys, "value"])
        calls = 0

        def count(frame, event, arg):
            nonlocal calls
            calls += event in ("call", "c_call")
        sys.setprofile(count)
        try:
            found = list(fn([batch]))
        finally:
            sys.setprofile(None)
        return calls, sum(len(b) for b in found)

    place = {"file": "f", "block": 0}
    start = {"in_string": False, "depth": 0, "line": 1, "begun": False, "bare": False}
    for fn, keys, rows in ((A._measure, place | {"size": 9}, 1), (A._cut, place | start, 4000)):
        steps(fn, 40, keys)
        few, many = steps(fn, 40, keys), steps(fn, 4000, keys)
        assert many[1] == rows and many[0] < few[0] + 100


def test_bytes_that_are_no_text(spark, tmp, small_splits):
    path = os.path.join(tmp, "a.json")
    with open(path, "wb") as f:
        f.write(b'["\xc3","\xa9", {"a": "\xc3\xa9"},"\xff, }", {"b": "\xed\xa0\x80"}, 1, 2, {}, {"a": "}"}]')
    with open(path, encoding="utf-8", errors="replace") as f:
        want = json.load(f)
    got = A.read_array(spark, path).select("pos", F.to_json("v").alias("v")).orderBy("pos").collect()
    assert [json.loads(r.v) for r in got] == want


def test_elements_are_written_once(spark, tmp):
    """Texts go from the cut to one table, not through a shuffle into a second one."""
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    rows = [{"text": random.Random(i).randbytes(30).hex()} for i in range(5000)]
    assert A.read_array(spark, write(tmp, json.dumps(rows))).count() == 5000
    made = [os.path.join(shared, f) for f in set(os.listdir(shared)) - before]
    sizes = [os.path.getsize(os.path.join(d, f)) for m in made for d, _, files in os.walk(m) for f in files if f.endswith(".parquet")]
    assert 300_000 < sum(sizes) < 600_000
