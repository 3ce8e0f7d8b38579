"""Log family: parsing, filter, counts, pages, scan depth, sources, generator."""

import os


from tallyframe.operators import logs
from tallyframe.sources.logs import LEVELS, MESSAGES, fake_log_lines, generate_log_lines, read_log_text, write_lines

LINES = [
    "2026-06-11 10:01:01 ERROR payment processed",
    "2026-06-11 10:02:02 ERROR db connection slow",
    "2026-06-11 10:03:03 INFO user logged in",
    "",
    "2026-06-11 10:04:04 WARNING",
    "2026-06-11  10:05:05 DEBUG two  spaces",
    "2026-06-11 10:06:06 INFO cache miss",
    "2026-06-11 10:07:07 ERROR timeout contacting service",
]


def lines_df(spark, lines=LINES):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "pos long, value string")


def py_parse(line):
    parts = line.split(" ", 3)
    if len(parts) != 4:
        return None
    a, b, level, msg = parts
    return (f"{a} {b}", level, msg)


def test_parse_matches_python_split(spark):
    got = logs.parse_lines(lines_df(spark)).orderBy("pos").collect()
    for line, row in zip(LINES, got):
        exp = py_parse(line)
        assert row.malformed == (exp is None)
        if exp:
            assert (row.ts, row.level, row.msg) == exp


def test_only_is_case_sensitive(spark):
    df = logs.parse_lines(lines_df(spark, LINES + ["2026-06-11 10:08:08 error lower"]))
    assert logs.only(df, "ERROR").count() == 3


def test_level_counts_order_and_ties(spark):
    from collections import Counter
    got = logs.level_counts(logs.parse_lines(lines_df(spark))).orderBy("rank").collect()
    py = Counter(p[1] for p in map(py_parse, LINES) if p)
    assert [(r.level, r.n) for r in got] == py.most_common()
    assert [(r.level, r.n) for r in got] == [("ERROR", 3), ("INFO", 2), ("10:05:05", 1)]


def test_first_page_and_scan_depth(spark):
    parsed = logs.parse_lines(lines_df(spark))
    page = logs.first_page(parsed, "ERROR", 2).collect()
    assert [r.pos for r in page] == [0, 1]
    assert logs.scan_depth(parsed, "ERROR", 2).first().lines_read == 2
    assert logs.scan_depth(parsed, "ERROR", 3).first().lines_read == 8
    # fewer matches than a page: the reader consumes everything
    assert logs.scan_depth(parsed, "ERROR", 5).first().lines_read == 8
    assert logs.scan_depth(parsed, "ERROR", 5).first().matches_in_page == 3


def test_pages_of_level(spark):
    parsed = logs.parse_lines(lines_df(spark))
    got = logs.pages(parsed, "ERROR", 2, buckets=3).orderBy("pos").collect()
    assert [(r.pos, r.page_no, r.slot) for r in got] == [(0, 1, 1), (1, 1, 2), (7, 2, 1)]


def test_line_metrics_in_one_aggregate(spark):
    got = logs.line_metrics(logs.parse_lines(lines_df(spark))).first()
    assert got.lines_read == 8 and got.malformed == 2


def test_read_log_text_keeps_file_order_over_files_and_splits(spark, tmp):
    d = os.path.join(tmp, "logs")
    os.makedirs(d)
    expected = []
    for f in range(3):
        rows = [f"2026-06-11 10:00:{i % 60:02d} INFO file{f} line {i}" for i in range(3000)]
        with open(os.path.join(d, f"part-{f}.log"), "w") as fh:
            fh.write("\n".join(rows) + "\n")
        expected += rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_log_text(spark, d)
        assert df.rdd.getNumPartitions() > 3
        got = [r.value for r in df.orderBy("pos").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == expected


def test_generator_shape_and_partition_independence(spark, tmp):
    a = generate_log_lines(spark, 1200, partitions=1).orderBy("pos").collect()
    b = generate_log_lines(spark, 1200, partitions=7).orderBy("pos").collect()
    assert a == b
    for r in a[:120]:
        date, hms, level, msg = r.value.split(" ", 3)
        mm = f"{r.pos % 60:02d}"
        assert date == "2026-06-11" and hms == f"10:{mm}:{mm}"
        assert level in LEVELS and msg in MESSAGES
    counts = logs.level_counts(logs.parse_lines(fake_log_lines(spark.range(60000)))).collect()
    share = {r.level: r.n / 60000 for r in counts}
    assert abs(share["INFO"] - 0.5) < 0.02 and abs(share["ERROR"] - 1 / 6) < 0.02
    out = os.path.join(tmp, "gen")
    write_lines(generate_log_lines(spark, 100), out)
    assert read_log_text(spark, out).count() == 100
    write_lines(generate_log_lines(spark, 10), out)  # overwrite, not append
    assert read_log_text(spark, out).count() == 10


def test_first_page_over_several_files(spark, tmp):
    from tallyframe.sources.logs import first_page_of

    d = os.path.join(tmp, "many logs")
    os.makedirs(d)
    every = []
    for f in range(7):
        rows = [f"2026-06-11 10:00:{i % 60:02d} {'ERROR' if (f, i) in {(0, 3), (3, 0), (3, 49), (6, 20)} else 'INFO'} file {f} line {i}" for i in range(50)]
        with open(os.path.join(d, f"part {f}.log"), "w") as fh:
            fh.write("\n".join(rows) + "\n")
        every += rows
    at = [i for i, r in enumerate(every) if " ERROR " in r]
    for n in (0, 1, 2, 3, 4, 9):
        page = first_page_of(spark, d, "ERROR", n)
        got = page.rows.orderBy("pos").collect()
        assert [r.msg for r in got] == [every[i].split(" ", 3)[3] for i in at[:n]]
        assert page.lines_read == (0 if n == 0 else at[n - 1] + 1 if n <= len(at) else len(every)) and page.matches == len(got)
        assert [r.pos for r in got] == [r.pos for r in logs.first_page(logs.parse_lines(read_log_text(spark, d)), "ERROR", n).orderBy("pos").collect()]


def test_first_page_reads_under_one_percent(tmp):
    import glob
    import json
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from tallyframe.sources.logs import first_page_of, generate_log_lines, write_lines
conf = {{"spark.ui.enabled": "false", "spark.checkpoint.dir": {tmp + "/ckpt"!r}}}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
write_lines(generate_log_lines(spark, 100000, partitions=1), {tmp + "/log"!r})
spark.stop()
conf |= {{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {"file://" + tmp!r}, "spark.eventLog.compress": "false"}}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
page = first_page_of(spark, {tmp + "/log"!r}, "ERROR", 5)
assert page.rows.count() == 5
print("lines", page.lines_read)
spark.stop()
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr[-2000:]
    lines = int(said.stdout.split("lines ")[1])
    read = 0
    for log in [p for p in glob.glob(tmp + "/**/*", recursive=True) if os.path.isfile(p) and "local-" in os.path.basename(p) and not p.endswith(".crc")]:
        for line in open(log):
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                read += event["Task Metrics"]["Input Metrics"]["Records Read"]
    assert 0 < lines <= read < 1000
