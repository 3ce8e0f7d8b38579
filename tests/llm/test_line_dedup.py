"""Line dedup against a search of all earlier runs."""

import random

import pytest

from tallyframe.llm import line_dedup as L


def brute(rows, least):
    """rows: (id, text), ids distinct or whole rows repeated."""
    docs = {}
    for i, t in rows:
        if t is not None:
            lines = [(p, x.strip(" \t\r")) for p, x in enumerate(t.split("\n")) if x.strip(" \t\r")]
            ends = [p for p, _ in lines[1:]] + [len(t.split("\n"))]
            docs[(i is None, i)] = [(p, x, e) for (p, x), e in zip(lines, ends)]
    earlier, out = set(), {}
    for key in sorted(docs, key=lambda k: (k[0], k[1] or 0)):
        lines, gone = docs[key], set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(x for _, x, _ in lines[a:b + 1])
                if sum(len(x.split(" ")) for x in run) >= least:
                    if run in earlier:
                        gone |= set(range(lines[a][0], lines[b][2]))
            for b in range(a, len(lines)):
                earlier.add(tuple(x for _, x, _ in lines[a:b + 1]))
        out[key] = gone
    result = []
    for i, t in rows:
        if t is None:
            result.append((i, None, 0))
        else:
            gone = out[(i is None, i)]
            result.append((i, "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone), len(gone)))
    return result


def run(spark, rows, least, parts=3):
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, place int, gone int, lines_removed string").repartition(parts)
    out = L.dedup_lines(df, least)
    assert out.columns == ["doc_id", "text", "place", "gone", "lines_removed"]
    return [(r.doc_id, r.text, r.lines_removed) for r in out.collect()]


@pytest.mark.parametrize("seed,least", [(1, 4), (2, 6), (3, 1), (4, 9)])
def test_equals_a_search_of_all_runs(spark, seed, least):
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choices("abcdefg", k=rnd.choice([1, 1, 2, 3, 5]))) for _ in range(9)] + ["", "  ", "x y \t", " x y"]
    rows = [(i, "\n".join(rnd.choices(pool, k=rnd.randrange(1, 14)))) for i in range(60)]
    rows += [(900 + i, t) for i, (_, t) in enumerate(rows[:15])] + [(700, None), (701, ""), (702, "\n\n"), (None, rows[3][1])]
    rows += rows[10:14]
    assert sorted(map(str, run(spark, rows, least))) == sorted(map(str, brute(rows, least)))


def test_long_passage_goes_and_short_common_lines_stay(spark):
    passage = " ".join(f"w{i}" for i in range(51))
    rows = [(i, f"own line {i}\n{passage}\nAll rights reserved.") for i in range(40)]
    got = {i: t for i, t, _ in run(spark, rows, L.MIN_WORDS)}
    assert got[0] == rows[0][1]
    # "All rights reserved." closes a repeated run together with the passage
    assert all(got[i] == f"own line {i}" for i in range(1, 40))
    alone = [(i, f"own line {i} {'z ' * 60}{i}\nAll rights reserved.") for i in range(5)]
    assert sorted(run(spark, alone, L.MIN_WORDS)) == [(i, t, 0) for i, t in alone]


def test_very_long_text_of_short_lines(spark):
    text = "\n".join(f"l{i % 700}" for i in range(20_000))
    (one, two) = sorted(run(spark, [(1, text), (2, text)], 50))
    assert two[1] == "" and two[2] == 20_000
    assert one[1] == "\n".join(f"l{i}" for i in range(700))


def test_empty_table(spark):
    assert run(spark, [], 5) == []
