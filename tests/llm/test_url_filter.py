"""URL filter against the rules applied one by one."""

import random

import pytest

from tallyframe.llm import url_filter as U
from tallyframe.llm.queries import URL_RULES


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(r), len(h), r) for r in rules for h, p in [(r[:r.index("/")], r[r.index("/"):])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits)[2] if fits else None
    return host, path, rule, rules[rule] if rule else "allow"


URLS = [None, "", "no scheme", "http://", "http:///x/en/", "http://net", "http://net/", "HTTP://A.Example.NET/en/1?x#y", "http://x.net?/en/", "http://x.org#/fr/",
        "http://myexample.com/de/", "http://example.com/de", "http://example.com/de/", "x://a://b.net/", "http://é.NET/É", "http://a.b\nc.net/en/\n?",
        "http://u@h.example.net:80/en/", "http://" + "a." * 3000 + "net/" + "p/" * 3000, "http://.net/", "http://fr.org/fr/"]


def test_equals_the_rules_one_by_one(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS + URLS)] + [(None, URLS[7], "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = sorted(map(str, map(tuple, U.filter_urls(df, URL_RULES).collect())))
    assert got == sorted(str((i, *brute(u, URL_RULES))) for i, u, *_ in rows)


def test_many_rules_are_exact_over_the_corpus(spark):
    rnd = random.Random(2)
    names = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rules = {f"{'.'.join(rnd.choices(names, k=rnd.randrange(1, 3)))}/{'/'.join(rnd.choices('xyz', k=rnd.randrange(3)))}": rnd.choice(["block", "allow"]) for _ in range(400)}
    urls = [f"http://{'.'.join(rnd.choices(names, k=rnd.randrange(1, 4)))}/{'/'.join(rnd.choices('xyz', k=rnd.randrange(4)))}" for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: tuple(r)[1:] for r in U.filter_urls(df, rules).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


@pytest.mark.parametrize("rules", [{}, URL_RULES])
def test_empty_table_or_rules(spark, rules):
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    one = U.filter_urls(spark.createDataFrame([(1, "http://q.com/")], "page_id long, url string"), rules).first()
    assert tuple(one) == (1, "q.com", "/", None, "allow")


def test_cascade_alternates(spark):
    listed = {f"k{i}" for i in range(300)}
    universe = [f"k{i}" for i in range(20_000)]
    cascade = U.Cascade.over(listed, spark.createDataFrame([(k,) for k in universe], "key string"), len(universe), 5)
    assert len(cascade.levels) > 1
    assert {k for k in universe if k in cascade} == listed
