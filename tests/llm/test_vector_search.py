"""Both vector searches against brute force."""

import math

import numpy as np
import pytest

from tallyframe.llm import ann, exact_topk, vectors

SCHEMA = "vec_id long, embedding array<double>, id int, vector string, block int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(parts)


def clean(rows, zero):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]
    sizes = [len(v) for _, v in ok]
    d = min(set(sizes), key=lambda s: (-sizes.count(s), s)) if ok else 0
    best = {}
    for i, v in ok:
        if len(v) == d:
            best[i] = min(best.get(i, v), v)
    return best


def brute(rows, k, every, zero, score):
    table = clean(rows, zero)
    out = []
    for q in table:
        if q % every == 0:
            near = sorted((-score(table[q], table[c]), c) for c in table if c != q)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(near)]
    return sorted(out)


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def product(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))


def odd_rows(seed, n=900, d=12):
    rnd = np.random.default_rng(seed)
    rows = [(i, list(map(float, rnd.standard_normal(d)))) for i in range(n)]
    rows += [(2000 + i, rows[5][1]) for i in range(300)]  # a hot vector
    rows += [(3000 + i, rows[i][1]) for i in range(0, 60)] + rows[10:20]
    rows += [(5000, None), (5050, []), (5100, [0.0] * d), (5150, [float("nan")] * d), (5200, [float("inf")] * d), (5250, [None] * d), (5300, [1.0] * (d + 1)), (None, [1.0] * d)]
    return rows


def test_exact_search_equals_brute_force(spark):
    rows = odd_rows(1) + [(6000, [-0.001] * 12), (6050, [300.0] * 12)]
    got = sorted(map(tuple, exact_topk.top_products(frame(spark, rows)).collect()))
    assert got == brute(rows, 5, 50, True, product)


def test_exact_search_of_large_whole_numbers(spark):
    rows = [(i, [float(10 ** 6 + i), float(-i * 10 ** 5)]) for i in range(120)]
    got = sorted(map(tuple, exact_topk.top_products(frame(spark, rows), 3, 10).collect()))
    assert got == brute(rows, 3, 10, True, product)


def test_bounds_hold():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        x, q, p = rnd.integers(-300, 300, (40, 6)).astype("f8"), rnd.integers(-300, 300, (9, 6)).astype("f8"), rnd.integers(-300, 300, 6).astype("f8")
        r = np.sqrt(((x - p) ** 2).sum(1))
        bound = exact_topk.upper_bounds(q, p, r.min(), r.max(), np.sqrt((x * x).sum(1).max()))
        assert (bound[:, None] >= q @ x.T).all()


def test_approximate_search_recall_and_exact_scores(spark):
    rows = odd_rows(3, 2500, 24)
    want = brute(rows, 5, 50, False, cosine)
    got = sorted(map(tuple, ann.nearest(frame(spark, rows)).collect()))
    table = clean(rows, False)
    assert [(q, r) for q, r, _, _ in got] == [(q, r) for q, r, _, _ in want]
    assert all(math.isclose(s, cosine(table[q], table[c]), abs_tol=1e-12) and q != c for q, _, c, s in got)
    for q in {g[0] for g in got}:
        own = [(-s, c) for g, _, c, s in got if g == q]
        assert own == sorted(own)
    found = {(q, c) for q, _, c, _ in got}
    assert sum((q, c) in found for q, _, c, _ in want) >= 0.9 * len(want)


def test_full_radius_is_exact(spark, monkeypatch):
    rows = odd_rows(4, 300)
    monkeypatch.setattr(ann, "learn_radius", lambda *a: 0)  # next to nothing within it: the second search answers
    got = sorted(map(tuple, ann.nearest(frame(spark, rows)).collect()))
    want = brute(rows, 5, 50, False, cosine)
    # hot copies fill the first search of their own; all other answers are exact
    assert [(q, r) for q, r, *_ in got] == [(q, r) for q, r, *_ in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_codes_within_a_radius_are_all_found():
    rnd = np.random.default_rng(5)
    code = rnd.integers(0, 256, (500, 6)).astype("u1")
    query = np.concatenate([code[:10] ^ rnd.integers(0, 4, (10, 6)).astype("u1"), code[:3]])
    index = ann.CodeIndex(code)
    bits = np.unpackbits(query[:, None] ^ code[None], axis=2).sum(2)
    for radius in (0, 1, 3, 5, 6, 11, 20, 48):
        assert (index.within(query, radius) == (bits <= radius)).all()


@pytest.mark.parametrize("rows", [[], [(50, None)], [(50, [1.0, 2.0])], [(50, [1.0, 2.0]), (7, [2.0, 1.0])], [(3, [1.0]), (4, [2.0])]])
def test_small_tables(spark, rows):
    assert sorted(map(tuple, exact_topk.top_products(frame(spark, rows, 1)).collect())) == brute(rows, 5, 50, True, product)
    got, want = sorted(map(tuple, ann.nearest(frame(spark, rows, 1)).collect())), brute(rows, 5, 50, False, cosine)
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want])


def test_extreme_lengths(spark):
    rows = [(i, [1e-200 * (i + 1), 1e-200]) for i in range(5)] + [(50 + i, [1e200, 1e200 * i]) for i in range(3)]
    got, want = sorted(map(tuple, ann.nearest(frame(spark, rows)).collect())), brute(rows, 5, 50, False, cosine)
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_only_pairs_within_the_radius_are_multiplied(monkeypatch):
    rnd = np.random.default_rng(6)
    x = rnd.standard_normal((400, 16))
    rotations = ann.learn_rotations(ann.unit(x))
    code, seen = ann.codes(ann.unit(x), rotations), []
    rows, ids = ann.bucket_rows(code), np.arange(400)
    plain = ann.products
    monkeypatch.setattr(ann, "products", lambda q, x, i, j: seen.append(len(i)) or plain(q, x, i, j))
    monkeypatch.setattr(ann, "bucket_rows", None)  # the stored order is used
    monkeypatch.setattr(ann, "PAIRS", 7)
    query, near, score = ann._search(rotations, 50, 5, 16)(ids[:20].tobytes(), x[:20].tobytes(), ids.tobytes(), x.tobytes(), code.tobytes(), rows.tobytes())
    apart = np.unpackbits(code[:20, None] ^ code[None], axis=2).sum(2)
    within = (apart <= 50) & ~np.eye(20, 400, dtype=bool)
    assert seen == [within.sum()] and 0 < seen[0] < 20 * 400 / 2
    cosines = np.where(within, ann.unit(x[:20]) @ ann.unit(x).T, -2)
    for q in range(20):
        want = [c for c in np.argsort(-cosines[q])[:5] if within[q, c]]
        assert near[query == q].tolist() == want and np.allclose(score[query == q], cosines[q, want])


@pytest.mark.parametrize("module", [ann, exact_topk])
def test_pairs_are_neither_shuffled_nor_broadcast(spark, monkeypatch, module):
    rows, seen, plain = odd_rows(7), [], module.searched
    monkeypatch.setattr(module, "searched", lambda pairs, *a: seen.append(pairs) or plain(pairs, *a))
    (ann.nearest if module is ann else exact_topk.top_products)(frame(spark, rows)).collect()
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Broadcast", "Exchange", "Generate", "Explode"))


@pytest.mark.parametrize("parts", [1, 4])
def test_many_parts_and_blocks_give_the_same(spark, monkeypatch, parts):
    monkeypatch.setattr(vectors, "INDEX_PARTS", 3)
    monkeypatch.setattr(vectors, "PART_VALUES", 12 * 5)
    for module in (ann, exact_topk):
        monkeypatch.setattr(module, "INDEX_VALUES", 12 * 50)
        monkeypatch.setattr(module, "QUERY_VALUES", 12 * 4)
    rows = odd_rows(8) + [(6000, [-0.001] * 12), (6050, [300.0] * 12)]
    assert sorted(map(tuple, exact_topk.top_products(frame(spark, rows, parts)).collect())) == brute(rows, 5, 50, True, product)
    monkeypatch.setattr(ann, "learn_radius", lambda *a: ann.BITS)  # everything is within it
    got, want = sorted(map(tuple, ann.nearest(frame(spark, rows, parts)).collect())), brute(rows, 5, 50, False, cosine)
    assert [(q, r) for q, r, *_ in got] == [(q, r) for q, r, *_ in want] and np.allclose([g[3] for g in got], [w[3] for w in want])


def test_a_task_is_told_a_block_once(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART_VALUES", 12 * 9)
    monkeypatch.setattr(ann, "INDEX_VALUES", 12 * 20)
    monkeypatch.setattr(ann, "QUERY_VALUES", 12 * 2)
    rows, seen, plain = [(i, v) for i, v in odd_rows(12) if v and len(v) == 12], [], ann.searched
    monkeypatch.setattr(ann, "searched", lambda pairs, *a: seen.append(pairs) or plain(pairs, *a))
    ann.nearest(frame(spark, rows)).collect()
    pairs = seen[0].collect()
    blocks, asked = {p.ids for p in pairs}, {p.qid for p in pairs}
    assert len(pairs) == len(blocks) * len(asked) and len(blocks) > 20 and len(asked) > 5
    told, qtold = [p.ids for p in pairs if p.vector], [p.qid for p in pairs if p.qvector]
    assert all((p.vector is None) == (p.code is None) == (p.rows is None) for p in pairs)
    assert set(told) == blocks and set(qtold) == asked and len(told) < len(pairs) / 2
    with pytest.raises(RuntimeError):
        ann._search(np.zeros((12, 128)), 5, 5, 12)(pairs[0].qid, None, pairs[0].ids, None, None, None)


def test_products_of_pairs_are_the_same_however_they_are_taken():
    rnd = np.random.default_rng(13)
    q, x = rnd.standard_normal((20, 8)), rnd.standard_normal((90, 8))
    for share in (0.0, 0.05, 0.4, 0.9, 1.0):  # chunks, query by query, all at once
        i, j = np.nonzero(rnd.random((20, 90)) < share)
        assert np.allclose(ann.products(q, x, i, j), (q @ x.T)[i, j])


def test_annuli_out_of_reach_do_not_meet_the_queries(spark, monkeypatch):
    rnd = np.random.default_rng(9)
    centres = rnd.standard_normal((12, 8))
    centres /= np.sqrt((centres ** 2).sum(1, keepdims=True))
    rows = [(i, list(map(float, centres[i % 12] + 0.01 * rnd.standard_normal(8)))) for i in range(3000)]
    seen, plain = [], exact_topk.searched
    monkeypatch.setattr(exact_topk, "searched", lambda pairs, *a: seen.append(pairs) or plain(pairs, *a))
    got = sorted(map(tuple, exact_topk.top_products(frame(spark, rows)).collect()))
    assert got == brute(rows, 5, 50, True, product)
    sides = {c: seen[0].select(c).distinct().count() for c in ("qid", "ids")}
    assert seen[0].count() < sides["qid"] * sides["ids"] / 2


def test_floats_stay_floats_and_give_the_same(spark, monkeypatch):
    rnd = np.random.default_rng(10)
    rows = [(i, list(map(float, rnd.standard_normal(12).astype("f4")))) for i in range(600)]
    double = frame(spark, rows)
    single, seen, plain = double.withColumn("embedding", double.embedding.cast("array<float>")), [], ann.searched
    monkeypatch.setattr(ann, "searched", lambda pairs, *a: seen.append(pairs) or plain(pairs, *a))
    assert sorted(map(tuple, ann.nearest(single).collect())) == sorted(map(tuple, ann.nearest(double).collect()))
    assert [len(s.first().vector) / len(s.first().ids) for s in seen] == [6, 12]
    assert sorted(map(tuple, exact_topk.top_products(single).collect())) == sorted(map(tuple, exact_topk.top_products(double).collect()))


def test_the_sample_is_the_lowest_hashes_however_it_is_found(spark):
    some = spark.range(3000).selectExpr("id", "array(cast(id as double), 1.0) vector")
    all_ids, _ = vectors.sample_of(some, 0, 60)
    for count in (3000, 10 ** 6):  # of too few low hashes all rows are sorted
        ids, x = vectors.sample_of(some, count, 60)
        assert ids.tolist() == all_ids.tolist() and x[:, 0].tolist() == all_ids.tolist() and len(ids) == 60


def test_what_queries_have_rises():
    reached = vectors.Reached(np.array([7, 3, 5]), 2, np.array([-np.inf, 1.0, 4.0]))
    reached.add(np.array([3, 3, 7]), np.array([9.0, 2.0, 6.0]))
    assert reached.least.tolist() == [-np.inf, 2.0, 4.0]
    reached.add(np.array([3, 5, 5, 7]), np.array([3.0, 2.0, 1.0, 5.0]))
    assert reached.least.tolist() == [5.0, 3.0, 4.0]


def test_products_of_whole_numbers_are_exact_at_every_size():
    rnd = np.random.default_rng(11)
    for most, kind in ((200, "i2"), (4000, "f4"), (2 ** 25, "f8"), (2 ** 40, "f8")):
        q, x = (rnd.integers(-most, most, (n, 64)).astype(kind) for n in (5, 9))
        want = [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in x] for u in q]
        assert [list(map(int, row)) for row in exact_topk.products(q, x)] == want
        least = np.array([sorted(row)[4] for row in want], "f8")
        places = exact_topk.at_least(exact_topk.products(q, x), exact_topk.below(least))
        assert places.tolist() == [i * 9 + j for i in range(5) for j in range(9) if want[i][j] >= least[i]]
