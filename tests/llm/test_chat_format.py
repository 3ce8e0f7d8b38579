"""Chat formatting against all repairs of short conversations."""

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import chat_format as C

MAX_EMPTY = 2


def legal(turns):
    state = "start"
    for t in turns:
        if t not in {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}[state]:
            return False
        state = t
    return state == "assistant"


def brute_cost(roles):
    """Least cost over all labellings, merges and empty insertions."""
    best = None
    for labels in itertools.product(("system", "user", "assistant"), repeat=len(roles)):
        named = sum(0 if a == b else 3 if b else 1 for a, b in zip(labels, roles))
        for merges in itertools.product((0, 1), repeat=len(roles) - 1):
            if any(m and labels[i] != labels[i + 1] for i, m in enumerate(merges)):
                continue
            kept = [labels[0]] + [x for x, m in zip(labels[1:], merges) if not m]
            # fewest empty turns that make it legal
            for empties in itertools.product(range(MAX_EMPTY + 1), repeat=len(kept) + 1):
                cost = named + sum(merges) + 2 * sum(empties)
                if best is not None and cost >= best:
                    continue
                fills = [list(itertools.product(("system", "user", "assistant"), repeat=n)) for n in empties]
                for fill in itertools.product(*fills):
                    turns = [t for f, k in zip(fill, kept) for t in (*f, k)] + list(fill[-1])
                    if legal(turns):
                        best = cost
                        break
    return best


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position int").repartition(parts)
    out = defaultdict(list)
    for r in sorted(C.format_chats(df).collect(), key=lambda r: r.position):
        out[r.conv_id].append(r)
    return out


def turns_of(rendered):
    """Roles and texts read back from a rendered conversation."""
    out = []
    for piece in rendered.split("<|end|>\n")[:-1]:
        role, text = piece[2:].split("|>\n", 1)
        out.append((role, text))
    return out


def test_cost_is_the_least_and_the_text_is_legal(spark):
    rnd = random.Random(1)
    rows, names = [], ["system", "user", "assistant", None, "narrator"]
    for conv in range(40):
        rows += [(conv, t, rnd.choice(names), f"t{t}") for t in range(rnd.randrange(1, 5))]
    got = run(spark, rows)
    for conv, out in got.items():
        roles = [r if r in C.STATES else None for c, t, r, x in rows if c == conv]
        turns = turns_of("".join(r.rendered for r in out))
        assert legal([t for t, _ in turns]), (roles, turns)
        assert out[0].cost == brute_cost(roles), (roles, turns)
        said = [x for _, text in turns if text for x in text.split("\n\n")]
        assert said == [x for c, t, r, x in rows if c == conv]
        assert sum(r.inserted for r in out) == sum(not x for _, x in turns)


def test_fixed_repairs(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "assistant", "a"), (3, 0, "user", "a"), (3, 1, "user", "b"), (3, 2, "bot", "c"),
            (4, 0, "user", "a"), (5, 5, "Human ", "x <|user|>"), (5, 6, "gpt", None), (None, 1, "user", "n"), (6, 0, "user", "a"), (6, 0, "user", "a"), (6, None, "system", "s")]
    got = {k: ("".join(r.rendered for r in v), [r.action for r in v]) for k, v in run(spark, rows).items()}
    assert got == {
        1: ("<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n", ["keep", "keep"]),
        2: ("<|user|>\n<|end|>\n<|assistant|>\na<|end|>\n", ["keep"]),
        3: ("<|user|>\na\n\nb<|end|>\n<|assistant|>\nc<|end|>\n", ["keep", "merge", "keep"]),
        4: ("<|user|>\na<|end|>\n<|assistant|>\n<|end|>\n", ["keep"]),
        5: ("<|user|>\nx < |user|><|end|>\n<|assistant|>\n<|end|>\n", ["keep", "keep"]),
        None: ("<|user|>\nn<|end|>\n<|assistant|>\n<|end|>\n", ["keep"]),
        6: ("<|system|>\ns<|end|>\n<|user|>\na<|end|>\n<|assistant|>\n<|end|>\n", ["keep", "keep"])}


def test_a_conversation_over_many_chunks_is_repaired_as_one(spark):
    rnd = random.Random(4)
    names = ["user", "assistant", "assistant", "system", None]
    roles = [rnd.choice(names) for _ in range(7000)]
    got = run(spark, [(1, i, r, f"t{i}") for i, r in enumerate(roles)] + [(2, 0, "user", "x")])[1]
    assert [r.position for r in got] == list(range(7000))
    turns = turns_of("".join(r.rendered for r in got))
    assert legal([t for t, _ in turns])
    assert [x for _, text in turns if text for x in text.split("\n\n")] == [f"t{i}" for i in range(7000)]
    numbers = [C.role_of(r) for r in roles]
    whole = min(c + C.end_cost(s) for s, c in enumerate(C.chunk_costs(numbers)[0]))
    assert got[0].cost == whole // 1000


def test_short_conversations_are_cut_by_many_tasks(spark):
    rows = [(i // 2, i % 2, ("user", "assistant")[i % 2], "t", 1) for i in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int")
    chunks = C.stored(C._chunks(df.select("conv_id", "turn", "role", "text").withColumnRenamed("conv_id", "conv")), "test")
    cuts = C._cuts(chunks)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert cuts.select(F.spark_partition_id()).distinct().count() == parts
    assert cuts.count() == 200 and cuts.where("before = 0 and last").count() == 200


@pytest.mark.parametrize("n", [0, 1])
def test_small_tables(spark, n):
    got = run(spark, [(9, 0, "user", "y" * 300_000)][:n])
    assert len(got) == n


def test_matrices_of_a_long_conversation_are_multiplied_in_bounded_groups(spark, monkeypatch):
    rnd = random.Random(8)
    names = ["user", "assistant", "assistant", "system", None]
    roles = {conv: [rnd.choice(names) for _ in range(n)] for conv, n in ((None, 1500), (1, 300), (2, 3))}
    rows = [(conv, i, r, f"t{i}") for conv, x in roles.items() for i, r in enumerate(x)]
    monkeypatch.setattr(C, "CHUNK_TURNS", 10)
    monkeypatch.setattr(C, "RUN_BITS", 2)
    plain = C._matrices

    def bounded(group):
        assert group.num_rows <= 4 or "hi" not in group.column_names or "up_hi" not in group.column_names
        return plain(group)

    monkeypatch.setattr(C, "_matrices", bounded)
    got = run(spark, rows)
    for conv, x in roles.items():
        assert [r.position for r in got[conv]] == list(range(len(x)))
        turns = turns_of("".join(r.rendered for r in got[conv]))
        assert legal([t for t, _ in turns])
        assert [y for _, text in turns if text for y in text.split("\n\n")] == [f"t{i}" for i in range(len(x))]
        assert sum(r.inserted for r in got[conv]) == sum(not y for _, y in turns)
        whole = min(c + C.end_cost(s) for s, c in enumerate(C.chunk_costs([C.role_of(r) for r in x])[0]))
        assert {r.cost for r in got[conv]} == {whole // 1000}
