"""Chat windows against a plain loop; every text comes back; both ways of dealing rows agree."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from threadloom.llm import chat_windows as cw

SCHEMA = "conv_id bigint, turn bigint, role string, text string, piece string, name int, `a.b` string"
BUDGET, HISTORY = 64, 16


def tokens(text):
    return -(-len(text.encode()) // 4) + 4


def plain_windows(turns):
    """[(new turns, repeated turns)] as numbers of turns."""
    cost = [tokens(x) for _, x in turns]
    start = [sum(cost[:k]) for k in range(len(turns))]
    system = bool(turns) and turns[0][0] == "system"
    capacity = max(BUDGET - HISTORY - (cost[0] if system else 0), BUDGET // 4)
    windows, last = [], None
    for k in range(len(turns)):
        name = (start[k] // (capacity - capacity // 4), cost[k] > capacity // 4, k if cost[k] > capacity // 4 else None)
        name = (*name, sum(c > capacity // 4 for c in cost[:k]))
        if name != last:
            windows.append(([], [u for u in range(k) if (start[u] >= start[k] - HISTORY) or (system and u == 0)]))
            last = name
        windows[-1][0].append(k)
    return windows, capacity


def conversations():
    rng = random.Random(14)
    odd = ["", "<turn>", "</turn>\n", "<\\turn>user\n", "\\", "<\\\\/turn>", "<", "</tur", "a\n\nb", "é" * 30, "😀</turn>", cw.TRICKY, "$1 \\$1"]
    roles = ["user", "assistant", "system", "to ol\n<turn>%", ""]
    talks = {k: [(rng.choice(roles), rng.choice(odd) + "w" * rng.randint(0, 40)) for _ in range(rng.randint(1, 30))] for k in range(40)}
    for k in range(0, 40, 3):
        talks[k][0] = ("system", "be kind " * rng.randint(0, 12))
    talks[50] = [("assistant", "x" * 300_000), ("user", "")]
    talks[51] = [("system", "s" * 5000), *[("user", "q"), ("assistant", "a")] * 20]
    talks[None] = [("user", "null id"), ("assistant", "yes")]
    return talks


def frame(spark, talks):
    rows = [(c, t, r, x, "p", 1, "d") for c, turns in talks.items() for t, (r, x) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("long_bytes, chunk_slots", [(1 << 30, 8), (200, 2), (-1, 1)])
def test_windows(spark, long_bytes, chunk_slots):
    talks = conversations()
    windows = cw.format_windows(frame(spark, talks), BUDGET, HISTORY, long_bytes=long_bytes, chunk_slots=chunk_slots)
    read = cw.read_targets(cw.read_turns(windows)).collect()
    found: dict = {}
    for r in sorted(read, key=lambda r: r["first_turn"]):
        found.setdefault(r["conv_id"], []).append(r)
    assert set(found) == set(talks)
    for c, turns in talks.items():
        wanted, capacity = plain_windows(turns)
        assert len(found[c]) == len(wanted)
        for r, (new, old) in zip(found[c], wanted):
            assert r["first_turn"] == new[0] + 1 and r["n_repeated"] == len(old)
            assert [tuple(t) for t in r["turns"]] == [turns[k] for k in old + new]
            assert r["targets"] == [turns[k][1] for k in new if turns[k][0] == "assistant"]
            assert r["tokens"] == sum(tokens(turns[k][1]) for k in old + new)
            assert len(new) == 1 or sum(tokens(turns[k][1]) for k in new) <= capacity
            assert r["text"].count("<turn>") == len(old + new) == r["text"].count("</turn>")


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, "user", None), (1, None, None, "first"), (1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, "user", "a"), (1, 3, "assistant", "z")]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    (window,) = cw.read_turns(cw.format_windows(given)).collect()
    assert [tuple(t) for t in window["turns"]] == [("", "first"), ("user", ""), ("assistant", "z"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert cw.format_windows(given.where("false")).count() == 0
    assert cw.digests(cw.format_windows(given.where("false"))).count() == 0


def test_digests_and_plan(spark):
    talks = conversations()
    windows = cw.format_windows(frame(spark, talks), BUDGET, HISTORY)
    done = cw.digests(windows)
    for r in done.collect():
        turns = talks[r["conv_id"]]
        lost = "".join(x for role, x in turns if role == "assistant")
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(lost))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(lost.encode()).hexdigest()
    plan = done._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_escapes(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(["<", "\\", "/", "turn", ">", "\n", "$1", "x"], k=rng.randint(0, 14))) for _ in range(2000)]
    given = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = given.select("t", cw.escaped(F.col("t")).alias("e"), cw.unescaped(cw.escaped(F.col("t"))).alias("u")).collect()
    assert all(r["t"] == r["u"] and "<turn" not in r["e"] and "</turn" not in r["e"] for r in rows)
