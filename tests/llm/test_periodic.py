"""Periodic runs against comparing all words at all distances."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
from threadloom.llm import periodic

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(words, least=12):
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_kept(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences():
    rng = random.Random(3)
    yield []
    for t in range(240):
        n = rng.randint(1, 90)
        if t % 4 == 0:
            yield [rng.randrange(2) for _ in range(n)]
        elif t % 4 == 1:
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            yield b[:n] if t % 8 == 1 else [0] * n
        elif t % 4 == 2:
            c = []
            while len(c) < n:
                c += [rng.randrange(4) for _ in range(rng.randint(1, 12))] * rng.randint(1, 6)
            yield c
        else:
            c = [rng.randrange(9) for _ in range(rng.randint(1, 30))] * rng.randint(1, 8)
            c[rng.randrange(len(c))] = 99
            yield c


@pytest.mark.parametrize("online", [False, True])
def test_catcher(online):
    rng = random.Random(5)
    for codes in sequences():
        catcher = periodic.SquareCatcher()
        at = 0
        while at < len(codes):
            step = rng.choice([1, 1, 2, 7, 30]) if online else len(codes)
            catcher.append(np.array(codes[at : at + step], dtype=np.int64))
            at += step
        assert catcher.runs() == plain_runs(codes)


def test_equal_fingerprints_decide_nothing(monkeypatch):
    """With every fingerprint the same, words alone tell."""
    monkeypatch.setattr(periodic, "mix", lambda values: np.zeros_like(values))
    for codes in list(sequences())[:60]:
        catcher = periodic.SquareCatcher()
        catcher.append(np.array(codes, dtype=np.int64))
        assert catcher.runs() == plain_runs(codes)


def test_long_sequences(monkeypatch):
    """Chunks smaller than the period; documents of one batch never touch."""
    monkeypatch.setattr(periodic, "CHUNK_WORDS", 1000)
    block = [b"w%d" % k for k in range(3000)]
    got = periodic.runs_of_documents([block * 3 + [b"x"], [b"a"] * 5000, block, block, [], [b"a"] * 11])
    assert got == [[(0, 9000, 3000)], [(0, 5000, 1)], [], [], [], []]


def test_collapse_runs(spark):
    texts = [None, "", " \t\n", "a " * 20, "x y z " * 5 + "x y", "a b " * 3, "a b " * 6 + "c " + "a b " * 6, "é\n" * 12, "one two", "one two"]
    rows = [(k if k != 8 else None, t, "r", "c") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, `a.b` string").repartition(2)
    got = periodic.collapse_runs(docs, output=("runs", "clean"))
    assert got.columns == ["doc_id", "text", "a.b", "runs", "clean"]
    found = {(r["doc_id"], r["text"]): r for r in got.collect()}
    assert len(found) == len(texts)
    for doc_id, text, _, _ in rows:
        words = WORD.findall(text or "")
        wanted = plain_runs(words)
        r = found[doc_id, text]
        assert [tuple(x) for x in r["runs"]] == wanted and r["clean"] == plain_kept(words, wanted)
    assert periodic.collapse_runs(docs.where("false")).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choices(["ab", "c", "d　e", "f"], k=rng.randint(0, 60)))) for k in range(300)]
    rows += [(900, None), (901, ""), (None, "x " * 30), (3, "x " * 30), (3, "x " * 30), (-5, " ".join(f"w{i}" for i in range(3000)))]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = contract.queries()["op13_periodic_runs"](spark, str(tmp_path)).collect()
    wanted = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        start, length, period = best or (None, None, None)
        wanted.append(
            (
                doc_id, len(runs), start, length, period, 1000 * length // period if best else None,
                hashlib.sha256("".join(f"{s},{e},{q}\n" for s, e, q in runs).encode()).hexdigest(),
                hashlib.sha256(plain_kept(words, runs).encode()).hexdigest(),
            )
        )
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, wanted))
    assert sum(r[1] for r in wanted) > 10
