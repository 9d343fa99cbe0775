"""Model calls: failing rows stand alone; kept answers are never asked for again."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.functions import models
from threadloom.operators import evaluation as ev
from threadloom.operators.ledger import AnswerLedger
from threadloom.plans import evaluation_queries as eq

SF_DIR = "/root/testdata/sf0.001"


def test_isolated_rows():
    calls = []

    def call(rows):
        calls.append(len(rows))
        if 13 in rows:
            raise ValueError("poison")
        return [r * 2 for r in rows]

    run = models.isolated(call, attempts=3, pause=0.0)
    found, errors = run(list(range(64)))
    assert [f for f in found if f is not None] == [2 * k for k in range(64) if k != 13]
    assert errors[13] == "ValueError: poison" and sum(e is not None for e in errors) == 1
    # all attempts for the batch and for the row, one for what lies between
    assert len(calls) == 3 + 2 * 5 + 1 + 3
    assert models.isolated(lambda rows: [], 1, 0.0)([1]) == ([None], ["ValueError: 0 results for 1 rows"])
    assert run([]) == ([], [])


def test_one_poisoned_row_leaves_the_others(spark):
    def encoder():
        plain = models.hashing_encoder(4)

        def run(texts):
            if any("poison" in t for t in texts):
                raise RuntimeError("no vector")
            return plain(texts)

        return run

    rows = spark.createDataFrame([(k, "poison" if k == 9 else f"text {k}") for k in range(64)], "id int, t string").coalesce(1)
    got = rows.select("id", models.encode_column(F.col("t"), encoder, attempts=2, pause=0.0).alias("e")).collect()
    assert [r.id for r in got if r.e.error] == [9] and all(len(r.e.dense) == 4 for r in got if r.id != 9)
    scorer = models.pair_scorer(lambda: lambda pairs: [1 / (len(b) - 6) for _, b in pairs], attempts=1, pause=0.0)
    scores = rows.select("id", scorer(F.col("t"), F.col("t")).alias("s")).collect()
    # texts of six letters divide by zero
    assert {r.id for r in scores if r.s is None} == {k for k in range(10)}


def test_models_by_name(spark):
    made = {"a": models.echo_generator("a: "), "b": models.echo_generator("b: ")}
    rows = spark.createDataFrame([(k, "ab"[k % 2], f"p{k}") for k in range(20)], "id int, model string, prompt string")
    got = models.generate_by(rows, "prompt", "model", made, "answer").collect()
    assert {r.answer for r in got} == {f"{'ab'[k % 2]}: p{k}" for k in range(20)} and not any(r.answer_error for r in got)


def counted(folder, reply):
    """A generator that notes every prompt it is asked in a folder."""
    folder = str(folder)

    def build():
        def run(prompts):
            for p in prompts:
                with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
                    out.write(p)
            return reply(prompts)

        return run

    return build


def asked(folder):
    return sorted(open(os.path.join(folder, n)).read() for n in os.listdir(folder))


def test_answers_are_asked_for_once(spark, tmp_path):
    """The whole evaluation, two actions and a second evaluation: every prompt reaches its model once."""
    notes = {name: tmp_path / name for name in ("base", "tuned", "judge")}
    for folder in notes.values():
        folder.mkdir()
    makers = {name: counted(notes[name], make()) for name, make in eq.GENERATORS.items()}
    judge = counted(notes["judge"], eq.canned_judge())
    rows = eq.eval_rows(spark, SF_DIR).limit(30).persist()
    ledger = AnswerLedger(spark, str(tmp_path / "ledger"))

    def evaluate():
        answers = ev.answer_rows(rows, makers, eq.PROMPTS, ledger)
        return ev.judge(ev.judge_prompts(answers), judge, ledger)

    first = evaluate()
    plain = ev.judge(ev.judge_prompts(ev.answer_rows(rows, eq.GENERATORS, eq.PROMPTS)), lambda: eq.canned_judge())
    columns = ["id", "model", "variant", "answer", "reply", "second_reply", "verdict", "retried"]
    told = sorted(map(str, first.select(columns).collect()))
    assert told == sorted(map(str, plain.select(columns).collect()))
    first.count()
    assert sorted(map(str, evaluate().select(columns).collect())) == told
    texts = {p for r in rows.collect() for p in (r.prompt_plain, r.prompt_context)}
    assert asked(notes["base"]) == asked(notes["tuned"]) == sorted(texts)
    replies = asked(notes["judge"])
    retried = first.where("retried").count()
    assert retried > 0 and len(replies) == len(set(replies)) and len(replies) <= 30 * 4 + retried
    rows.unpersist()


def test_failed_calls_are_asked_for_again(spark, tmp_path):
    flag = tmp_path / "up"

    def maker():
        def run(prompts):
            if any(p == "bad" for p in prompts) and not os.path.exists(flag):
                raise RuntimeError("down")
            return [p.upper() for p in prompts]

        return run

    rows = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "bad"), (4, None)], "id int, prompt string").withColumn("model", F.lit("m"))
    ledger = AnswerLedger(spark, str(tmp_path / "ledger"))
    ask = lambda: {r.id: (r.answer, r.answer_error) for r in ledger.answers(rows, "prompt", {"m": maker}, attempts=2, pause=0.0).collect()}
    down = (None, "RuntimeError: down")
    assert ask() == {1: ("GOOD", None), 2: down, 3: down, 4: (None, None)}
    flag.write_text("")
    assert ask() == {1: ("GOOD", None), 2: ("BAD", None), 3: ("BAD", None), 4: (None, None)}
    assert ledger.stored().count() == 2


def test_answers_do_not_move_their_rows(spark, tmp_path):
    """Rows that ask for themselves are answered where they stand; the same question again, and no question, keep their rows."""
    rows = spark.createDataFrame([(n, f"text {n}", None if n % 10 == 0 else f"ask {n}") for n in range(200)], "id int, text string, prompt string")
    rows = rows.withColumn("model", F.lit("m"))
    ledger = AnswerLedger(spark, str(tmp_path / "ledger"))
    ask = lambda some: ledger.answers(some, "prompt", {"m": models.echo_generator()})
    first = ask(rows)
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
    told = {(r.id, r.text, r.answer) for r in first.collect()}
    assert told == {(n, f"text {n}", None if n % 10 == 0 else f"echo: ask {n}") for n in range(200)}
    more = rows.unionByName(rows.withColumn("id", F.col("id") + 200).withColumn("prompt", F.concat("prompt", F.lit("!"))))
    again = ask(more.unionByName(more)).collect()
    assert len(again) == 800 and ledger.stored().count() == 360
    assert all(r.answer == (None if r.prompt is None else "echo: " + r.prompt) for r in again)


def test_batches_of_long_texts_are_bounded(spark):
    """A worker sees few long texts at a time, whatever the number of rows a batch may have."""
    from threadloom.session import BATCH_BYTES, bound_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(key)
    try:
        spark.conf.set(key, str(64 << 20))
        bound_batches(spark)
        assert spark.conf.get(key) == str(BATCH_BYTES)
        texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("prompt"))
        seen = lambda: lambda prompts: [str(len(prompts))] * len(prompts)
        said = models.generate(texts, "prompt", seen, batch_size=10_000).agg(F.max(F.col("generated").cast("int"))).first()[0]
        assert said <= BATCH_BYTES // 20_000 + 1
        spark.conf.set(key, "1000000")
        bound_batches(spark)
        assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.set(key, given)


def test_words_are_counted_by_key_in_bounded_tasks(spark, monkeypatch):
    """Texts move once by their key, to as many tasks as their length asks for; repeated ids are one."""
    monkeypatch.setattr(models, "COUNTED_CHARACTERS", 50)
    rows = [(k % 40, f"a b a w{k} W{k % 7}  ") for k in range(60)] + [(None, "x x"), (99, None), (98, " ")]
    docs = spark.createDataFrame(rows, "id long, text string")
    counted = models.lexical_rows(docs, "id", "text", ("id", "term", "weight"))
    want = {}
    for key, text in rows:
        for word in (text or "").lower().split(" "):
            if word:
                want[key, word] = want.get((key, word), 0.0) + 1.0
    plan = counted._jdf.queryExecution().executedPlan().toString()
    characters = sum(len(t or "") for _, t in rows)
    assert plan.count("Exchange") == 1 and f", {-(-characters // 50)})" in plan
    assert {(r.id, r.term): r.weight for r in counted.collect()} == want


def test_rows_that_ask_are_told_by_bits(spark, tmp_path, monkeypatch):
    """A bit for each row says which one asks; no list of rows is joined to their texts."""
    written = {}
    plain = AnswerLedger._written
    monkeypatch.setattr(AnswerLedger, "_written", lambda self, rows, name: written.setdefault(name, plain(self, rows, name)))
    asked = spark.sparkContext.accumulator(0)

    def make():
        def run(prompts):
            asked.add(len(prompts))
            return [p + "!" for p in prompts]

        return run

    rows = spark.range(0, 70_000, 1, 2).select("id", F.concat(F.lit("p"), F.col("id") % 50_000).alias("prompt"), F.lit("m").alias("model"))
    got = AnswerLedger(spark, str(tmp_path / "ledger")).answers(rows, "prompt", {"m": make})
    assert got.count() == 70_000 and got.where("answer = concat(prompt, '!') and prompt = concat('p', id % 50000)").count() == 70_000
    assert asked.value == 50_000
    assert "rest" not in written and written["first"].columns == ["_bucket", "_bits"] and written["first"].count() <= 5
