from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as tx


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_chat_markup(spark):
    messages = F.array(tx.message("system", F.lit("s")), tx.message("user", F.lit("u")))
    assert value(spark, tx.chat_markup(messages)) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n"
    assert value(spark, tx.chat_markup(messages, True)).endswith("<|im_start|>assistant\n")


def test_template_does_not_expand_values(spark):
    filled = tx.fill_template("{{x}} {a} {b}", a=F.lit("{b}"), b=F.lit("2"))
    assert value(spark, filled) == "{x} {b} 2"
    with pytest.raises(ValueError):
        tx.fill_template("{missing}")


@pytest.mark.parametrize(
    "text, score",
    [
        ('x ```json\n{"russian_language":"да","matching_target_answer":"a","correctness":"да","score":4}\n```', 4),
        ('{"russian_language":"да","matching_target_answer":"a","correctness":"нет","score":0}', 0),
        ('```json\n{"russian_language":"да", // c\n"matching_target_answer":"a","correctness":"да","score":4}\n```', None),
        ('{"russian_language":"да","score":4}', None),
        ("plain", None),
    ],
)
def test_verdicts(spark, text, score):
    verdict = value(spark, tx.parse_verdict(F.lit(text)))
    assert (verdict and verdict.score) == score if score is not None else verdict is None


def test_prompt_and_target(spark):
    prompt, target = tx.split_prompt_target(F.lit("<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n a \n<|im_end|>\n"))
    assert value(spark, prompt) == "<|im_start|>user\nq<|im_end|>"
    assert value(spark, target) == "a"
    _, missing = tx.split_prompt_target(F.lit("no marker"))
    assert value(spark, missing) == ""


def test_thinking_is_removed_across_lines(spark):
    assert value(spark, tx.remove_thinking(F.lit("<think>a\nb</think> c <think>d</think>"))) == "c"


def test_numbered_documents(spark):
    texts = tx.numbered_documents(F.array(F.lit("a"), F.lit("b")))
    assert value(spark, texts) == "Документ 1\n\n\na\n\n\nДокумент 2\n\n\nb\n\n\n"
