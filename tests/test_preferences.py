from __future__ import annotations

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from threadloom.functions import models, tokens as tk
from threadloom.operators import preferences as pf

# workers cannot import the test module, so its functions travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EOS = 50256
VOCAB = {"The": 464, "sky": 6766, "is": 318, "blue": 4171, "green": 4077}


def vocabulary():
    return lambda text: [VOCAB[w] for w in text.split()]


def test_documented_preference_example(spark):
    rows = spark.createDataFrame([("The sky is", " blue", " green")], "prompt string, chosen string, rejected string")
    ids = pf.tokenize_preferences(
        rows, EOS, max_prompt_length=3, max_completion_length=3, tokenize=models.tokenizer_udf(vocabulary)
    ).first()
    assert ids.prompt_input_ids == [464, 6766, 318]
    assert ids.chosen_input_ids == [4171, EOS]
    assert ids.rejected_input_ids == [4077, EOS]


def test_stepwise_labels(spark):
    rows = spark.createDataFrame(
        [("pq", ["abc", "de"], [True, False])], "prompt string, completions array<string>, labels array<boolean>"
    )
    got = pf.stepwise_rows(rows, [10]).first()
    one = lambda w: rows.select(models.word_ids(F.lit(w)).alias("i")).first().i[0]
    assert got.input_ids == [one("pq"), one("abc"), 10, one("de"), 10]
    assert got.labels == [-100, -100, 1, -100, 0]
    last = pf.stepwise_rows(rows, [10], last_step_only=True).first()
    assert last.labels == [-100, -100, -100, -100, 0]
    held_out = pf.stepwise_rows(rows, [10], last_step_only=True, is_eval=True).first()
    assert held_out.labels == got.labels


def letters():
    return lambda text: [ord(c) for c in text]


def test_stepwise_with_a_python_tokenizer(spark):
    rows = spark.createDataFrame(
        [("p", ["ab", "c"], [False, True])], "prompt string, completions array<string>, labels array<boolean>"
    )
    got = pf.stepwise_rows(
        rows,
        [10],
        bos=1,
        max_length=6,
        tokenize=models.tokenizer_udf(letters),
        tokenize_steps=models.list_tokenizer_udf(letters),
    ).first()
    assert got.input_ids == [1, 112, 97, 98, 10, 99]
    assert got.labels == [-100, -100, -100, -100, 0, -100]


def budget(prompt, chosen, rejected, mode, max_length=8, max_prompt=3, bos=1, eos=2):
    prompts = [[bos] + prompt] * 3
    answers = [chosen + [eos], rejected + [eos]]
    longer = max(map(len, answers))
    cut = (lambda p: p[:max_prompt]) if mode == "keep_start" else (lambda p: p[-max_prompt:])
    prompts = [cut(p) if len(p) + longer > max_length else p for p in prompts]
    answers = [
        a[: max_length - max_prompt] if len(p) + longer > max_length else a for a, p in zip(answers, prompts)
    ]
    return [p + a for p, a in zip(prompts, answers)]


@pytest.mark.parametrize("mode", pf.TRUNCATION_MODES)
@pytest.mark.parametrize("sizes", [(2, 2, 3), (6, 2, 3), (6, 9, 3), (1, 20, 1)])
def test_length_budget(spark, mode, sizes):
    n, c, r = sizes
    word = lambda tag, k: " ".join(f"{tag}{i}" for i in range(k))
    prompt, chosen, rejected = word("p", n) + " ", word("c", c), word("r", r)
    rows = spark.createDataFrame([(prompt, chosen, rejected)], "prompt string, chosen string, rejected string")
    got = pf.tokenize_with_budget(rows, 2, 1, 8, 3, mode).first()
    ids = lambda text: rows.select(models.word_ids(F.lit(text)).alias("i")).first().i
    want = budget(ids(prompt), ids(chosen), ids(rejected), mode)
    assert [got.chosen_input_ids, got.rejected_input_ids] == want
    kept = sum(l == -100 for l in got.chosen_labels)
    assert got.chosen_labels[kept:] == got.chosen_input_ids[kept:]
    assert len(got.chosen_attention_mask) == len(got.chosen_input_ids)


def test_unknown_truncation_mode(spark):
    rows = spark.createDataFrame([("a", "b", "c")], "prompt string, chosen string, rejected string")
    with pytest.raises(ValueError, match="truncation mode"):
        pf.tokenize_with_budget(rows, 2, 1, 8, 3, "middle")


def merging():
    """Tokens are runs of letters, so a border inside a run merges."""
    return lambda text: [sum(map(ord, w)) for w in text.split(" ") if w]


def test_joint_tokens_move_the_border(spark):
    rows = spark.createDataFrame([("ab c", "d e"), ("ab ", "d e")], "p string, a string")
    split = models.joint_answer_tokens(merging)
    got = [r.s for r in rows.select(split("p", "a").alias("s")).collect()]
    assert got[0].prompt_ids == [195] and got[0].answer_ids == [199, 101]
    assert got[1].prompt_ids == [195] and got[1].answer_ids == [100, 101]


@pytest.mark.parametrize("length", [4, 7])
def test_packing(spark, length):
    docs = [(i, list(range(i * 100, i * 100 + n))) for i, n in enumerate([3, 0, 11, 1, 6])]
    rows = spark.createDataFrame(docs, "id long, input_ids array<bigint>")
    stream = [t for _, ids in docs for t in ids + [-1]]
    want = [stream[i : i + length] for i in range(0, len(stream) - length + 1, length)]
    got = [r.input_ids for r in pf.pack(rows, "id", length, eos=-1).orderBy("block").collect()]
    assert got == want
    with pytest.raises(ValueError, match="enough tokens"):
        pf.pack(rows, "id", 1000, eos=-1)


def test_masks(spark):
    df = spark.sql("select array(5L, 9L, 6L, 9L, 7L) i, array(5L, 6L) n")
    row = df.select(
        tk.completion_mask(F.col("i"), 9).alias("m"),
        tk.completion_mask(F.col("n"), 9).alias("none"),
        tk.cut_at_stop(F.col("i"), 9, 0).alias("c"),
        tk.mask_before_template(F.col("i"), [9]).alias("l"),
        tk.mask_before_template(F.col("n"), [9]).alias("ln"),
        tk.keep_last(F.col("i"), 2).alias("last"),
        tk.keep_last(F.col("n"), 0).alias("zero"),
    ).first()
    assert row.m == [1, 1, 0, 0, 0] and row.none == [1, 1]
    assert row.c == [5, 9, 0, 0, 0]
    assert row.l == [-100, -100, -100, -100, 7] and row.ln == [-100, -100]
    assert row.last == [9, 7] and row.zero == [5, 6]


def test_prompt_extraction_leaves_a_completion(spark):
    message = "array<struct<role:string,content:string>>"
    same = [("user", "q"), ("assistant", "a")]
    rows = spark.createDataFrame(
        [(1, same, [("user", "q"), ("assistant", "b")]), (2, same, same)], f"id int, chosen {message}, rejected {message}"
    )
    got = {r.id: r for r in pf.extract_prompt(rows).collect()}
    assert [m.content for m in got[1].prompt] == ["q"] and got[1].rejected[0].content == "b"
    assert len(got[2].chosen) == 1


def test_class_balance(spark):
    rows = spark.createDataFrame([(True,)] * 3 + [(False,)] * 5, "label boolean")
    b = pf.class_balance(rows).first()
    assert (b.num_desirable, b.num_undesirable) == (3, 5)
    assert (b.des_weight_lower_bound, b.des_weight_upper_bound) == (1.67, 2.22)
    assert (b.und_weight_lower_bound, b.und_weight_upper_bound) == (0.45, 0.6)
    none = pf.class_balance(rows.filter("label and not label")).first()
    assert (none.num_desirable, none.num_undesirable) == (1, 1)


def test_nan_rows_count(spark):
    rows = spark.createDataFrame([(True, 1.0), (True, float("nan")), (False, 3.0)], "label boolean, rewards double")
    m = pf.unpaired_metrics(rows, ("rewards",)).first()
    assert (m.rewards_chosen, m.rewards_rejected, m.rewards_margins) == (0.5, 3.0, -2.5)
