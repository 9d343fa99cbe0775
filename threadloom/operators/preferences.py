"""Preference, packed, stepwise and completion-only training tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from threadloom.functions import text as tx
from threadloom.functions import tokens as tk
from threadloom.functions.models import word_ids
from threadloom.functions.vectors import array_sum
from threadloom.operators import ordering

Tokenize = Callable[[Column], Column]
TRUNCATION_MODES = ("keep_start", "keep_end")


def _check_mode(mode: str) -> None:
    if mode not in TRUNCATION_MODES:
        raise ValueError(f"unknown truncation mode {mode!r}, choose one of {TRUNCATION_MODES}")


# --- shaping -----------------------------------------------------------------------


def unpair(pairs: DataFrame) -> DataFrame:
    """Each pair becomes two rows (completion, label); other columns are repeated."""
    others = [c for c in pairs.columns if c not in ("chosen", "rejected")]
    rows = F.array(
        F.struct(F.col("chosen").alias("completion"), F.lit(True).alias("label")),
        F.struct(F.col("rejected").alias("completion"), F.lit(False).alias("label")),
    )
    return pairs.select(*others, F.inline(rows))


def stack_pairs(pairs: DataFrame, batch: str, pad: int = 0) -> DataFrame:
    """Chosen then rejected rows with the prompt repeated, padded per batch.

    Both roles are padded to the longest completion of the batch; ``batch``
    numbers groups of bounded size.
    """
    longest = F.max(
        F.greatest(F.size("chosen_input_ids"), F.size("rejected_input_ids"))
    ).over(Window.partitionBy(batch))
    sized = pairs.withColumn("_n", longest)
    others = [c for c in pairs.columns if c not in ("chosen_input_ids", "rejected_input_ids")]

    def one(role: str, place: int) -> DataFrame:
        ids = F.col(f"{role}_input_ids")
        return sized.select(
            *others,
            F.lit(role).alias("role"),
            F.lit(place).alias("role_no"),
            tk.pad_right(ids, F.col("_n"), F.lit(pad).cast("bigint")).alias("completion_input_ids"),
            tk.pad_right(
                F.transform(ids, lambda _: F.lit(1)), F.col("_n"), 0
            ).alias("completion_attention_mask"),
        )

    return one("chosen", 0).unionByName(one("rejected", 1))


def common_prefix(a: Column, b: Column) -> Column:
    """Elements two arrays share at their start, always leaving one of each."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    counted = F.aggregate(
        same,
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("open")),
        lambda acc, s: F.struct(
            (acc["n"] + F.when(acc["open"] & s, 1).otherwise(0)).alias("n"),
            (acc["open"] & s).alias("open"),
        ),
        lambda acc: acc["n"],
    )
    return F.greatest(F.least(counted, F.size(a) - 1, F.size(b) - 1), F.lit(0))


def extract_prompt(pairs: DataFrame) -> DataFrame:
    """Split the shared message prefix off chosen and rejected as ``prompt``."""
    if "prompt" in pairs.columns:
        return pairs
    cut = pairs.withColumn("_n", common_prefix(F.col("chosen"), F.col("rejected")))
    rest = lambda c: F.slice(F.col(c), F.col("_n") + 1, F.size(c))
    return cut.withColumns(
        {
            "prompt": F.slice("chosen", F.lit(1), F.col("_n")),
            "chosen": rest("chosen"),
            "rejected": rest("rejected"),
        }
    ).drop("_n")


def apply_chat_template(rows: DataFrame) -> DataFrame:
    """Render message columns as text; text columns stay as they are.

    The prompt ends with the assistant header, completions are what follows it.
    """
    chat = {
        f.name
        for f in rows.schema.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)
    }
    if "messages" in chat:
        return rows.withColumn("text", tx.chat_markup(F.col("messages"))).drop("messages")
    if "prompt" not in chat:
        return rows
    opened = tx.chat_markup(F.col("prompt"), add_generation_prompt=True)
    rendered = {"prompt": opened}
    for name in ("chosen", "rejected", "completion"):
        if name in chat:
            whole = tx.chat_markup(F.concat(F.col("prompt"), F.col(name)))
            rendered[name] = tx.strip_prompt(whole, opened)
    return rows.withColumns(rendered)


# --- tokenised rows -------------------------------------------------------------------


def tokenize_texts(
    rows: DataFrame,
    text: str = "text",
    max_length: int | None = None,
    tokenize: Tokenize = word_ids,
    keys: Sequence[str] = (),
    formatting: Callable[[], Column] | None = None,
) -> DataFrame:
    """input_ids and attention_mask of one text per row; tokenised rows pass through."""
    if "input_ids" in rows.columns:
        return rows
    source = formatting() if formatting else F.col(text)
    ids = rows.select(*keys, tk.keep_first(tokenize(source), max_length).alias("input_ids"))
    return ids.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))


def pack(
    rows: DataFrame,
    key: str,
    seq_length: int,
    eos: int,
    ids: str = "input_ids",
    append_eos: bool = True,
) -> DataFrame:
    """Blocks of exactly ``seq_length`` tokens from rows laid end to end in ``key`` order.

    Each row is cut at the block borders it crosses, so only slices are
    shuffled and a block never gathers more than ``seq_length`` tokens. The
    incomplete last block is dropped.
    """
    tokens = tk.with_eos(F.col(ids), eos) if append_eos else F.col(ids)
    laid = rows.select(key, tokens.alias("_t")).withColumn("_size", F.size("_t").cast("bigint"))
    if (laid.agg(F.sum("_size")).first()[0] or 0) < seq_length:
        raise ValueError("the data set does not hold enough tokens for one packed sequence")
    laid = ordering.running_total(laid, key, F.col("_size"), out="_end")
    start = F.col("_end") - F.col("_size")
    n = F.lit(seq_length).cast("bigint")
    block = lambda offset: F.floor(offset / n).cast("bigint")
    low = lambda b: F.greatest(b * n, start)
    high = lambda b: F.least((b + 1) * n, F.col("_end"))
    cut = lambda b: F.struct(
        b.alias("block"),
        low(b).alias("_low"),
        F.slice("_t", (low(b) - start + 1).cast("int"), (high(b) - low(b)).cast("int")).alias("_piece"),
    )
    # cut first, then explode: a long row is not copied once per block
    pieces = laid.filter(F.col("_size") > 0).select(
        F.inline(F.transform(F.sequence(block(start), block(F.col("_end") - 1)), cut))
    )
    blocks = pieces.groupBy("block").agg(
        F.flatten(
            F.transform(F.array_sort(F.collect_list(F.struct("_low", "_piece"))), lambda p: p["_piece"])
        ).alias("input_ids")
    )
    return blocks.filter(F.size("input_ids") == seq_length)


def completion_labels(rows: DataFrame, template: Sequence[int], ids: str = "input_ids") -> DataFrame:
    """Labels that ignore everything up to the response template."""
    return rows.withColumn("labels", tk.mask_before_template(F.col(ids), list(template)))


def tokenize_preferences(
    pairs: DataFrame,
    eos: int,
    bos: int | None = None,
    max_prompt_length: int | None = None,
    max_completion_length: int | None = None,
    add_special_tokens: bool = False,
    tokenize: Tokenize = word_ids,
) -> DataFrame:
    """Last ids of the prompt, first ids of each completion, end token on completions."""
    others = [c for c in pairs.columns if c not in ("prompt", "chosen", "rejected")]
    prompt = tokenize(F.col("prompt"))
    if add_special_tokens:
        if bos is not None:
            prompt = F.array_prepend(prompt, F.lit(bos).cast("bigint"))
        prompt = F.array_append(prompt, F.lit(eos).cast("bigint"))
    end = lambda c: F.array_append(tokenize(F.col(c)), F.lit(eos).cast("bigint"))
    raw = pairs.select(*others, prompt.alias("_p"), end("chosen").alias("_c"), end("rejected").alias("_r"))
    return raw.select(
        *others,
        tk.keep_last(F.col("_p"), max_prompt_length).alias("prompt_input_ids"),
        tk.keep_first(F.col("_c"), max_completion_length).alias("chosen_input_ids"),
        tk.keep_first(F.col("_r"), max_completion_length).alias("rejected_input_ids"),
    )


def separate_answer_tokens(tokenize: Tokenize = word_ids) -> Callable[[Column, Column], Column]:
    """struct(prompt_ids, answer_ids) for tokenizers whose tokens never cross the border."""

    def split(prompt: Column, answer: Column) -> Column:
        return F.struct(tokenize(prompt).alias("prompt_ids"), tokenize(answer).alias("answer_ids"))

    return split


def tokenize_with_budget(
    pairs: DataFrame,
    eos: int,
    bos: int | None,
    max_length: int,
    max_prompt_length: int,
    truncation_mode: str = "keep_end",
    split_answer: Callable[[Column, Column], Column] | None = None,
    tokenize: Tokenize = word_ids,
) -> DataFrame:
    """Prompt + answer sequences within ``max_length``, labels ignoring the prompt.

    When the longer answer does not fit behind a prompt, the prompt is cut
    first; when that is not enough, the answers are cut.
    """
    _check_mode(truncation_mode)
    split = split_answer or separate_answer_tokens(tokenize)
    others = [c for c in pairs.columns if c not in ("prompt", "chosen", "rejected")]
    rows = pairs.select(
        *others,
        tokenize(F.col("prompt")).alias("_p"),
        split(F.col("prompt"), F.col("chosen")).alias("_c"),
        split(F.col("prompt"), F.col("rejected")).alias("_r"),
    )
    chosen_prompt, rejected_prompt = F.col("_c.prompt_ids"), F.col("_r.prompt_ids")
    shared = F.least(F.size(chosen_prompt), F.size(rejected_prompt))
    differing = F.size(
        F.filter(
            F.zip_with(
                F.slice(chosen_prompt, F.lit(1), shared),
                F.slice(rejected_prompt, F.lit(1), shared),
                lambda x, y: x != y,
            ),
            lambda d: d,
        )
    )
    broken = (differing > 1) | (F.abs(F.size(chosen_prompt) - F.size(rejected_prompt)) > 1)
    message = "chosen and rejected prompts may differ in their last token only"
    rows = rows.select(
        *others,
        tk.with_bos_if_missing(F.slice("_p", F.lit(1), shared), bos).alias("prompt_ids"),
        F.when(broken, F.raise_error(F.lit(message)))
        .otherwise(tk.with_bos_if_missing(chosen_prompt, bos))
        .alias("chosen_prompt"),
        tk.with_bos_if_missing(rejected_prompt, bos).alias("rejected_prompt"),
        tk.with_eos_if_missing(F.col("_c.answer_ids"), eos).alias("chosen_ids"),
        tk.with_eos_if_missing(F.col("_r.answer_ids"), eos).alias("rejected_ids"),
    ).withColumn("longer", F.greatest(F.size("chosen_ids"), F.size("rejected_ids")))

    cut = tk.keep_first if truncation_mode == "keep_start" else tk.keep_last
    too_long = lambda c: F.size(c) + F.col("longer") > max_length
    rows = rows.withColumns(
        {
            c: F.when(too_long(c), cut(F.col(c), max_prompt_length)).otherwise(F.col(c))
            for c in ("prompt_ids", "chosen_prompt", "rejected_prompt")
        }
    )
    rows = rows.withColumns(
        {
            f"{role}_ids": F.when(
                too_long(f"{role}_prompt"),
                tk.keep_first(F.col(f"{role}_ids"), max_length - max_prompt_length),
            ).otherwise(F.col(f"{role}_ids"))
            for role in ("chosen", "rejected")
        }
    )
    ones = lambda c: F.transform(c, lambda _: F.lit(1))
    out = {}
    for role in ("chosen", "rejected"):
        out[f"{role}_input_ids"] = F.concat(f"{role}_prompt", f"{role}_ids")
        out[f"{role}_attention_mask"] = ones(F.concat(f"{role}_prompt", f"{role}_ids"))
        out[f"{role}_labels"] = F.concat(tk.ignored(F.size(f"{role}_prompt")), F.col(f"{role}_ids"))
    out["prompt_input_ids"] = F.col("prompt_ids")
    out["prompt_attention_mask"] = ones(F.col("prompt_ids"))
    return rows.select(*others, *[c.alias(n) for n, c in out.items()])


def process_unpaired(
    rows: DataFrame,
    eos: int,
    bos: int | None,
    max_length: int,
    max_prompt_length: int,
    truncation_mode: str = "keep_end",
    prefix: str = "",
    completion: str = "completion",
    tokenize: Tokenize = word_ids,
) -> DataFrame:
    """Append prompt, completion ids and labels of (prompt, completion) rows."""
    _check_mode(truncation_mode)
    cut = tk.keep_first if truncation_mode == "keep_start" else tk.keep_last
    room = max_length - 1 - (1 if bos is not None else 0)
    work = rows.withColumns({"_p": tokenize(F.col("prompt")), "_a": tokenize(F.col(completion))})
    over = F.size("_p") + F.size("_a") > room
    work = work.withColumn("_p", F.when(over, cut(F.col("_p"), max_prompt_length)).otherwise(F.col("_p")))
    over = F.size("_p") + F.size("_a") > room
    work = work.withColumn(
        "_a", F.when(over, tk.keep_first(F.col("_a"), room - max_prompt_length)).otherwise(F.col("_a"))
    )
    work = work.withColumns(
        {"_p": tk.with_bos_if_missing(F.col("_p"), bos), "_a": tk.with_eos_if_missing(F.col("_a"), eos)}
    )
    return work.withColumns(
        {
            f"{prefix}prompt_input_ids": F.col("_p"),
            f"{prefix}completion_input_ids": F.concat("_p", "_a"),
            f"{prefix}completion_labels": F.concat(tk.ignored(F.size("_p")), F.col("_a")),
        }
    ).drop("_p", "_a")


def prepare_unpaired(
    pairs: DataFrame,
    key: str,
    eos: int,
    bos: int | None,
    max_length: int,
    max_prompt_length: int,
    batch_size: int,
    tokenize: Tokenize = word_ids,
) -> DataFrame:
    """Pairs -> labelled rows with their own and a mismatched completion, tokenised.

    ``row_id`` numbers the unpaired rows: twice the pair's key, plus one for
    the rejected side.
    """
    rows = apply_chat_template(unpair(extract_prompt(pairs)))
    rows = rows.withColumn("row_id", F.col(key) * 2 + F.when(F.col("label"), 0).otherwise(1))
    settings = dict(
        eos=eos, bos=bos, max_length=max_length, max_prompt_length=max_prompt_length, tokenize=tokenize
    )
    own = process_unpaired(rows, **settings)
    shifted = ordering.mismatched_pairs(
        rows.select("row_id", "prompt", "completion"), "row_id", "completion", batch_size, "KL_completion"
    )
    kl = process_unpaired(shifted, prefix="KL_", completion="KL_completion", **settings)
    return merge_columns(own, kl.drop("prompt", "completion"), "row_id")


def merge_columns(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """Column-wise merge of two row-aligned tables on their explicit row id."""
    return left.join(right, row_id)


def stepwise_rows(
    rows: DataFrame,
    separator: Sequence[int],
    bos: int | None = None,
    max_length: int | None = None,
    max_prompt_length: int | None = None,
    max_completion_length: int | None = None,
    last_step_only: bool = False,
    is_eval: bool = False,
    tokenize: Tokenize = word_ids,
    tokenize_steps: Tokenize | None = None,
) -> DataFrame:
    """input_ids and labels: one label at the last token of every step.

    ``separator`` holds the token ids put after each step. A tokenizer that
    runs in Python cannot be called inside an array lambda; pass its list form
    as ``tokenize_steps``.
    """
    steps = tokenize_steps or (lambda texts: F.transform(texts, lambda t: tokenize(t)))
    others = [c for c in rows.columns if c not in ("prompt", "completions", "labels")]
    tail = F.array(*[F.lit(s).cast("bigint") for s in separator])
    if not separator:
        tail = F.array().cast("array<bigint>")
    number = F.transform("labels", lambda l: l.cast("bigint"))
    if last_step_only and not is_eval:
        others_ignored = tk.ignored(F.greatest(F.size("labels") - 1, F.lit(0)))
        number = F.concat(others_ignored, F.slice(number, -1, 1))
    prompt = tokenize(F.col("prompt"))
    if bos is not None:
        prompt = F.array_prepend(prompt, F.lit(bos).cast("bigint"))
    work = rows.select(
        *others,
        tk.keep_last(prompt, max_prompt_length).alias("_p"),
        F.transform(steps(F.col("completions")), lambda ids: F.concat(ids, tail)).alias("_steps"),
        number.alias("_l"),
    )
    step_labels = F.zip_with(
        "_steps", "_l", lambda s, l: F.concat(tk.ignored(F.greatest(F.size(s) - 1, F.lit(0))), F.array(l))
    )
    work = work.select(
        *others,
        "_p",
        tk.keep_first(F.flatten("_steps"), max_completion_length).alias("_c"),
        tk.keep_first(F.flatten(step_labels), max_completion_length).alias("_cl"),
    )
    return work.select(
        *others,
        tk.keep_first(F.concat("_p", "_c"), max_length).alias("input_ids"),
        tk.keep_first(F.concat(tk.ignored(F.size("_p")), "_cl"), max_length).alias("labels"),
    )


def tokenize_prompts(rows: DataFrame, bos: int | None, tokenize: Tokenize = word_ids) -> DataFrame:
    """Prompt ids with a begin token where it is missing."""
    others = [c for c in rows.columns if c != "prompt"]
    ids = rows.select(*others, tokenize(F.col("prompt")).alias("_p"))
    return ids.select(
        *others, tk.with_bos_if_missing(F.col("_p"), bos).alias("prompt_input_ids")
    ).withColumn("prompt_attention_mask", F.transform("prompt_input_ids", lambda _: F.lit(1)))


def split_by_label(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Desirable and undesirable rows."""
    return rows.filter("label"), rows.filter(~F.col("label"))


def within_length(rows: DataFrame, max_length: int) -> DataFrame:
    """Pairs whose two sides both fit."""
    return rows.filter(
        (F.size("input_ids_chosen") <= max_length) & (F.size("input_ids_rejected") <= max_length)
    )


# --- balance and metrics -------------------------------------------------------------------


def class_balance(
    rows: DataFrame, label: str = "label", desirable_weight: float = 1.0, undesirable_weight: float = 1.0
) -> DataFrame:
    """Recommended weight ranges of both classes and whether the weights are inside."""
    counts = rows.agg(
        F.greatest(F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)), F.lit(1)).alias("num_desirable"),
        F.count(F.lit(1)).alias("_n"),
    ).select(
        "num_desirable",
        F.greatest(F.col("_n") - F.col("num_desirable"), F.lit(1)).alias("num_undesirable"),
    )
    toward_desirable = F.col("num_undesirable") * F.lit(undesirable_weight) / F.col("num_desirable")
    toward_undesirable = F.col("num_desirable") * F.lit(desirable_weight) / F.col("num_undesirable")
    # The range factor 1.33, and bounds kept to two decimals.
    bounds = counts.withColumns(
        {
            "des_weight_lower_bound": F.bround(toward_desirable * F.lit(1.0), 2),
            "des_weight_upper_bound": F.bround(toward_desirable * F.lit(1.33), 2),
            "und_weight_lower_bound": F.bround(toward_undesirable / F.lit(1.33), 2),
            "und_weight_upper_bound": F.bround(toward_undesirable / F.lit(1.0), 2),
        }
    )
    inside = lambda side, weight: F.lit(weight).between(
        F.col(f"{side}_weight_lower_bound"), F.col(f"{side}_weight_upper_bound")
    )
    return bounds.withColumns(
        {
            "des_weight_in_range": inside("des", desirable_weight),
            "und_weight_in_range": inside("und", undesirable_weight),
        }
    )


def implicit_reward(policy: str, reference: str | None, beta: float) -> Column:
    """beta (log p - log ref), or beta log p without a reference."""
    difference = F.col(policy) if reference is None else F.col(policy) - F.col(reference)
    return F.lit(beta) * difference


def pair_metrics(
    scored: DataFrame, beta: float, reference_free: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Mean rewards, accuracy, margin and log-probabilities of scored pairs."""
    ref = (None, None) if reference_free else ("ref_chosen_logps", "ref_rejected_logps")
    chosen = implicit_reward("chosen_logps", ref[0], beta)
    rejected = implicit_reward("rejected_logps", ref[1], beta)
    return scored.groupBy(*by).agg(
        F.avg(chosen).alias("rewards_chosen"),
        F.avg(rejected).alias("rewards_rejected"),
        F.avg((chosen > rejected).cast("double")).alias("rewards_accuracies"),
        F.avg(chosen - rejected).alias("rewards_margins"),
        F.avg("chosen_logps").alias("logps_chosen"),
        F.avg("rejected_logps").alias("logps_rejected"),
    )


def unpaired_metrics(
    rows: DataFrame, metrics: Sequence[str] = ("rewards", "logps", "logits"), by: Sequence[str] = ()
) -> DataFrame:
    """NaN-skipping sums over row counts per label, and the reward margin.

    A NaN adds nothing to its sum but its row still counts.
    """
    def mean(metric: str, wanted: bool) -> Column:
        mine = F.col("label") == F.lit(wanted)
        value = F.when(F.isnan(metric), F.lit(0.0)).otherwise(F.col(metric))
        count = F.count_if(mine)
        return F.when(count > 0, F.sum(F.when(mine, value)) / count)

    out = rows.groupBy(*by).agg(
        *[
            mean(metric, wanted).alias(f"{metric}_{side}")
            for metric in metrics
            for side, wanted in (("chosen", True), ("rejected", False))
        ]
    )
    if "rewards" not in metrics:
        return out
    return out.withColumn("rewards_margins", F.col("rewards_chosen") - F.col("rewards_rejected"))


def reference_scores(rows: DataFrame, scores: DataFrame, row_id: str) -> DataFrame:
    """Computed score columns attached by row id; rows without scores keep NULL."""
    return rows.join(scores, row_id, "left")


def sequence_logps(rows: DataFrame, values: str, out: str) -> DataFrame:
    return rows.withColumn(out, array_sum(F.col(values)))
