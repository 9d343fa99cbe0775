"""Rewards, advantages and statistics of generated completions.

Group statistics are aggregates joined back on the group, not windows over it,
so a group that holds a large share of the rows is combined before the shuffle
and never sorted by one task. Per-token work stays inside its row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.tokens import let
from threadloom.functions.vectors import array_sum

# Guards against division by zero.
GROUP_EPSILON = 1e-4
WHITEN_EPSILON = 1e-8


# --- rewards and advantages per completion -------------------------------------------


def total_rewards(rollouts: DataFrame) -> DataFrame:
    """Sum over the reward functions of each completion."""
    return rollouts.groupBy("group_id", "gen_no").agg(F.sum("reward").alias("reward"))


def _with_group(rewards: DataFrame, *aggregates: Column, group: str = "group_id") -> DataFrame:
    return rewards.join(rewards.groupBy(group).agg(*aggregates), group)


def group_advantages(rewards: DataFrame, group: str = "group_id", reward: str = "reward") -> DataFrame:
    """(r - mean) / (std + 1e-4) within the group; NULL for a group of one."""
    stats = _with_group(
        rewards, F.avg(reward).alias("_mean"), F.stddev_samp(reward).alias("_std"), group=group
    )
    return stats.withColumn(
        "advantage", (F.col(reward) - F.col("_mean")) / (F.col("_std") + GROUP_EPSILON)
    ).drop("_mean", "_std")


def leave_one_out(rewards: DataFrame, group: str = "group_id", reward: str = "reward") -> DataFrame:
    """Baseline (mean of the others) and advantage; NULL for a group of one."""
    stats = _with_group(rewards, F.sum(reward).alias("_sum"), F.count(F.lit(1)).alias("_k"), group=group)
    baseline = F.when(
        F.col("_k") > 1, (F.col("_sum") - F.col(reward)) / (F.col("_k") - F.lit(1))
    )
    return (
        stats.withColumn("baseline", baseline)
        .withColumn("advantage", F.col(reward) - F.col("baseline"))
        .drop("_sum", "_k")
    )


def whiten(rows: DataFrame, value: str, out: str, clip: float | None = None) -> DataFrame:
    """(x - mean) / (std + 1e-8) over all rows, clipped to +-``clip``."""
    stats = rows.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    scaled = (F.col(value) - stats.select("mean").scalar()) / (
        stats.select("std").scalar() + F.lit(WHITEN_EPSILON)
    )
    if clip is not None:
        scaled = F.least(F.greatest(scaled, F.lit(-clip)), F.lit(clip))
    return rows.withColumn(out, scaled)


def missing_eos_penalty(score: Column, ids: Column, eos: int, penalty: float | None) -> Column:
    if penalty is None:
        return score
    return F.when(F.array_contains(ids, eos), score).otherwise(score - penalty)


# --- per-token arrays -------------------------------------------------------------------


def kl_terms(logps: Column, ref_logps: Column) -> Column:
    return F.zip_with(logps, ref_logps, lambda p, r: p.cast("double") - r.cast("double"))


def sequence_reward(score: Column, logps: Column, ref_logps: Column, coef: float) -> Column:
    """Score less the penalty on the summed log-ratio."""
    return score - F.lit(coef) * array_sum(kl_terms(logps, ref_logps))


def token_rewards(
    score: Column, logps: Column, ref_logps: Column, coef: float, last: Column | None = None
) -> Column:
    """Per-token penalty, with the score added at index ``last`` (default: the end)."""
    kl = kl_terms(logps, ref_logps)
    return let(
        lambda s: F.transform(
            s["kl"], lambda x, i: F.lit(-coef) * x + F.when(i == s["last"], s["score"]).otherwise(0.0)
        ),
        kl=kl,
        score=score,
        last=F.size(logps) - 1 if last is None else last,
    )


def kl_estimates(logps: Column, ref_logps: Column) -> Column:
    """exp(r - p) - (r - p) - 1 for every token."""
    return F.zip_with(
        logps,
        ref_logps,
        lambda p, r: F.exp(r.cast("double") - p) - (r.cast("double") - p) - F.lit(1.0),
    )


def masked_mean(values: Column, mask: Column) -> Column:
    total = array_sum(F.zip_with(values, mask, lambda v, m: v * m))
    kept = F.aggregate(mask, F.lit(0).cast("bigint"), lambda acc, m: acc + m)
    return F.when(kept > 0, total / kept)


def reverse_scan(gamma: float, lam: float) -> Callable[[Column, Column], Column]:
    """UDF (rewards, values) -> struct(advantages, returns), scanned from the end.

    Rows of an Arrow batch are scanned together, one position at a time from
    the right, so the loop runs over the longest row and not over every token.
    """

    @F.pandas_udf("struct<advantages: array<double>, returns: array<double>>")
    def scan(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for rewards, values in batches:
            advantages, returns = [None] * len(rewards), [None] * len(rewards)
            sizes = rewards.map(len).to_numpy()
            # rows of like length share a padded block of bounded size
            order = np.argsort(sizes, kind="stable")
            for rows in _blocks(order, sizes):
                width = int(sizes[rows].max()) if len(rows) else 0
                r, v = np.zeros((len(rows), width)), np.zeros((len(rows), width + 1))
                for i, row in enumerate(rows):
                    r[i, width - sizes[row] :] = rewards.iloc[row]
                    v[i, width - sizes[row] : width] = values.iloc[row]
                delta = r + gamma * v[:, 1:] - v[:, :-1]
                run = np.zeros(len(rows))
                out = np.zeros_like(r)
                for t in range(width - 1, -1, -1):
                    run = delta[:, t] + gamma * lam * run
                    out[:, t] = run
                for i, row in enumerate(rows):
                    own = out[i, width - sizes[row] :]
                    advantages[row] = own
                    returns[row] = own + v[i, width - sizes[row] : width]
            yield pd.DataFrame({"advantages": advantages, "returns": returns})

    return scan


def _blocks(order: np.ndarray, sizes: np.ndarray, cells: int = 2_000_000) -> Iterator[np.ndarray]:
    """Consecutive runs of rows whose padded size stays within ``cells``."""
    low = 0
    for high in range(1, len(order) + 1):
        full = high < len(order) and (high - low + 1) * max(1, sizes[order[high]]) > cells
        if high == len(order) or full:
            yield order[low:high]
            low = high


def returns_and_advantages(
    rows: DataFrame, rewards: str, values: str, gamma: float = 1.0, lam: float = 0.95
) -> DataFrame:
    scan = reverse_scan(gamma, lam)
    return rows.withColumn("_s", scan(F.col(rewards), F.col(values))).select(
        *rows.columns, "_s.advantages", "_s.returns"
    )


def masked_whiten(
    rows: DataFrame, values: str, mask: str, out: str, shift_mean: bool = True
) -> DataFrame:
    """Whiten per-token values by the mean and variance of all unmasked tokens.

    Two passes over per-row partial sums; no token is shuffled. Masked tokens
    are scaled too, callers fill them afterwards.
    """
    kept = F.aggregate(mask, F.lit(0).cast("bigint"), lambda acc, m: acc + m)
    sums = array_sum(F.zip_with(values, mask, lambda v, m: v * m))
    totals = rows.agg(F.sum(sums).alias("s"), F.sum(kept).alias("n"))
    mean = totals.select(F.col("s") / F.col("n")).scalar()
    n = totals.select("n").scalar()
    bound = rows.withColumns({"_mean": mean, "_n": n})
    squares = let(
        lambda s: array_sum(
            F.zip_with(s["v"], s["m"], lambda v, m: (v - s["mean"]) * (v - s["mean"]) * m)
        ),
        v=F.col(values),
        m=F.col(mask),
        mean=F.col("_mean"),
    )
    # sample variance, as the masked variance of the trainers is
    spread = bound.agg((F.sum(squares) / (F.max("_n") - 1)).alias("v")).scalar()
    scaled = let(
        lambda s: F.transform(
            s["v"],
            lambda v: (v - s["mean"]) / F.sqrt(s["var"] + F.lit(WHITEN_EPSILON))
            + (F.lit(0.0) if shift_mean else s["mean"]),
        ),
        v=F.col(values),
        mean=F.col("_mean"),
        var=F.col("_var"),
    )
    return bound.withColumn("_var", spread).withColumn(out, scaled).drop("_mean", "_n", "_var")


# --- best of two ---------------------------------------------------------------------------


def best_of_two(first: DataFrame, second: DataFrame, keys: Sequence[str], prefer_first: Column) -> DataFrame:
    """(chosen, rejected, scores) from two completions per prompt, joined on ``keys``.

    Both sides carry ``completion`` and ``score``; ``prefer_first`` sees them as
    completion_1/score_1 and completion_2/score_2.
    """
    side = lambda df, n: df.select(
        *keys, F.col("completion").alias(f"completion_{n}"), F.col("score").alias(f"score_{n}")
    )
    both = side(first, 1).join(side(second, 2), list(keys))
    pick = lambda name, a, b: F.when(prefer_first, F.col(f"{name}_{a}")).otherwise(F.col(f"{name}_{b}"))
    return both.select(
        *keys,
        pick("completion", 1, 2).alias("chosen"),
        pick("completion", 2, 1).alias("rejected"),
        pick("score", 1, 2).alias("chosen_score"),
        pick("score", 2, 1).alias("rejected_score"),
    )


def by_score() -> Column:
    """Ties go to the first completion."""
    return F.col("score_1") >= F.col("score_2")


# --- statistics of a rollout log ---------------------------------------------------------------


def _sum(name: str) -> Column:
    return array_sum(F.col(name))


def online_pair_statistics(pairs: DataFrame, beta: float, by: Sequence[str] = ()) -> DataFrame:
    """Means over prompts with two completions each.

    Columns per side (chosen, rejected): *_score, *_logps, *_ref_logps (arrays),
    *_has_eos.
    """
    sums = pairs.withColumns(
        {
            f"_{side}_{kind}": _sum(f"{side}_{kind}")
            for side in ("chosen", "rejected")
            for kind in ("logps", "ref_logps")
        }
    )
    reward = lambda side: F.lit(beta) * (F.col(f"_{side}_logps") - F.col(f"_{side}_ref_logps"))
    both = lambda of: (of("chosen") + of("rejected")) / F.lit(2.0)
    kl = lambda side: F.col(f"_{side}_logps") - F.col(f"_{side}_ref_logps")
    penalty = lambda side: F.lit(-beta) * kl(side)
    margin = reward("chosen") - reward("rejected")
    score = lambda side: F.col(f"{side}_score")
    return sums.groupBy(*by).agg(
        F.avg(score("chosen") - score("rejected")).alias("objective_scores_margin"),
        F.avg(both(score)).alias("objective_scores"),
        F.avg(both(lambda s: F.col(f"{s}_has_eos").cast("double"))).alias("val_contain_eos_token"),
        F.avg("_chosen_logps").alias("logps_chosen"),
        F.avg("_rejected_logps").alias("logps_rejected"),
        F.avg(both(kl)).alias("objective_kl"),
        F.avg(both(penalty)).alias("objective_non_score_reward"),
        F.avg(both(lambda s: score(s) + penalty(s))).alias("objective_rlhf_reward"),
        F.avg(both(lambda s: -F.col(f"_{s}_logps"))).alias("objective_entropy"),
        F.avg(reward("chosen")).alias("rewards_chosen"),
        F.avg(reward("rejected")).alias("rewards_rejected"),
        F.avg(margin).alias("rewards_margins"),
        F.avg((margin > 0).cast("double")).alias("rewards_accuracies"),
    )


def exploration_statistics(rows: DataFrame, beta: float, by: Sequence[str] = ()) -> DataFrame:
    """Means over prompts with one model and one reference completion.

    Columns: model_score, ref_score, chosen_is_model, model_has_eos,
    ref_has_eos, and token arrays model_on_model, ref_on_model, model_on_ref,
    ref_on_ref (log-probabilities of the first under the text of the second).
    """
    arrays = ("model_on_model", "ref_on_model", "model_on_ref", "ref_on_ref")
    sums = rows.withColumns({f"_{a}": _sum(a) for a in arrays})
    mine = F.col("chosen_is_model")
    pick = lambda yes, no, test: F.when(test, F.col(yes)).otherwise(F.col(no))
    sums = sums.withColumns(
        {
            "_cm": pick("_model_on_model", "_model_on_ref", mine),
            "_cr": pick("_ref_on_model", "_ref_on_ref", mine),
            "_rm": pick("_model_on_model", "_model_on_ref", ~mine),
            "_rr": pick("_ref_on_model", "_ref_on_ref", ~mine),
        }
    )
    chosen = F.lit(beta) * (F.col("_cm") - F.col("_cr"))
    rejected = F.lit(beta) * (F.col("_rm") - F.col("_rr"))
    kl = (F.col("_model_on_model") - F.col("_ref_on_model")) + (F.col("_model_on_ref") - F.col("_ref_on_ref"))
    return sums.groupBy(*by).agg(
        F.avg("model_score").alias("objective_model_scores"),
        F.avg("ref_score").alias("objective_ref_scores"),
        F.avg(F.col("model_score") - F.col("ref_score")).alias("objective_scores_margin"),
        (F.avg("_cm") + F.avg("_cr")).alias("logps_chosen"),
        (F.avg("_rm") + F.avg("_rr")).alias("logps_rejected"),
        F.avg(chosen).alias("rewards_chosen"),
        F.avg(rejected).alias("rewards_rejected"),
        (F.avg(kl) / 2).alias("objective_kl"),
        ((F.avg(-F.col("_model_on_model")) + F.avg(-F.col("_model_on_ref"))) / 2).alias("objective_entropy"),
        F.avg(chosen - rejected).alias("rewards_margins"),
        F.avg((chosen - rejected > 0).cast("double")).alias("rewards_accuracies"),
        F.avg(F.col("model_has_eos").cast("double")).alias("val_model_contain_eos_token"),
        F.avg(F.col("ref_has_eos").cast("double")).alias("val_ref_contain_eos_token"),
    )


def mixture_statistics(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Means over prompts with one model and one mixture completion.

    Columns: model_score, mixture_score, probability, model_has_eos,
    mixture_has_eos, and token arrays model_on_model, ref_on_model.
    """
    sums = rows.withColumns({"_m": _sum("model_on_model"), "_r": _sum("ref_on_model")})
    margin = F.col("_m") - F.col("_r")
    return sums.groupBy(*by).agg(
        F.avg("_m").alias("logps_chosen"),
        F.avg("_r").alias("logps_rejected"),
        F.avg("model_score").alias("rewards_chosen"),
        F.avg("mixture_score").alias("rewards_rejected"),
        F.avg("probability").alias("rewards_probabilities"),
        F.avg(-F.col("_m")).alias("objective_entropy"),
        F.avg(margin).alias("rewards_margins"),
        F.avg((margin > 0).cast("double")).alias("rewards_accuracies"),
        F.avg(F.col("model_has_eos").cast("double")).alias("val_model_contain_eos_token"),
        F.avg(F.col("mixture_has_eos").cast("double")).alias("val_ref_contain_eos_token"),
    )


def generation_metrics(rollouts: DataFrame) -> DataFrame:
    """Mean reward per reward function, as (key, value) rows."""
    return rollouts.groupBy(F.concat(F.lit("rewards/"), "reward_name").alias("key")).agg(
        F.avg("reward").alias("value")
    )
