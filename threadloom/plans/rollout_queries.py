"""Rewards, advantages, token masks and rollout statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import models
from threadloom.functions import tokens as tk
from threadloom.functions import vectors as vx
from threadloom.operators import rollouts as ro
from threadloom.plans import inputs
from threadloom.plans.inputs import PAIRS, ROLLOUTS, TOKENS, pairs, rollouts, token_rows, with_
from threadloom.plans.preference_queries import join_columns, rounded, text_of
from threadloom.plans.registry import query

TOTALS = "totals AS (SELECT group_id, gen_no, sum(reward) AS reward FROM rollouts GROUP BY 1, 2)"

# Token ids of a document double as toy log-probabilities.
END = 9
LOGPS = """
logs AS (
  SELECT doc_id, lang, ids, length(lang || CAST(doc_id AS VARCHAR)) / 2.0::DOUBLE AS score,
    list_transform(ids, lambda x: -(x % 7) / 10.0::DOUBLE) AS p, list_transform(ids, lambda x: -(x % 5) / 10.0::DOUBLE) AS r FROM tokens)"""


def logs(spark, sf_dir):
    return token_rows(spark, sf_dir).select(
        "doc_id",
        "lang",
        "ids",
        (F.length(F.concat("lang", F.col("doc_id").cast("string"))) / F.lit(2.0)).alias("score"),
        F.transform("ids", lambda x: -(x % 7) / F.lit(10.0)).alias("p"),
        F.transform("ids", lambda x: -(x % 5) / F.lit(10.0)).alias("r"),
    )


@query(
    "e6_total_rewards",
    with_(ROLLOUTS, TOTALS) + "SELECT group_id, gen_no, round(reward, 6) AS reward FROM totals",
)
def e6(spark, sf_dir):
    return rounded(ro.total_rewards(rollouts(spark, sf_dir)), ["group_id", "gen_no"])


@query(
    "e7_group_advantages",
    """WITH s AS (SELECT user_id, avg(value) AS m, stddev_samp(value) AS d FROM events GROUP BY 1)
SELECT event_id, round((value - m) / (d + 1e-4), 6) AS advantage FROM events JOIN s USING (user_id)""",
)
def e7(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return rounded(ro.group_advantages(events, "user_id", "value").select("event_id", "advantage"), ["event_id"])


@query(
    "e7_completion_advantages",
    with_(ROLLOUTS, TOTALS, "s AS (SELECT group_id, avg(reward) AS m, stddev_samp(reward) AS d FROM totals GROUP BY 1)")
    + "SELECT group_id, gen_no, round((reward - m) / (d + 1e-4), 6) AS advantage FROM totals JOIN s USING (group_id)",
)
def e7_completions(spark, sf_dir):
    rewards = ro.total_rewards(rollouts(spark, sf_dir))
    keys = ["group_id", "gen_no"]
    return rounded(ro.group_advantages(rewards).select(*keys, "advantage"), keys)


@query(
    "e8_leave_one_out",
    """WITH s AS (SELECT user_id, sum(value) AS t, count(*) AS k FROM events GROUP BY 1)
SELECT event_id, CASE WHEN k > 1 THEN round((t - value) / (k - 1), 9) END AS baseline,
  CASE WHEN k > 1 THEN round(value - (t - value) / (k - 1), 9) END AS advantage FROM events JOIN s USING (user_id)""",
)
def e8(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    done = ro.leave_one_out(events, "user_id", "value").select("event_id", "baseline", "advantage")
    return done.withColumns({c: F.round(c, 9) for c in ("baseline", "advantage")})


@query(
    "e9_whitened_scores",
    """SELECT event_id, round(least(greatest((value - (SELECT avg(value) FROM events)) / ((SELECT stddev_samp(value) FROM events) + 1e-8), -1.5), 1.5), 6) AS score
FROM events""",
)
def e9(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(ro.whiten(events, "value", "score", clip=1.5).select("event_id", "score"), ["event_id"])


@query(
    "e10_sequence_reward",
    with_(TOKENS, LOGPS) + "SELECT doc_id, round(score - 0.05 * (list_sum(p) - list_sum(r)), 6) AS reward FROM logs",
)
def e10(spark, sf_dir):
    reward = ro.sequence_reward(F.col("score"), F.col("p"), F.col("r"), 0.05)
    return logs(spark, sf_dir).select("doc_id", F.round(reward, 6).alias("reward"))


@query(
    "e11_token_rewards",
    with_(TOKENS, LOGPS, "t AS (SELECT doc_id, score, unnest(p) AS p, unnest(r) AS r, generate_subscripts(p, 1) AS i, len(p) AS n FROM logs)")
    + """SELECT doc_id, i - 1 AS position, round(-0.05 * (p - r) + CASE WHEN i = n THEN score ELSE 0 END, 6) + 0.0 AS reward FROM t""",
)
def e11(spark, sf_dir):
    rewards = ro.token_rewards(F.col("score"), F.col("p"), F.col("r"), 0.05)
    rows = logs(spark, sf_dir).select("doc_id", F.posexplode(rewards).alias("position", "reward"))
    return rows.select("doc_id", F.col("position").cast("bigint").alias("position"), (F.round("reward", 6) + 0.0).alias("reward"))


GAMMA, LAM = 0.99, 0.95


@query(
    "e12_reverse_scan",
    with_(
        TOKENS,
        LOGPS,
        f"""t AS (SELECT doc_id, len(p) AS n, unnest(p) AS rew, unnest(r) AS val, generate_subscripts(p, 1) - 1 AS i FROM logs),
    d AS (SELECT doc_id, i, n, val, rew + {GAMMA} * coalesce(lead(val) OVER (PARTITION BY doc_id ORDER BY i), 0) - val AS delta FROM t)""",
    )
    + f"""SELECT doc_id, round(sum(delta * pow({GAMMA} * {LAM}, i)), 6) AS first_advantage,
  round(sum(delta * (1 - pow({GAMMA} * {LAM}, i + 1)) / (1 - {GAMMA} * {LAM})), 5) AS advantage_sum,
  round(sum(delta * (1 - pow({GAMMA} * {LAM}, i + 1)) / (1 - {GAMMA} * {LAM})) + sum(val), 5) AS return_sum
FROM d GROUP BY 1""",
)
def e12(spark, sf_dir):
    rows = logs(spark, sf_dir).select("doc_id", F.col("p").alias("rewards"), F.col("r").alias("values"))
    done = ro.returns_and_advantages(rows, "rewards", "values", GAMMA, LAM)
    return done.select(
        "doc_id",
        F.round(F.col("advantages")[0], 6).alias("first_advantage"),
        F.round(vx.array_sum(F.col("advantages")), 5).alias("advantage_sum"),
        F.round(vx.array_sum(F.col("returns")), 5).alias("return_sum"),
    )


@query(
    "e13_missing_eos_penalty",
    with_(TOKENS, LOGPS) + f"SELECT doc_id, CASE WHEN list_contains(ids, {END}) THEN score ELSE score - 1.5 END AS score FROM logs",
)
def e13(spark, sf_dir):
    penalised = ro.missing_eos_penalty(F.col("score"), F.col("ids"), END, 1.5)
    return logs(spark, sf_dir).select("doc_id", penalised.alias("score"))


def two_completions(spark, sf_dir):
    """Two generations per order: its lines 1 and 2."""
    lines = inputs.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_quantity").alias("score"), F.max(F.col("l_partkey").cast("string")).alias("completion")
    )
    side = lambda n: lines.filter(F.col("l_linenumber") == n).drop("l_linenumber")
    return side(1), side(2)


TWO = """
gens AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS score, max(CAST(l_partkey AS VARCHAR)) AS completion FROM lineitem GROUP BY 1, 2),
both_ AS (SELECT a.l_orderkey, a.score AS s1, a.completion AS c1, b.score AS s2, b.completion AS c2
  FROM gens a JOIN gens b ON b.l_orderkey = a.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2)"""


def best_sql(test: str) -> str:
    pick = lambda a, b: f"CASE WHEN {test} THEN {a} ELSE {b} END"
    return with_(TWO) + f"""SELECT l_orderkey, {pick('c1', 'c2')} AS chosen, {pick('c2', 'c1')} AS rejected,
  {pick('s1', 's2')} AS chosen_score, {pick('s2', 's1')} AS rejected_score FROM both_"""


@query("e14_best_of_two", best_sql("s1 >= s2"))
def e14(spark, sf_dir):
    return ro.best_of_two(*two_completions(spark, sf_dir), ["l_orderkey"], ro.by_score())


@query("j4_judged_best_of_two", best_sql("length(c1) >= length(c2)"))
def j4(spark, sf_dir):
    judge = models.judge_pairs(models.longer_is_better)
    rank = judge(F.col("l_orderkey").cast("string"), F.col("completion_1"), F.col("completion_2"))
    return ro.best_of_two(*two_completions(spark, sf_dir), ["l_orderkey"], rank == 0)


@query(
    "e15_completion_mask",
    with_(TOKENS)
    + f"""SELECT doc_id, {text_of('list_transform(ids, lambda x, i: CAST(i <= stop AS INT))')} AS mask
FROM (SELECT *, coalesce(nullif(list_position(ids, {END}), 0), len(ids)) AS stop FROM tokens)""",
)
def e15(spark, sf_dir):
    rows = token_rows(spark, sf_dir)
    return join_columns(rows.select("doc_id", tk.completion_mask(F.col("ids"), END).alias("mask")), "doc_id")


@query(
    "e16_kl_estimate",
    with_(TOKENS, LOGPS, f"""t AS (SELECT doc_id, unnest(p) AS p, unnest(r) AS r, generate_subscripts(p, 1) AS i,
  coalesce(nullif(list_position(ids, {END}), 0), len(ids)) AS stop FROM logs)""")
    + "SELECT doc_id, round(avg(exp(r - p) - (r - p) - 1), 6) AS mean_kl FROM t WHERE i <= stop GROUP BY 1",
)
def e16(spark, sf_dir):
    mean = ro.masked_mean(ro.kl_estimates(F.col("p"), F.col("r")), tk.completion_mask(F.col("ids"), END))
    return logs(spark, sf_dir).select("doc_id", F.round(mean, 6).alias("mean_kl"))


def whiten_sql(shift: bool) -> str:
    added = "" if shift else " + m"
    return with_(
        TOKENS,
        LOGPS,
        f"""t AS (SELECT doc_id, unnest(p) AS p, generate_subscripts(p, 1) AS i, coalesce(nullif(list_position(ids, {END}), 0), len(ids)) AS stop FROM logs),
    s AS (SELECT avg(p) AS m, var_samp(p) AS v FROM t WHERE i <= stop)""",
    ) + f"""SELECT doc_id, round(sum(((p - m) / sqrt(v + 1e-8){added}) * i) / sum(i), 6) AS weighted, round(max((p - m) / sqrt(v + 1e-8){added}), 6) AS top
FROM t, s GROUP BY 1"""


def whiten_query(shift: bool):
    def run(spark, sf_dir):
        rows = logs(spark, sf_dir).select("doc_id", "p", tk.completion_mask(F.col("ids"), END).alias("mask"))
        done = ro.masked_whiten(rows, "p", "mask", "w", shift_mean=shift)
        placed, n = F.transform("w", lambda x, i: x * (i + 1)), F.size("w").cast("double")
        return done.select(
            "doc_id",
            F.round(vx.array_sum(placed) / (n * (n + 1) / 2), 6).alias("weighted"),
            F.round(F.array_max("w"), 6).alias("top"),
        )

    return run


query("e17_masked_whiten", whiten_sql(True))(whiten_query(True))
query("e17_masked_whiten_keep_mean", whiten_sql(False))(whiten_query(False))


@query(
    "e18_cut_at_stop",
    with_(TOKENS)
    + f"""SELECT doc_id, {text_of('list_transform(ids, lambda x, i: CASE WHEN i <= stop THEN x ELSE 0 END)')} AS ids
FROM (SELECT *, coalesce(nullif(list_position(ids, {END}), 0), len(ids)) AS stop FROM tokens)""",
)
def e18(spark, sf_dir):
    rows = token_rows(spark, sf_dir)
    return join_columns(rows.select("doc_id", tk.cut_at_stop(F.col("ids"), END, 0).alias("ids")), "doc_id")


@query(
    "e19_fill_past_length",
    with_(TOKENS, LOGPS)
    + """SELECT doc_id, round(list_sum(list_transform(p, lambda x, i: CASE WHEN i - 1 > len(p) // 2 THEN 1.0 ELSE x END)), 6) AS filled_sum FROM logs""",
)
def e19(spark, sf_dir):
    filled = tk.fill_past(F.col("p"), F.floor(F.size("p") / F.lit(2)), 1.0)
    return logs(spark, sf_dir).select("doc_id", F.round(vx.array_sum(filled), 6).alias("filled_sum"))


@query(
    "e20_masked_logps",
    with_(TOKENS, LOGPS, "t AS (SELECT doc_id, unnest(ids) AS x, unnest(p) AS p FROM logs)")
    + """SELECT doc_id, round(sum(CASE WHEN x > 3 THEN p ELSE 0 END), 6) + 0.0 AS total, round(avg(p) FILTER (x > 3), 6) + 0.0 AS mean FROM t GROUP BY 1""",
)
def e20(spark, sf_dir):
    labels = F.transform("ids", lambda x: F.when(x > 3, x).otherwise(tk.IGNORED_LABEL))
    return logs(spark, sf_dir).select(
        "doc_id",
        (F.round(tk.masked_reduce(F.col("p"), labels), 6) + 0.0).alias("total"),
        (F.round(tk.masked_reduce(F.col("p"), labels, average=True), 6) + 0.0).alias("mean"),
    )


@query(
    "h17_density_ratio",
    "SELECT event_id, round(least(greatest(p / (1 - p + 1e-8), 0.5), 10), 6) AS weight FROM (SELECT event_id, (event_id * 37 % 1000) / 1000.0::DOUBLE AS p FROM events)",
)
def h17(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    prob = (F.col("event_id") * 37 % 1000) / F.lit(1000.0)
    return events.select("event_id", F.round(vx.density_ratio(prob), 6).alias("weight"))


@query(
    "j5_reward_functions",
    """SELECT doc_id, 'length' AS reward_name, CAST(length(text) AS DOUBLE) AS reward FROM documents
UNION ALL SELECT doc_id, 'starts_with_lang', CASE WHEN starts_with(text, lang) THEN 1.0 ELSE 0.0 END FROM documents""",
)
def j5(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    rewards = {
        "length": lambda completions, **_: F.length(completions),
        "starts_with_lang": lambda completions, lang, **_: F.startswith(completions, lang),
    }
    return models.reward_table(docs, rewards, ["doc_id"], completions=F.col("text"), lang=F.col("lang"))


@query(
    "d17_reward_means",
    with_(ROLLOUTS) + "SELECT 'rewards/' || reward_name AS key, round(avg(reward), 6) AS value FROM rollouts GROUP BY 1",
)
def d17_rewards(spark, sf_dir):
    return rounded(ro.generation_metrics(rollouts(spark, sf_dir)), ["key"])


# --- statistics of a rollout log: the two turns after a user turn are completions -------------

LOG_PAIRS = """
log_pairs AS (
  SELECT pair_id, pair_id % 2 AS part, length(chosen) / 10.0::DOUBLE AS chosen_score, length(rejected) / 10.0::DOUBLE AS rejected_score,
    list_transform(string_split(chosen, ' '), lambda w: length(w) % 7) AS cw, list_transform(string_split(rejected, ' '), lambda w: length(w) % 7) AS rw
  FROM pairs),
sums AS (
  SELECT *, list_sum(list_transform(cw, lambda x: -x / 8.0::DOUBLE)) AS cp, list_sum(list_transform(cw, lambda x: -(x % 5) / 8.0::DOUBLE)) AS cr,
    list_sum(list_transform(rw, lambda x: -x / 8.0::DOUBLE)) AS rp, list_sum(list_transform(rw, lambda x: -(x % 5) / 8.0::DOUBLE)) AS rr,
    CAST(list_contains(cw, 6) AS INT) AS ce, CAST(list_contains(rw, 6) AS INT) AS re FROM log_pairs)"""


def log_pairs(spark, sf_dir):
    words = lambda c: F.transform(F.split(c, " ", -1), lambda w: F.length(w) % 7)
    base = pairs(spark, sf_dir).select(
        (F.col("pair_id") % 2).alias("part"),
        (F.length("chosen") / F.lit(10.0)).alias("chosen_score"),
        (F.length("rejected") / F.lit(10.0)).alias("rejected_score"),
        words("chosen").alias("cw"),
        words("rejected").alias("rw"),
    )
    policy = lambda c: F.transform(c, lambda x: -x / F.lit(8.0))
    reference = lambda c: F.transform(c, lambda x: -(x % 5) / F.lit(8.0))
    return base.select(
        "part", "chosen_score", "rejected_score",
        policy("cw").alias("chosen_logps"), reference("cw").alias("chosen_ref_logps"),
        policy("rw").alias("rejected_logps"), reference("rw").alias("rejected_ref_logps"),
        F.array_contains("cw", 6).alias("chosen_has_eos"), F.array_contains("rw", 6).alias("rejected_has_eos"),
    )


@query(
    "d18_online_pair_statistics",
    with_(PAIRS, LOG_PAIRS)
    + """SELECT part, round(avg(chosen_score - rejected_score), 6) AS objective_scores_margin,
  round(avg((chosen_score + rejected_score) / 2), 6) AS objective_scores, round(avg((ce + re) / 2), 6) AS val_contain_eos_token,
  round(avg(cp), 6) AS logps_chosen, round(avg(rp), 6) AS logps_rejected, round(avg((cp - cr + rp - rr) / 2), 6) AS objective_kl,
  round(avg(-0.1 * (cp - cr + rp - rr) / 2), 6) AS objective_non_score_reward,
  round(avg((chosen_score + rejected_score - 0.1 * (cp - cr + rp - rr)) / 2), 6) AS objective_rlhf_reward,
  round(avg(-(cp + rp) / 2), 6) AS objective_entropy, round(avg(0.1 * (cp - cr)), 6) AS rewards_chosen,
  round(avg(0.1 * (rp - rr)), 6) AS rewards_rejected, round(avg(0.1 * (cp - cr) - 0.1 * (rp - rr)), 6) AS rewards_margins,
  round(avg(CASE WHEN cp - cr > rp - rr THEN 1.0 ELSE 0.0 END), 6) AS rewards_accuracies FROM sums GROUP BY 1""",
)
def d18_online(spark, sf_dir):
    return rounded(ro.online_pair_statistics(log_pairs(spark, sf_dir), 0.1, by=["part"]), ["part"])


@query(
    "d18_exploration_statistics",
    with_(PAIRS, LOG_PAIRS, """x AS (SELECT *, chosen_score >= rejected_score AS mine FROM sums),
y AS (SELECT *, CASE WHEN mine THEN cp ELSE rp END AS cm, CASE WHEN mine THEN cr ELSE rr END AS cref,
  CASE WHEN mine THEN rp ELSE cp END AS rm, CASE WHEN mine THEN rr ELSE cr END AS rref FROM x)""")
    + """SELECT part, round(avg(chosen_score), 6) AS objective_model_scores, round(avg(rejected_score), 6) AS objective_ref_scores,
  round(avg(chosen_score - rejected_score), 6) AS objective_scores_margin, round(avg(cm) + avg(cref), 6) AS logps_chosen,
  round(avg(rm) + avg(rref), 6) AS logps_rejected, round(avg(0.1 * (cm - cref)), 6) AS rewards_chosen, round(avg(0.1 * (rm - rref)), 6) AS rewards_rejected,
  round(avg((cp - cr) + (rp - rr)) / 2, 6) AS objective_kl, round((avg(-cp) + avg(-rp)) / 2, 6) AS objective_entropy,
  round(avg(0.1 * (cm - cref) - 0.1 * (rm - rref)), 6) AS rewards_margins,
  round(avg(CASE WHEN cm - cref > rm - rref THEN 1.0 ELSE 0.0 END), 6) AS rewards_accuracies,
  round(avg(ce), 6) AS val_model_contain_eos_token, round(avg(re), 6) AS val_ref_contain_eos_token FROM y GROUP BY 1""",
)
def d18_exploration(spark, sf_dir):
    rows = log_pairs(spark, sf_dir).select(
        "part",
        F.col("chosen_score").alias("model_score"),
        F.col("rejected_score").alias("ref_score"),
        (F.col("chosen_score") >= F.col("rejected_score")).alias("chosen_is_model"),
        F.col("chosen_has_eos").alias("model_has_eos"),
        F.col("rejected_has_eos").alias("ref_has_eos"),
        F.col("chosen_logps").alias("model_on_model"),
        F.col("chosen_ref_logps").alias("ref_on_model"),
        F.col("rejected_logps").alias("model_on_ref"),
        F.col("rejected_ref_logps").alias("ref_on_ref"),
    )
    return rounded(ro.exploration_statistics(rows, 0.1, by=["part"]), ["part"])


@query(
    "d18_mixture_statistics",
    with_(PAIRS, LOG_PAIRS)
    + """SELECT part, round(avg(cp), 6) AS logps_chosen, round(avg(cr), 6) AS logps_rejected, round(avg(chosen_score), 6) AS rewards_chosen,
  round(avg(rejected_score), 6) AS rewards_rejected, round(avg(chosen_score / (chosen_score + rejected_score)), 6) AS rewards_probabilities,
  round(avg(-cp), 6) AS objective_entropy, round(avg(cp - cr), 6) AS rewards_margins,
  round(avg(CASE WHEN cp > cr THEN 1.0 ELSE 0.0 END), 6) AS rewards_accuracies,
  round(avg(ce), 6) AS val_model_contain_eos_token, round(avg(re), 6) AS val_ref_contain_eos_token FROM sums GROUP BY 1""",
)
def d18_mixture(spark, sf_dir):
    rows = log_pairs(spark, sf_dir).select(
        "part",
        F.col("chosen_score").alias("model_score"),
        F.col("rejected_score").alias("mixture_score"),
        (F.col("chosen_score") / (F.col("chosen_score") + F.col("rejected_score"))).alias("probability"),
        F.col("chosen_has_eos").alias("model_has_eos"),
        F.col("rejected_has_eos").alias("mixture_has_eos"),
        F.col("chosen_logps").alias("model_on_model"),
        F.col("chosen_ref_logps").alias("ref_on_model"),
    )
    return rounded(ro.mixture_statistics(rows, by=["part"]), ["part"])
