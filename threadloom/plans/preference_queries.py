"""Preference tables, packing, labels and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import models
from threadloom.functions import text as tx
from threadloom.functions import tokens as tk
from threadloom.operators import ordering, preferences as pf
from threadloom.plans import inputs
from threadloom.plans.inputs import PAIRS, TOKENS, pairs, token_rows, with_, word_ids_sql
from threadloom.plans.registry import query

EOS, BOS = 2, 1

# Pairs as token ids in SQL.
PAIR_IDS = f"""
pair_ids AS (
  SELECT pair_id, {word_ids_sql('prompt')} AS p, {word_ids_sql('chosen')} AS c, {word_ids_sql('rejected')} AS r
  FROM pairs)"""


def joined(ids) -> F.Column:
    return F.array_join(ids.cast("array<string>"), " ")


def join_columns(df, *keys):
    """Array columns as texts."""
    return df.select(*keys, *[joined(F.col(c)).alias(c) for c in df.columns if c not in keys])


def text_of(sql: str) -> str:
    return f"array_to_string({sql}, ' ')"


@query(
    "g2_unpair",
    with_(PAIRS)
    + """SELECT pair_id, prompt, chosen AS completion, true AS label FROM pairs
UNION ALL SELECT pair_id, prompt, rejected, false FROM pairs""",
)
def g2(spark, sf_dir):
    return pf.unpair(pairs(spark, sf_dir))


@query(
    "g3_stack_and_pad",
    with_(
        PAIRS,
        PAIR_IDS,
        f"""sized AS (SELECT pair_id, p, list_append(c, {EOS}) AS c, list_append(r, {EOS}) AS r, pair_id // 8 AS batch FROM pair_ids),
    longest AS (SELECT batch, max(greatest(len(c), len(r))) AS n FROM sized GROUP BY 1),
    roles AS (SELECT pair_id, batch, p, 'chosen' AS role, c AS ids FROM sized UNION ALL SELECT pair_id, batch, p, 'rejected', r FROM sized)""",
    )
    + f"""SELECT pair_id, role, {text_of('p')} AS prompt_input_ids,
  {text_of('list_resize(ids, n, 0)')} AS completion_input_ids,
  {text_of('list_resize(list_transform(ids, lambda x: 1), n, 0)')} AS completion_attention_mask
FROM roles JOIN longest USING (batch)""",
)
def g3(spark, sf_dir):
    ids = pf.tokenize_preferences(pairs(spark, sf_dir), EOS)
    batched = ids.withColumn("batch", F.floor(F.col("pair_id") / 8))
    return join_columns(pf.stack_pairs(batched, "batch").drop("batch", "role_no"), "pair_id", "role")


MESSAGE_PAIRS = """
SELECT pair_id, '<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt,
  chosen || '<|im_end|>' || chr(10) AS chosen, rejected || '<|im_end|>' || chr(10) AS rejected FROM pairs"""


def message_pairs(spark, sf_dir):
    user = tx.message("user", F.col("prompt"))
    reply = lambda c: F.array(user, tx.message("assistant", F.col(c)))
    return pairs(spark, sf_dir).select("pair_id", reply("chosen").alias("chosen"), reply("rejected").alias("rejected"))


@query(
    "k14_extract_prompt",
    with_(PAIRS)
    + """SELECT pair_id, CASE WHEN chosen IS NOT NULL THEN 1 END AS n_prompt, 'user: ' || prompt AS prompt,
  chosen, rejected FROM pairs""",
)
def k14(spark, sf_dir):
    split = pf.extract_prompt(message_pairs(spark, sf_dir))
    return split.select(
        "pair_id",
        F.size("prompt").alias("n_prompt"),
        F.concat(F.col("prompt")[0]["role"], F.lit(": "), F.col("prompt")[0]["content"]).alias("prompt"),
        F.array_join(F.transform("chosen", lambda m: m["content"]), "|").alias("chosen"),
        F.array_join(F.transform("rejected", lambda m: m["content"]), "|").alias("rejected"),
    )


@query("k15_chat_template", with_(PAIRS) + MESSAGE_PAIRS)
def k15(spark, sf_dir):
    return pf.apply_chat_template(pf.extract_prompt(message_pairs(spark, sf_dir))).select(
        "pair_id", "prompt", "chosen", "rejected"
    )


@query(
    "k12_tokenize_truncate",
    f"SELECT doc_id, {text_of(word_ids_sql('text') + '[1:512]')} AS input_ids FROM documents",
)
def k12(spark, sf_dir):
    docs = inputs.spread(spark, sf_dir, "documents")
    ids = pf.tokenize_texts(docs, "text", 512, keys=["doc_id"])
    return join_columns(ids.drop("attention_mask"), "doc_id")


@query(
    "j6_formatting_function",
    f"SELECT doc_id, {text_of(word_ids_sql(chr(39) + '### ' + chr(39) + ' || lang || ' + chr(39) + ' ' + chr(39) + ' || text'))} AS input_ids FROM documents",
)
def j6(spark, sf_dir):
    docs = inputs.spread(spark, sf_dir, "documents")
    form = lambda: F.concat(F.lit("### "), "lang", F.lit(" "), "text")
    return join_columns(pf.tokenize_texts(docs, keys=["doc_id"], formatting=form).drop("attention_mask"), "doc_id")


@query(
    "k13_pack",
    with_(
        TOKENS,
        """laid AS (SELECT doc_id, unnest(list_append(ids, 0)) AS t, generate_subscripts(list_append(ids, 0), 1) AS i FROM tokens),
    placed AS (SELECT t, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos FROM laid)""",
    )
    + """SELECT pos // 1024 AS block, string_agg(CAST(t AS VARCHAR), ' ' ORDER BY pos) AS input_ids
FROM placed GROUP BY 1 HAVING count(*) = 1024""",
)
def k13(spark, sf_dir):
    rows = token_rows(spark, sf_dir).withColumnRenamed("ids", "input_ids")
    return join_columns(pf.pack(rows, "doc_id", 1024, eos=0), "block")


TEMPLATE = (2, 3)


@query(
    "k11_completion_labels",
    with_(
        TOKENS,
        f"""hits AS (SELECT *, list_max(list_filter(range(1, len(ids)), lambda i: ids[i] = {TEMPLATE[0]} AND ids[i + 1] = {TEMPLATE[1]})) AS last_hit FROM tokens)""",
    )
    + f"""SELECT doc_id, {text_of("list_transform(ids, lambda x, i: CASE WHEN i <= coalesce(last_hit + 1, len(ids)) THEN -100 ELSE x END)")} AS labels
FROM hits""",
)
def k11(spark, sf_dir):
    rows = token_rows(spark, sf_dir).select("doc_id", F.col("ids").alias("input_ids"))
    return join_columns(pf.completion_labels(rows, TEMPLATE).drop("input_ids"), "doc_id")


@query(
    "h18_token_slices",
    with_(TOKENS)
    + f"""SELECT doc_id, {text_of('ids[1:5]')} AS first_ids, {text_of('ids[-5:]')} AS last_ids,
  {text_of('list_append(ids, 2)')} AS ended, {text_of('CASE WHEN ids[1] = 1 THEN ids ELSE list_prepend(1, ids) END')} AS begun
FROM tokens""",
)
def h18(spark, sf_dir):
    ids = F.col("ids")
    return join_columns(
        token_rows(spark, sf_dir).select(
            "doc_id",
            tk.keep_first(ids, 5).alias("first_ids"),
            tk.keep_last(ids, 5).alias("last_ids"),
            tk.with_eos(ids, 2).alias("ended"),
            tk.with_bos_if_missing(ids, 1).alias("begun"),
        ),
        "doc_id",
    )


@query(
    "k16_preference_tokens",
    with_(PAIRS, PAIR_IDS)
    + f"""SELECT pair_id, {text_of('p[-24:]')} AS prompt_input_ids, {text_of(f'list_append(c, {EOS})[1:32]')} AS chosen_input_ids,
  {text_of(f'list_append(r, {EOS})[1:32]')} AS rejected_input_ids FROM pair_ids""",
)
def k16(spark, sf_dir):
    ids = pf.tokenize_preferences(
        pairs(spark, sf_dir), EOS, max_prompt_length=24, max_completion_length=32
    )
    return join_columns(ids, "pair_id")


BUDGET = dict(max_length=64, max_prompt_length=24)


def budget_sql(mode: str) -> str:
    n = BUDGET["max_prompt_length"]
    cut = f"pp[1:{n}]" if mode == "keep_start" else f"pp[-{n}:]"
    return with_(
        PAIRS,
        PAIR_IDS,
        f"""marked AS (SELECT pair_id, list_prepend({BOS}, p) AS pp, list_append(c, {EOS}) AS c, list_append(r, {EOS}) AS r FROM pair_ids),
    sized AS (SELECT *, greatest(len(c), len(r)) AS longer FROM marked),
    cut AS (SELECT pair_id, longer, c, r, CASE WHEN len(pp) + longer > {BUDGET['max_length']} THEN {cut} ELSE pp END AS pp FROM sized),
    final AS (SELECT pair_id, pp,
      CASE WHEN len(pp) + longer > {BUDGET['max_length']} THEN c[1:{BUDGET['max_length'] - n}] ELSE c END AS c,
      CASE WHEN len(pp) + longer > {BUDGET['max_length']} THEN r[1:{BUDGET['max_length'] - n}] ELSE r END AS r FROM cut)""",
    ) + f"""SELECT pair_id, {text_of('pp')} AS prompt_input_ids, {text_of('list_concat(pp, c)')} AS chosen_input_ids,
  {text_of('list_concat(pp, r)')} AS rejected_input_ids,
  {text_of('list_concat(list_transform(pp, lambda x: -100), c)')} AS chosen_labels,
  {text_of('list_concat(list_transform(pp, lambda x: -100), r)')} AS rejected_labels FROM final"""


def budget_query(mode: str):
    def run(spark, sf_dir):
        rows = pf.tokenize_with_budget(pairs(spark, sf_dir), EOS, BOS, truncation_mode=mode, **BUDGET)
        masks = [c for c in rows.columns if c.endswith("attention_mask")]
        return join_columns(rows.drop(*masks), "pair_id")

    return run


for _mode in pf.TRUNCATION_MODES:
    query(f"k17_length_budget_{_mode}", budget_sql(_mode))(budget_query(_mode))


def split_words():
    """Small word tokenizer for the joint UDF: words hashed like the built-in one."""
    import hashlib

    return lambda text: [int(hashlib.md5(w.encode()).hexdigest()[:15], 16) for w in text.split(" ") if w]


@query(
    "k18_joint_answer_tokens",
    with_(
        PAIRS,
        f"""ids AS (SELECT pair_id, {word_ids_sql('prompt')} AS p, {word_ids_sql('prompt || chosen')} AS whole FROM pairs),
    cuts AS (SELECT *, CASE WHEN whole[1:len(p)] = p THEN len(p) ELSE len(p) - 1 END AS n FROM ids)""",
    )
    + f"SELECT pair_id, {text_of('whole[1:n]')} AS prompt_ids, {text_of('whole[n + 1:]')} AS answer_ids FROM cuts",
)
def k18(spark, sf_dir):
    split = models.joint_answer_tokens(split_words)
    rows = pairs(spark, sf_dir).select("pair_id", split(F.col("prompt"), F.col("chosen")).alias("s"))
    return join_columns(rows.select("pair_id", "s.prompt_ids", "s.answer_ids"), "pair_id")


UNPAIRED = (
    PAIRS,
    "rendered AS (" + MESSAGE_PAIRS + ")",
    """rows_ AS (SELECT pair_id * 2 AS row_id, prompt, chosen AS completion, true AS label FROM rendered
    UNION ALL SELECT pair_id * 2 + 1, prompt, rejected, false FROM rendered),
    numbered AS (SELECT *, (row_number() OVER (ORDER BY row_id) - 1) // 4 AS batch FROM rows_),
    lasts AS (SELECT batch, arg_max(completion, row_id) AS last_completion FROM numbered GROUP BY 1),
    shifted AS (SELECT n.row_id, coalesce(lag(n.completion) OVER (PARTITION BY n.batch ORDER BY n.row_id), l.last_completion) AS kl
      FROM numbered n JOIN lasts l USING (batch))""",
)


def unpaired_sql(name: str, source: str, completion: str) -> str:
    """Token budget of one completion column."""
    return f"""
{name} AS (SELECT row_id, p, CASE WHEN len(p) + len(a) > 62 THEN a[1:38] ELSE a END AS a FROM (
  SELECT row_id, CASE WHEN len(p) + len(a) > 62 THEN p[-24:] ELSE p END AS p, a FROM (
    SELECT row_id, {word_ids_sql('prompt')} AS p, {word_ids_sql(completion)} AS a FROM {source})))"""


@query(
    "k19_unpaired_preparation",
    with_(
        *UNPAIRED,
        "both_ AS (SELECT * FROM rows_ JOIN shifted USING (row_id))",
        unpaired_sql("own", "both_", "completion"),
        unpaired_sql("other", "both_", "kl"),
    )
    + f"""SELECT o.row_id, r.label, {text_of(f'list_concat(list_prepend({BOS}, o.p), list_append(o.a, {EOS}))')} AS completion_input_ids,
  {text_of(f'list_concat(list_transform(list_prepend({BOS}, o.p), lambda x: -100), list_append(o.a, {EOS}))')} AS completion_labels,
  {text_of(f'list_concat(list_prepend({BOS}, k.p), list_append(k.a, {EOS}))')} AS kl_completion_input_ids
FROM own o JOIN other k USING (row_id) JOIN rows_ r USING (row_id)""",
)
def k19(spark, sf_dir):
    rows = pf.prepare_unpaired(message_pairs(spark, sf_dir), "pair_id", EOS, BOS, 64, 24, batch_size=4)
    return join_columns(
        rows.select(
            "row_id", "label", "completion_input_ids", "completion_labels",
            F.col("KL_completion_input_ids").alias("kl_completion_input_ids"),
        ),
        "row_id", "label",
    )


@query(
    "c21_column_merge",
    "SELECT doc_id, lang, n_chars, source FROM documents",
)
def c21(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return pf.merge_columns(docs.select("doc_id", "lang"), docs.select("doc_id", "n_chars", "source"), "doc_id")


@query(
    "c22_reference_scores",
    "SELECT doc_id, lang, CAST(quality AS DOUBLE) AS score FROM documents LEFT JOIN labels USING (doc_id)",
)
def c22(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang")
    scores = inputs.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("score"))
    return pf.reference_scores(docs, scores, "doc_id")


STEP_IDS = word_ids_sql("line")


def steps_sql(last_only: bool) -> str:
    label = "CAST(length(line) % 2 = 0 AS BIGINT)"
    if last_only:
        label = f"CASE WHEN i = n THEN {label} ELSE -100 END"
    return (
        f"""WITH parts AS (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents),
steps AS (SELECT doc_id, lang, len(lines) AS n, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM parts),
ids AS (SELECT doc_id, lang, i, list_append({STEP_IDS}, 13) AS s, {label} AS label FROM steps),
whole AS (SELECT doc_id, lang, list_prepend({BOS}, {word_ids_sql('lang')}) AS p,
  flatten(list(s ORDER BY i)) AS c,
  flatten(list(list_append(list_transform(s[1:len(s) - 1], lambda x: CAST(-100 AS BIGINT)), label) ORDER BY i)) AS l
  FROM ids GROUP BY doc_id, lang)
SELECT doc_id, {text_of('list_concat(p, c[1:2000])[1:1990]')} AS input_ids,
  {text_of('list_concat(list_transform(p, lambda x: CAST(-100 AS BIGINT)), l[1:2000])[1:1990]')} AS labels FROM whole"""
    )


def steps_query(last_only: bool):
    def run(spark, sf_dir):
        docs = inputs.spread(spark, sf_dir, "documents")
        lines = F.split("text", "\n", -1)
        rows = docs.select(
            "doc_id",
            F.col("lang").alias("prompt"),
            lines.alias("completions"),
            F.transform(lines, lambda s: F.length(s) % 2 == 0).alias("labels"),
        )
        steps = pf.stepwise_rows(
            rows, [13], BOS, max_length=1990, max_completion_length=2000, last_step_only=last_only
        )
        return join_columns(steps, "doc_id")

    return run


query("k20_stepwise_labels", steps_sql(False))(steps_query(False))
query("k20_stepwise_last_step", steps_sql(True))(steps_query(True))


@query(
    "k21_prompt_tokens",
    f"SELECT item_id, {text_of(f'list_prepend({BOS}, ' + word_ids_sql('text') + ')')} AS prompt_input_ids FROM benchmark",
)
def k21(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("prompt"))
    return join_columns(pf.tokenize_prompts(items, BOS).drop("prompt_attention_mask"), "item_id")


LABELLED = """
labelled AS (
  SELECT d.doc_id, d.lang AS prompt, d.text AS completion, l.quality = 1 AS label FROM labels l JOIN documents d USING (doc_id))"""


def labelled(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    labels = inputs.table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("label"))
    return docs.join(labels, "doc_id").select(
        "doc_id", F.col("lang").alias("prompt"), F.col("text").alias("completion"), "label"
    )


@query(
    "k23_label_split_preparation",
    with_(LABELLED, "shuffled AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM labelled)")
    + f"""SELECT doc_id, rn, CASE WHEN label THEN 'desirable' ELSE 'undesirable' END AS part,
  len({word_ids_sql('completion')}) AS n_tokens FROM shuffled""",
)
def k23(spark, sf_dir):
    shuffled = ordering.shuffled_position(labelled(spark, sf_dir), "doc_id")
    ids = shuffled.withColumn("n_tokens", F.size(models.word_ids(F.col("completion"))).cast("bigint"))
    good, bad = pf.split_by_label(ids)
    part = lambda df, name: df.select("doc_id", "rn", F.lit(name).alias("part"), "n_tokens")
    return part(good, "desirable").unionByName(part(bad, "undesirable"))


@query("b22_split_by_label", with_(LABELLED) + "SELECT doc_id, CASE WHEN label THEN 'desirable' ELSE 'undesirable' END AS part FROM labelled")
def b22(spark, sf_dir):
    good, bad = pf.split_by_label(labelled(spark, sf_dir))
    return good.select("doc_id", F.lit("desirable").alias("part")).unionByName(
        bad.select("doc_id", F.lit("undesirable").alias("part"))
    )


@query(
    "b21_length_filter",
    with_(PAIRS, PAIR_IDS) + "SELECT pair_id, len(c) AS n_chosen, len(r) AS n_rejected FROM pair_ids WHERE len(c) <= 60 AND len(r) <= 60",
)
def b21(spark, sf_dir):
    ids = pairs(spark, sf_dir).select(
        "pair_id",
        models.word_ids(F.col("chosen")).alias("input_ids_chosen"),
        models.word_ids(F.col("rejected")).alias("input_ids_rejected"),
    )
    return pf.within_length(ids, 60).select(
        "pair_id",
        F.size("input_ids_chosen").cast("bigint").alias("n_chosen"),
        F.size("input_ids_rejected").cast("bigint").alias("n_rejected"),
    )


@query(
    "d14_class_balance",
    with_(
        LABELLED,
        """counts AS (SELECT greatest(count_if(label), 1) AS d, greatest(count(*) - greatest(count_if(label), 1), 1) AS u FROM labelled),
    bounds AS (SELECT d, u, round(u * 1.0 / d, 2) AS dl, round(u * 1.33 / d, 2) AS du, round(d / 1.33 / u, 2) AS ul, round(d * 1.0 / u, 2) AS uu FROM counts)""",
    )
    + """SELECT CAST(d AS BIGINT) AS num_desirable, CAST(u AS BIGINT) AS num_undesirable, CAST(dl AS DOUBLE) AS des_weight_lower_bound, CAST(du AS DOUBLE) AS des_weight_upper_bound,
  CAST(ul AS DOUBLE) AS und_weight_lower_bound, CAST(uu AS DOUBLE) AS und_weight_upper_bound,
  1.0 BETWEEN dl AND du AS des_weight_in_range, 1.0 BETWEEN ul AND uu AS und_weight_in_range FROM bounds""",
)
def d14(spark, sf_dir):
    return pf.class_balance(labelled(spark, sf_dir))


SCORED = """
scored AS (
  SELECT l_orderkey % 2 AS part, -l_quantity AS chosen_logps, -100 * l_discount AS ref_chosen_logps,
    -l_extendedprice / 1000 AS rejected_logps, -100 * l_tax AS ref_rejected_logps FROM lineitem)"""


def scored(spark, sf_dir):
    return inputs.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 2).alias("part"),
        (-F.col("l_quantity")).alias("chosen_logps"),
        (-100 * F.col("l_discount")).alias("ref_chosen_logps"),
        (-F.col("l_extendedprice") / 1000).alias("rejected_logps"),
        (-100 * F.col("l_tax")).alias("ref_rejected_logps"),
    )


def pair_metrics_sql(reference_free: bool) -> str:
    c = "0.1 * chosen_logps" if reference_free else "0.1 * (chosen_logps - ref_chosen_logps)"
    r = "0.1 * rejected_logps" if reference_free else "0.1 * (rejected_logps - ref_rejected_logps)"
    return with_(SCORED) + f"""SELECT part, round(avg({c}), 6) AS rewards_chosen, round(avg({r}), 6) AS rewards_rejected,
  round(avg(CASE WHEN {c} > {r} THEN 1.0 ELSE 0.0 END), 6) AS rewards_accuracies, round(avg({c} - ({r})), 6) AS rewards_margins,
  round(avg(chosen_logps), 6) AS logps_chosen, round(avg(rejected_logps), 6) AS logps_rejected FROM scored GROUP BY 1"""


def rounded(df, keys=()):
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c not in keys})


@query("d15_pair_metrics", pair_metrics_sql(False))
def d15(spark, sf_dir):
    return rounded(pf.pair_metrics(scored(spark, sf_dir), 0.1, by=["part"]), ["part"])


@query("d15_pair_metrics_reference_free", pair_metrics_sql(True))
def d15_free(spark, sf_dir):
    return rounded(pf.pair_metrics(scored(spark, sf_dir), 0.1, reference_free=True, by=["part"]), ["part"])


@query(
    "d16_unpaired_metrics",
    """WITH rows_ AS (SELECT user_id % 3 AS part, event_type IN ('click', 'view') AS label,
  CASE WHEN value < 2 THEN NULL ELSE value / 10 END AS rewards, -value AS logps FROM events)
SELECT part, round(sum(rewards) FILTER (label) / count_if(label), 6) AS rewards_chosen,
  round(sum(rewards) FILTER (NOT label) / count_if(NOT label), 6) AS rewards_rejected,
  round(sum(logps) FILTER (label) / count_if(label), 6) AS logps_chosen,
  round(sum(logps) FILTER (NOT label) / count_if(NOT label), 6) AS logps_rejected,
  round(sum(rewards) FILTER (label) / count_if(label) - sum(rewards) FILTER (NOT label) / count_if(NOT label), 6) AS rewards_margins
FROM rows_ GROUP BY 1""",
)
def d16(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "events").select(
        (F.col("user_id") % 3).alias("part"),
        F.col("event_type").isin("click", "view").alias("label"),
        F.when(F.col("value") < 2, F.lit(float("nan"))).otherwise(F.col("value") / 10).alias("rewards"),
        (-F.col("value")).alias("logps"),
    )
    return rounded(pf.unpaired_metrics(rows, ("rewards", "logps"), by=["part"]), ["part"])


@query(
    "h19_rounding",
    "SELECT event_id, round(value / 3, 2) AS two, round(value / 3, 4) AS four FROM events",
)
def h19(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    return events.select(
        "event_id", F.bround(F.col("value") / 3, 2).alias("two"), F.bround(F.col("value") / 3, 4).alias("four")
    )
