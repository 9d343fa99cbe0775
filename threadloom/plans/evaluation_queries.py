"""Judge prompts, verdicts, model comparison and model tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import models
from threadloom.functions import text as tx
from threadloom.operators import evaluation as ev, mltables as ml, ordering, retrieval as rt, stats
from threadloom.operators.ledger import AnswerLedger
from threadloom.plans import inputs
from threadloom.plans.inputs import POINTS, points, with_
from threadloom.plans.preference_queries import rounded
from threadloom.plans.prompt_queries import lit
from threadloom.plans.registry import query
from threadloom.session import scratch_path


# --- verdicts ---------------------------------------------------------------------------


def verdict_rows(spark, sf_dir):
    """Judge replies of four shapes: fenced, bare, with comments, plain text."""
    docs = inputs.spread(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    body = F.concat(
        F.lit('{"russian_language": "'), "lang", F.lit('", "matching_target_answer": "'), "source",
        F.lit('", "correctness": "'), F.when(F.col("doc_id") % 2 == 0, "да").otherwise("нет"),
        F.lit('", "score": '), (F.col("doc_id") % 6).cast("string"), F.lit("}"),
    )
    shape = F.col("doc_id") % 4
    reply = (
        F.when(shape == 0, F.concat(F.lit("Оценка:\n```json\n"), body, F.lit("\n```\n")))
        .when(shape == 1, body)
        .when(shape == 2, F.concat(F.lit("```json\n"), F.replace(body, F.lit("}"), F.lit(" // ок\n}")), F.lit("\n```")))
        .otherwise(F.concat(F.lit("Оценка "), (F.col("doc_id") % 6).cast("string")))
    )
    return docs.select("doc_id", "lang", reply.alias("reply"))


@query(
    "h10_parse_verdict",
    """SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN lang END AS russian_language,
  CASE WHEN doc_id % 4 < 2 THEN source END AS matching_target_answer,
  CASE WHEN doc_id % 4 < 2 THEN CASE WHEN doc_id % 2 = 0 THEN 'да' ELSE 'нет' END END AS correctness,
  CAST(CASE WHEN doc_id % 4 < 2 THEN doc_id % 6 END AS INTEGER) AS score FROM documents""",
)
def h10(spark, sf_dir):
    return verdict_rows(spark, sf_dir).select(
        "doc_id", tx.parse_verdict(F.col("reply")).alias("v")
    ).select("doc_id", "v.*")


def eval_rows(spark, sf_dir):
    """Evaluation rows: a document asks, its source is the target."""
    return inputs.spread(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("question"),
        F.concat("lang", F.lit(" "), "source").alias("target"),
        F.col("text").alias("prompt_plain"),
        F.concat(F.lit("Контекст "), "source", F.lit("\n"), "text").alias("prompt_context"),
    )


GENERATORS = {"base": models.echo_generator("base: "), "tuned": models.echo_generator("tuned: ")}
PROMPTS = {"plain": "prompt_plain", "context": "prompt_context"}


def answered(spark, sf_dir):
    return ev.answer_rows(eval_rows(spark, sf_dir), GENERATORS, PROMPTS)


ANSWERED = """
answered AS (
  SELECT doc_id AS id, model, variant, text AS question, lang || ' ' || source AS target,
    model || ': ' || CASE WHEN variant = 'plain' THEN text ELSE 'Контекст ' || source || chr(10) || text END AS answer
  FROM documents, (VALUES ('base'), ('tuned')) m(model), (VALUES ('plain'), ('context')) v(variant))"""


@query("m1_answers_per_model", with_(ANSWERED) + "SELECT id, model, variant, answer FROM answered")
def m1(spark, sf_dir):
    return answered(spark, sf_dir).select("id", "model", "variant", "answer")


def judge_prompt_sql() -> str:
    filled = lit(ev.JUDGE_TEMPLATE.replace("{format_instructions}", ev.FORMAT_INSTRUCTIONS))
    # cut at the placeholders, so texts that contain one stay as they are
    for name in ("question", "answer", "target"):
        filled = filled.replace("{" + name + "}", f"' || {name} || '")
    return filled


@query("m2_judge_prompts", with_(ANSWERED) + f"SELECT id, model, variant, {judge_prompt_sql()} AS judge_prompt FROM answered")
def m2(spark, sf_dir):
    return ev.judge_prompts(answered(spark, sf_dir)).select("id", "model", "variant", "judge_prompt")


def canned_judge():
    """Stand-in judge: the prompt's length decides reply shape and score.

    One reply in four is broken at first; a repaired one is good unless the
    length is a multiple of eight.
    """

    def reply(prompt: str) -> str:
        n = len(prompt)
        score = n % 6
        good = (
            '```json\n{"russian_language": "да", "matching_target_answer": "да", '
            f'"correctness": "{"да" if score > 2 else "нет"}", "score": {score}}}\n```'
        )
        if ev.REPAIR_REQUEST in prompt:
            return "нет" if n % 8 == 0 else good
        return "{сломано" if n % 4 == 0 else good

    return lambda prompts: [reply(p) for p in prompts]


JUDGED = f"""
prompts AS (SELECT *, {judge_prompt_sql()} AS judge_prompt FROM answered),
firsts AS (SELECT id, model, variant, length(judge_prompt) AS n FROM prompts),
seconds AS (SELECT *, n + length('<|im_start|>system' || '<|im_end|>' || '<|im_start|>assistant' || '{{сломано' || '<|im_end|>' || '<|im_start|>user'
  || {lit(ev.REPAIR_REQUEST)} || '<|im_end|>' || '<|im_start|>assistant') + 7 AS n2 FROM firsts),
judged AS (SELECT id, model, variant, n % 4 = 0 AS retried,
  CAST(CASE WHEN n % 4 <> 0 THEN n % 6 WHEN n2 % 8 <> 0 THEN n2 % 6 END AS INTEGER) AS score FROM seconds)"""


def judged(spark, sf_dir, ledger=None):
    answers = ev.answer_rows(eval_rows(spark, sf_dir), GENERATORS, PROMPTS, ledger)
    # with a ledger rows are written between the steps, whole texts only in their prompt
    prompts = ev.judge_prompts(answers).select("id", "model", "variant", "judge_prompt")
    return ev.judge(prompts, lambda: canned_judge(), ledger)


@query("m3_verdicts_with_retry", with_(ANSWERED, JUDGED) + "SELECT id, model, variant, retried, score FROM judged")
def m3(spark, sf_dir):
    """Answers and replies are asked for once; the result reads what was kept."""
    ledger = AnswerLedger(spark, scratch_path(spark, "ledger"))
    return judged(spark, sf_dir, ledger).select("id", "model", "variant", "retried", F.col("verdict.score").alias("score"))


FLAT = """
flat AS (SELECT id, model, max(score) FILTER (variant = 'plain') AS score, max(score) FILTER (variant = 'context') AS score_context
  FROM judged GROUP BY 1, 2)"""


def flat(spark, sf_dir):
    return ev.flatten_verdicts(judged(spark, sf_dir), ["id", "model"])


@query(
    "m4_flat_verdicts",
    with_(ANSWERED, JUDGED, FLAT)
    + """SELECT id, model, CASE WHEN score > 2 THEN 'да' WHEN score <= 2 THEN 'нет' END AS correctness,
  CASE WHEN score_context > 2 THEN 'да' WHEN score_context <= 2 THEN 'нет' END AS correctness_context, score, score_context FROM flat""",
)
def m4(spark, sf_dir):
    return flat(spark, sf_dir)


SCORE_ROWS = """
scores AS (SELECT model, variant, CAST(score AS DOUBLE) AS x FROM judged WHERE score IS NOT NULL)"""

SUMMARY = """count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min, max(x) AS max,
  round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.75), 6) AS q75"""


@query("m5_model_comparison", with_(ANSWERED, JUDGED, SCORE_ROWS) + f"SELECT model, variant, {SUMMARY} FROM scores GROUP BY 1, 2")
def m5(spark, sf_dir):
    return rounded(ev.compare_models(ev.score_rows(flat(spark, sf_dir))), ["model", "variant", "count"])


@query(
    "d12_score_histogram",
    with_(
        ANSWERED, JUDGED, SCORE_ROWS,
        """edges AS (SELECT model, variant, min(x) AS lo, max(x) AS hi FROM scores GROUP BY 1, 2),
    filled AS (SELECT model, variant, least(CAST(floor((x - lo) / ((hi - lo) / 10)) AS BIGINT) + 1, 10) AS bin, count(*) AS n
      FROM scores JOIN edges USING (model, variant) GROUP BY 1, 2, 3)""",
    )
    + """SELECT model, variant, bin, round(lo + (bin - 1) * ((hi - lo) / 10), 6) AS bin_start, coalesce(n, 0) AS n
FROM (SELECT * FROM edges, (SELECT unnest(range(1, 11)) AS bin)) LEFT JOIN filled USING (model, variant, bin)""",
)
def d12(spark, sf_dir):
    scores = ev.score_rows(flat(spark, sf_dir))
    return ev.score_histogram(scores).withColumn("bin_start", F.round("bin_start", 6))


@query(
    "c23_rebind_to_rows",
    with_(ANSWERED) + "SELECT id, model, variant, answer, target AS row_target FROM answered",
)
def c23(spark, sf_dir):
    answers = answered(spark, sf_dir).select("id", "model", "variant", "answer")
    rows = eval_rows(spark, sf_dir).select("id", F.col("target").alias("row_target"))
    return ev.attach_to_rows(answers, rows, "id")


RULE = "-" * 88


@query(
    "m6_readable_rows",
    f"""SELECT doc_id AS id, 'QUESTION ' || text || chr(10) || chr(10) || 'CONTEXT ' || coalesce(nullif(source, 'src0'), 'None') || chr(10) || chr(10) || 'TARGET ' || lang
  || chr(10) || chr(10) || 'ANSWER_CONTEXT ' || lang || chr(10) || 'EVALUTION_CONTEXT ' || source || chr(10) || chr(10) || '{RULE}' AS value FROM documents""",
)
def m6(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("question"),
        F.nullif(F.col("source"), F.lit("src0")).alias("context"),
        F.col("lang").alias("target"),
        F.col("lang").alias("answer_context"),
        F.col("source").alias("evalution_context"),
    )
    return ev.readable(rows)


@query(
    "m7_batch_answers",
    f"""SELECT item_id, '<|im_start|>system' || chr(10) || 'S' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
  || '<|im_start|>assistant' || chr(10) AS prompt, 'S' AS system_prompt, text AS user_message, 'echo: ' || text AS model_answer FROM benchmark""",
)
def m7(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "benchmark")
    messages = F.array(tx.message("system", F.lit("S")), tx.message("user", F.col("text")))
    said = models.generate(items, "text", models.echo_generator(), "model_answer")
    return said.select(
        "item_id",
        tx.chat_markup(messages, True).alias("prompt"),
        F.lit("S").alias("system_prompt"),
        F.col("text").alias("user_message"),
        "model_answer",
    )


@query(
    "j3_generator",
    "SELECT conv_id, turn, 'echo: ' || text AS generated, CAST(NULL AS VARCHAR) AS generated_error FROM conversations",
)
def j3(spark, sf_dir):
    turns = inputs.table(spark, sf_dir, "conversations")
    said = models.generate(turns, "text", models.echo_generator())
    return said.select("conv_id", "turn", "generated", "generated_error")


def flaky_generator():
    """Fails on every batch that holds a French text."""

    def run(prompts: list) -> list:
        if any(p.startswith("fr") for p in prompts):
            raise RuntimeError("no answer")
        return list(prompts)

    return run


@query(
    "j8_retry_then_error",
    """SELECT doc_id, CASE WHEN lang <> 'fr' THEN lang || source END AS generated,
  CASE WHEN lang = 'fr' THEN 'RuntimeError: no answer' END AS generated_error FROM documents""",
)
def j8(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", F.concat("lang", "source").alias("prompt"))
    said = models.generate(docs, "prompt", lambda: flaky_generator(), batch_size=1, attempts=2, pause=0.0)
    return said.select("doc_id", "generated", "generated_error")


# --- sample tables -------------------------------------------------------------------------


@query(
    "k22_query_response_score",
    """SELECT item_id, text AS query, 'echo: ' || text AS response, round(CAST(length(text) AS DOUBLE) / (length(text) + 6), 6) AS score
FROM benchmark ORDER BY item_id LIMIT 20""",
)
def k22_scored(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "benchmark")
    return ev.samples_with_scores(items, "text", models.echo_generator(), rt.length_ratio, "item_id", 20)


@query(
    "k22_policy_reference",
    """SELECT text AS prompt, ' a' || item_id AS policy, ' b' || item_id AS ref_model
FROM benchmark ORDER BY md5('42:' || item_id), item_id LIMIT 16""",
)
def k22_policy(spark, sf_dir):
    items = ordering.random_sample(inputs.table(spark, sf_dir, "benchmark"), "item_id", 16)
    said = lambda mark: F.concat("text", F.lit(mark), F.col("item_id").cast("string"))
    rows = items.select("text", said(" a").alias("policy_out"), said(" b").alias("ref_out"))
    return ev.policy_reference_samples(rows, "text", "policy_out", "ref_out")


# --- model tables ---------------------------------------------------------------------------


def vectors(spark, sf_dir):
    return inputs.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("dense"), "label"
    )


@query("l1_clusters")
def l1(spark, sf_dir):
    return ml.cluster(vectors(spark, sf_dir)).select("id", "cluster")


@query("l2_two_components")
def l2(spark, sf_dir):
    return ml.reduce_dimensions(vectors(spark, sf_dir)).select("id", "x0", "x1")


@query("l3_plot_table")
def l3(spark, sf_dir):
    return ml.plot_table(points(spark, sf_dir))


@query("d13_distinct_clusters", "SELECT DISTINCT label AS cluster FROM embeddings")
def d13(spark, sf_dir):
    return vectors(spark, sf_dir).select(F.col("label").alias("cluster")).distinct()


@query(
    "h22_cluster_colour",
    "SELECT vec_id AS id, [" + ", ".join(f"'{c}'" for c in ml.PALETTE) + "][label + 1] AS fill_color FROM embeddings",
)
def h22(spark, sf_dir):
    return vectors(spark, sf_dir).select("id", ml.colour_of("label").alias("fill_color"))


def labelled_vectors(spark, sf_dir):
    labels = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return vectors(spark, sf_dir).drop("label").join(labels, "id")


@query("l4_desirable_probability")
def l4(spark, sf_dir):
    rows = labelled_vectors(spark, sf_dir)
    return ml.DensityRatioClassifier.fit(rows).desirable_probability(rows).select("id", "label", "prob_desirable")


@query("l5_undesirable_weights")
def l5(spark, sf_dir):
    rows = labelled_vectors(spark, sf_dir)
    weighted = ml.DensityRatioClassifier.fit(rows).weights(rows.filter("label = 0"))
    return weighted.select("id", "prob_desirable", "weight")


@query(
    "l4_balanced_weights",
    """WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
SELECT doc_id AS id, quality AS label, round((SELECT count(*) FROM labels) / (2.0::DOUBLE * n), 6) AS weight FROM labels JOIN c USING (quality)""",
)
def l4_weights(spark, sf_dir):
    labels = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return ml.balanced_weights(labels, "label").withColumn("weight", F.round("weight", 6))


# What a fitted model must satisfy whatever its numbers: rows come back once, values lie in their range.


def checked(rows, good, *more):
    """Rows, distinct ids, and rows that break the condition (or leave it unknown)."""
    return rows.agg(
        F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids"),
        F.count(F.when(~F.coalesce(good, F.lit(False)), 1)).alias("n_bad"), *more,
    )


ALL_VECTORS = "SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_ids, CAST(0 AS BIGINT) AS n_bad FROM embeddings"
LABELLED = "SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_ids, CAST(0 AS BIGINT) AS n_bad FROM embeddings JOIN labels ON vec_id = doc_id"


@query("l1_clusters_hold", ALL_VECTORS)
def l1_hold(spark, sf_dir):
    return checked(l1(spark, sf_dir), F.col("cluster").between(0, 9))


@query("l2_components_hold", ALL_VECTORS.replace("FROM", ", CAST(0 AS DOUBLE) AS covariance FROM"))
def l2_hold(spark, sf_dir):
    """Principal components do not co-vary."""
    rows = l2(spark, sf_dir)
    small = (F.abs("x0") < 100) & (F.abs("x1") < 100)  # not so for NaN either, which is the largest number
    return checked(rows, small, F.abs(F.round(F.covar_pop("x0", "x1"), 6)).alias("covariance"))


@query("l3_plot_table_holds", with_(POINTS) + " SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, CAST(0 AS BIGINT) AS n_bad FROM points")
def l3_hold(spark, sf_dir):
    return checked(l3(spark, sf_dir), (F.col("fill_color") == ml.colour_of("cluster")) & F.col("text").isNotNull())


@query("l4_probabilities_hold", LABELLED)
def l4_hold(spark, sf_dir):
    return checked(l4(spark, sf_dir), F.col("prob_desirable").between(0, 1))


@query("l5_weights_hold", LABELLED + " WHERE quality = 0")
def l5_hold(spark, sf_dir):
    """weight = p / (1 - p + 1e-8), held between 0.5 and 10."""
    ratio = F.col("prob_desirable") / (1 - F.col("prob_desirable") + 1e-8)
    return checked(l5(spark, sf_dir), F.abs(F.col("weight") - F.least(F.lit(10.0), F.greatest(F.lit(0.5), ratio))) < 1e-9)


@query(
    "l6_test_rows_hold",
    """SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_ids, CAST(0 AS BIGINT) AS n_bad
FROM embeddings WHERE CAST('0x' || substr(md5('42:' || vec_id), 1, 6) AS BIGINT) % 100 < 20""",
)
def l6_hold(spark, sf_dir):
    scored = ml.train_and_score(vectors(spark, sf_dir), "id", "dense", "label")
    return checked(scored, F.col("prediction").between(0, 9) & (F.col("prediction") == F.floor("prediction")))


@query("l6_train_test_accuracy")
def l6(spark, sf_dir):
    scored = ml.train_and_score(vectors(spark, sf_dir), "id", "dense", "label")
    return stats.accuracy(scored, "prediction", "label")
