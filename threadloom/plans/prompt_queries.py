"""Chat markup, context layouts, prompt tables and data sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import prompts as pr, retrieval as rt
from threadloom.plans import inputs
from threadloom.plans.inputs import DENSE, POINTS, points, ranked, with_
from threadloom.plans.registry import query
from threadloom.plans.retrieval_queries import (
    DENSE_CONTEXT,
    NEIGHBOUR_ROWS,
    NEIGHBOURS,
    QUESTION_BEST,
    hybrid_points,
    questions,
    self_queries,
)


def lit(text: str) -> str:
    """SQL literal of a text."""
    return "'" + text.replace("'", "''") + "'"


def turn(role: str, content: str) -> str:
    return f"'<|im_start|>{role}' || chr(10) || {content} || '<|im_end|>' || chr(10)"


HEADER = "'<|im_start|>assistant' || chr(10)"


def layout_sql(layout: str, order: str = "rank", question: str = "p.question", answer: str = "p.answer") -> str:
    heading, before_question, before_answer, after = pr.LAYOUTS[layout]
    return (
        f"{lit(heading)} || string_agg({lit(before_question)} || {question} || {lit(before_answer)} || "
        f"{answer} || {lit(after)}, '' ORDER BY {order})"
    )


@query(
    "h3_string_building",
    "SELECT o_orderkey AS id, 'Заказ ' || o_orderkey || ': ' || o_orderpriority || ' / ' || o_orderstatus AS line FROM orders",
)
def h3(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(
            F.lit("Заказ "), F.col("o_orderkey").cast("string"), F.lit(": "), "o_orderpriority", F.lit(" / "), "o_orderstatus"
        ).alias("line"),
    )


@query(
    "h5_replace_chain",
    "SELECT page_id, replace(replace(replace(url, ':', '_'), '/', '_'), '.', '_') AS safe FROM pages",
)
def h5(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", F.translate("url", ":/.", "___").alias("safe"))


@query(
    "h8_split_part",
    "SELECT page_id, coalesce(string_split(html, '<p>')[2], '') AS second_part FROM pages",
)
def h8(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.split_part_or_empty(F.col("html"), "<p>", 1).alias("second_part"))


@query(
    "h9_remove_thinking",
    r"""SELECT doc_id, trim(regexp_replace('<think>' || source || chr(10) || lang || '</think>' || chr(10) || text,
  '(?s)<think>(.*?)</think>', '', 'g'), E' \t\n\r\x0b\x0c') AS answer FROM documents""",
)
def h9(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    said = F.concat(F.lit("<think>"), "source", F.lit("\n"), "lang", F.lit("</think>\n"), "text")
    return docs.select("doc_id", tx.remove_thinking(said).alias("answer"))


@query(
    "h11_template_fill",
    """SELECT conv_id, turn, 'Роль: ' || role || ' {x} ' || chr(10) || text AS filled FROM conversations""",
)
def h11(spark, sf_dir):
    turns = inputs.table(spark, sf_dir, "conversations")
    filled = tx.fill_template("Роль: {role} {{x}} \n{text}", role=F.col("role"), text=F.col("text"))
    return turns.select("conv_id", "turn", filled.alias("filled"))


@query(
    "h12_percent_floor",
    """SELECT lang, CAST(floor(count(*) / 100.0::DOUBLE * 20.0::DOUBLE) AS BIGINT) AS n_valid FROM documents GROUP BY 1""",
)
def h12(spark, sf_dir):
    from threadloom.operators.ordering import percent_floor

    counts = inputs.table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("lang", percent_floor(F.col("n"), 20).alias("n_valid"))


@query(
    "h14_chat_markup",
    f"""SELECT pair_id, {turn('user', 'prompt')} || {turn('assistant', 'chosen')} AS rendered,
  {turn('user', 'prompt')} || {HEADER} AS open_prompt
FROM (SELECT a.conv_id * 1000 + a.turn AS pair_id, a.text AS prompt, b.text AS chosen
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)""",
)
def h14(spark, sf_dir):
    turns = inputs.table(spark, sf_dir, "conversations")
    answers = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("chosen"))
    joined = turns.join(answers, ["conv_id", "turn"])
    user, assistant = tx.message("user", F.col("text")), tx.message("assistant", F.col("chosen"))
    return joined.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"),
        tx.chat_markup(F.array(user, assistant)).alias("rendered"),
        tx.chat_markup(F.array(user), True).alias("open_prompt"),
    )


@query(
    "h20_text_after_prompt",
    """SELECT doc_id, substr(lang || text, length(lang) + 1) AS completion FROM documents""",
)
def h20(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", tx.strip_prompt(F.concat("lang", "text"), F.col("lang")).alias("completion")
    )


# --- record prompts ------------------------------------------------------------------------


def record_prompt_sql(name: str, source: str, limit: int = 3) -> str:
    system, own, given, reply = (
        turn("system", lit(pr.RECORD_SYSTEM_PROMPT)),
        turn("user", "any_value(q.question)"),
        turn("system", "(" + layout_sql("record", "c.rank") + ")"),
        turn("assistant", "any_value(q.answer)"),
    )
    return f"""
{name} AS (
  SELECT c.qid, {system} || {own} || {given} || {reply} AS prompt
  FROM {source} c JOIN points p ON p.id = c.id JOIN points q ON q.id = c.qid WHERE c.rank <= {limit} GROUP BY 1)"""


@query(
    "k1_record_prompt",
    with_(*DENSE_CONTEXT, record_prompt_sql("prompts", "ctx")) + "SELECT qid AS id, prompt FROM prompts",
)
def k1(spark, sf_dir):
    pts = points(spark, sf_dir)
    built = rt.create_records(pts, pts.select("id"), "dense_query")
    built = built.filter(F.col("record").isNotNull())
    return built.select("id", pr.record_prompt(F.col("record")).alias("prompt"))


@query(
    "k2_prompt_table",
    with_(*DENSE_CONTEXT, record_prompt_sql("p1", "ctx"))
    + """SELECT l.doc_id AS points, p1.prompt AS prompt_dense_query,
  len(list_filter(string_split(p1.prompt, ' '), lambda w: w <> '')) AS len_dense_query
FROM labels l LEFT JOIN p1 ON p1.qid = l.doc_id""",
)
def k2(spark, sf_dir):
    ids = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("points"))
    wide = rt.sweep(points(spark, sf_dir), ids, [("dense_query", False)])
    table = pr.prompt_table(wide)
    return table.withColumn(
        "len_dense_query", F.when(F.col("prompt_dense_query").isNotNull(), F.col("len_dense_query"))
    )


@query(
    "f3_context_slice",
    with_(*DENSE_CONTEXT)
    + "SELECT qid AS id, string_agg('answer ' || id, ', ' ORDER BY rank) AS used FROM ctx WHERE rank <= 3 GROUP BY 1",
)
def f3(spark, sf_dir):
    pts = points(spark, sf_dir)
    built = rt.create_records(pts, pts.select("id"), "dense_query").filter(F.col("record").isNotNull())
    used = F.transform(F.slice("record.context", 1, 3), lambda c: c["answer"])
    return built.select("id", F.array_join(used, ", ").alias("used"))


@query(
    "b18_split_texts",
    with_(
        *DENSE_CONTEXT,
        record_prompt_sql("p1", "ctx"),
        """keyed AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM labels)""",
    )
    + """SELECT p1.prompt AS text FROM keyed LEFT JOIN p1 ON p1.qid = doc_id
WHERE rn > n - floor(n / 100.0::DOUBLE * 20)""",
)
def b18(spark, sf_dir):
    from threadloom.operators.ordering import split_tail_valid

    ids = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("points"))
    split = split_tail_valid(ids, "points", 20).select("points", "cat")
    wide = rt.sweep(points(spark, sf_dir), split, [("dense_query", False)])
    return pr.training_texts(pr.prompt_table(wide), "prompt_dense_query", "valid")


# --- four prompt variants ---------------------------------------------------------------------


def variants_sql(system_prompt: str, context_column: str = "context") -> str:
    system, own, reply = turn("system", lit(system_prompt)), turn("user", "question"), turn("assistant", "answer")
    given = turn("system", context_column)
    some = f"{context_column} <> ''"
    return f"""{system} || {own} || {reply} AS prompt, {system} || {own} || {HEADER} AS prompt_not_answer, answer, question,
  CASE WHEN {some} THEN {system} || {own} || {given} || {reply} END AS prompt_context,
  CASE WHEN {some} THEN {system} || {own} || {given} || {HEADER} END AS prompt_context_not_answer,
  CASE WHEN {some} THEN {context_column} END AS context"""


@query(
    "k3_prompt_variants",
    f"""SELECT pair_id, {variants_sql(pr.DATASET_SYSTEM_PROMPT)}
FROM (SELECT a.conv_id * 1000 + a.turn AS pair_id, a.text AS question, b.text AS answer, c.text AS context
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
  LEFT JOIN conversations c ON c.conv_id = a.conv_id AND c.turn = a.turn + 2)""",
)
def k3(spark, sf_dir):
    turns = inputs.table(spark, sf_dir, "conversations")
    shifted = lambda by, name: turns.select("conv_id", (F.col("turn") - by).alias("turn"), F.col("text").alias(name))
    rows = (
        shifted(0, "question")
        .join(shifted(1, "answer"), ["conv_id", "turn"])
        .join(shifted(2, "context"), ["conv_id", "turn"], "left")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), "question", "answer", "context")
    )
    return pr.prompt_variants(rows)


def context_sql(rule: str, layout: str) -> str:
    """(qid, context) of the neighbours a rule keeps."""
    return f"""
contexts AS (
  SELECT n.qid, {layout_sql(layout, "n.rank")} AS context
  FROM n JOIN flags USING (qid) JOIN points p ON p.id = n.id WHERE {rule} GROUP BY 1)"""


BENCHMARK_RULE = "CASE WHEN same_own THEN n.rank BETWEEN 3 AND 5 ELSE n.rank BETWEEN 2 AND 5 END"
DATASET_RULE = "CASE WHEN same_first THEN n.rank BETWEEN 3 AND 5 ELSE n.rank = 2 END"


@query(
    "k4_benchmark_prompts",
    with_(*NEIGHBOURS, NEIGHBOUR_ROWS, context_sql(BENCHMARK_RULE, "benchmark"))
    + f"""SELECT q.id AS index, {variants_sql(pr.DATASET_SYSTEM_PROMPT)},
  CAST(3 AS BIGINT) AS n_prompt_list, CAST(3 AS BIGINT) AS n_prompt_list_context_not_answer
FROM points q JOIN contexts c ON c.qid = q.id""",
)
def k4(spark, sf_dir):
    pts = points(spark, sf_dir)
    queries = self_queries(pts)
    kept = rt.benchmark_rule(rt.neighbours(queries, pts, 5))
    rows = pr.prompt_variants(pr.with_context(queries, kept, "benchmark"), lists=True)
    lists = [c for c in rows.columns if c.startswith("prompt_list")]
    return rows.withColumns(
        {f"n_{c}": F.size(c).cast("bigint") for c in ("prompt_list", "prompt_list_context_not_answer")}
    ).drop(*lists)


def layout_query(layout: str):
    def run(spark, sf_dir):
        pts = points(spark, sf_dir)
        queries = self_queries(pts)
        found = rt.neighbours(queries, pts, 5)
        rule = {"dataset": rt.dataset_rule, "benchmark": rt.benchmark_rule, "few_shot": rt.few_shot_rule}[layout]
        return pr.with_context(queries, rule(found), layout).select("index", "context")

    return run


for _layout, _rule in (
    ("dataset", DATASET_RULE),
    ("benchmark", BENCHMARK_RULE),
    ("few_shot", "n.rank BETWEEN 2 AND 4"),
):
    query(
        f"k5_context_{_layout}",
        with_(*NEIGHBOURS, NEIGHBOUR_ROWS, context_sql(_rule, _layout))
        + "SELECT qid AS index, context FROM contexts",
    )(layout_query(_layout))


@query(
    "k6_dataset_job",
    with_(
        POINTS,
        DENSE,
        ranked("d0", "dense", 5),
        "d AS (SELECT d0.* FROM d0 JOIN points w ON w.id = d0.qid WHERE w.rating >= 5)",
        NEIGHBOUR_ROWS,
        context_sql(DATASET_RULE, "dataset"),
        "firsts AS (SELECT n.qid, p.question, p.answer FROM n JOIN points p ON p.id = n.id WHERE n.rank = 1)",
        "rows_ AS (SELECT f.qid AS index, f.question, f.answer, c.context, "
        "row_number() OVER (ORDER BY md5('0:' || f.qid), f.qid) AS rn, count(*) OVER () AS total "
        "FROM firsts f JOIN contexts c ON c.qid = f.qid)",
    )
    + f"""SELECT index, {variants_sql(pr.DATASET_SYSTEM_PROMPT)}, rn,
  CASE WHEN rn <= floor(total / 100.0::DOUBLE * 15) THEN 'valid' ELSE 'train' END AS split FROM rows_""",
)
def k6(spark, sf_dir):
    return pr.dataset_from_collection(points(spark, sf_dir), rating_more=5)


@query(
    "k7_few_shot_messages",
    with_(
        POINTS, DENSE, ranked("d", "dense", 10), NEIGHBOUR_ROWS, context_sql("n.rank BETWEEN 2 AND 4", "few_shot")
    )
    + f"""SELECT q.id AS index, {lit(pr.FEW_SHOT_SYSTEM_PROMPT)} AS system_prompt, q.question AS user_message, c.context AS example
FROM points q JOIN contexts c ON c.qid = q.id""",
)
def k7(spark, sf_dir):
    pts = points(spark, sf_dir)
    queries = self_queries(pts)
    messages = pr.few_shot_messages(queries, rt.neighbours(queries, pts, 10))
    part = lambda i: F.col("messages")[i]["content"]
    return messages.select(
        "index", part(0).alias("system_prompt"), part(1).alias("user_message"), part(2).alias("example")
    )


RAG_CONTEXT = QUESTION_BEST.rstrip() + f""",
contexts AS (
  SELECT b.qid, {layout_sql("rag", "b.rank")} AS context FROM best b JOIN points p USING (id) WHERE b.rank <= 5 GROUP BY 1)
"""


def _rag(spark, sf_dir):
    asked = questions(spark, sf_dir)
    return asked, rt.question_context(asked, hybrid_points(spark, sf_dir), "sparse_queary")


@query("k8_rag_context", RAG_CONTEXT + "SELECT qid, context FROM contexts")
def k8(spark, sf_dir):
    return pr.rag_context(_rag(spark, sf_dir)[1])


@query(
    "k9_rag_messages",
    RAG_CONTEXT
    + f"""SELECT b.item_id AS qid, replace({lit(pr.RAG_SYSTEM_TEMPLATE)}, '{{context}}', coalesce(c.context, '')) AS system_prompt,
  b.text AS user_message FROM benchmark b LEFT JOIN contexts c ON c.qid = b.item_id""",
)
def k9(spark, sf_dir):
    asked, found = _rag(spark, sf_dir)
    rows = pr.rag_messages(asked, pr.rag_context(found))
    part = lambda i: F.col("messages")[i]["content"]
    return rows.select("qid", part(0).alias("system_prompt"), part(1).alias("user_message"))


@query(
    "k10_prompt_and_target",
    f"""WITH texts AS (SELECT conv_id, turn, CASE WHEN role = 'assistant'
  THEN {turn('user', "CAST(turn AS VARCHAR)")} || {turn('assistant', 'text')} ELSE {turn('user', 'text')} END AS t FROM conversations),
parts AS (SELECT *, string_split(t, {HEADER}) AS p FROM texts)
SELECT conv_id, turn, trim(p[1], E' \\t\\n\\r\\x0b\\x0c') AS prompt,
  CASE WHEN len(p) > 1 THEN trim(string_split(p[2], '<|im_end|>')[1], E' \\t\\n\\r\\x0b\\x0c') ELSE '' END AS target FROM parts""",
)
def k10(spark, sf_dir):
    turns = inputs.table(spark, sf_dir, "conversations")
    replied = F.array(tx.message("user", F.col("turn")), tx.message("assistant", F.col("text")))
    rendered = F.when(F.col("role") == "assistant", tx.chat_markup(replied)).otherwise(
        tx.chat_markup(F.array(tx.message("user", F.col("text"))))
    )
    prompt, target = tx.split_prompt_target(F.col("t"))
    return turns.withColumn("t", rendered).select(
        "conv_id", "turn", prompt.alias("prompt"), target.alias("target")
    )
