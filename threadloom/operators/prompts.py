"""Prompt building: chat messages, context layouts, data sets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions import text as tx
from threadloom.functions.models import token_count
from threadloom.operators import ordering, retrieval as rt

# Texts that end up inside the prompts.
RECORD_SYSTEM_PROMPT = (
    "Ты юрист и эксперт по российскому праву, твоя задача помогать людям. "
    "Изучи вопрос пользователя, изучи переданные затем тебе вопросы других "
    "граждан и ответы, которые давали на них другие юристы. "
    "На основании этих данных ответь на вопрос гражданина. "
    "Ответ пиши только на РУССКОМ языке!"
)
DATASET_SYSTEM_PROMPT = (
    "Ты юрист. Ты консультируешь людей по разным проблемам, внимательно прочитай, что тебе пишут, "
    "ответь на поставленные вопросы и дай консультацию. Ответ пиши только на РУССКОМ языке!"
)
FEW_SHOT_SYSTEM_PROMPT = (
    DATASET_SYSTEM_PROMPT
    + "Ответ дай с учетом тех примеров, которые тебе будут даны после вопроса пользователя."
)
RAG_SYSTEM_TEMPLATE = """
**Роль**
Ты юрист и эксперт по российскому праву, твоя задача помогать людям.
Ответ пиши только на РУССКОМ языке!
Если тебя спрашиваю о том, кто ты, то отвечай, что ты ИИ для юридических вопросов.
При даче ответа на вопрос не опирайся на обстрактное знание

**Задача**
Твоя задача ответить на вопрос пользователя. Прежде чем давать ответ на
вопрос пользователя изучи переданный тебе контекст. Контекст состоит из
вопросов других граждан и ответов на них других граждан.

**Контекст**
{context}
"""

# Context layouts as (heading, text before question, before answer, after answer).
LAYOUTS = {
    "record": (
        "Прежде чем дать ответ изучи вопросы других граждан и ответы на них юристов:",
        "\n\nВопрос гражданина:\n",
        "\n\nОтвет юриста:\n",
        "",
    ),
    "dataset": (
        "Перед тем как дать консультацию изучи вопросы других людей и ответы на них других юристов:\n",
        "Вопрос гражданина:\n        ",
        "\n        Ответ юриста:\n        ",
        "\n        ",
    ),
    "benchmark": (
        "Перед тем как дать консультацию изучи вопросы других людей и ответы на них других юристов:\n",
        "\n    Вопрос гражданина:\n    ",
        "\n    Ответ юриста:\n    ",
        "\n    ",
    ),
    "few_shot": (
        "Перед тем как дать консультацию изучи вопросы других людей и ответы на них:\n",
        "Вопрос гражданина:\n    ",
        "\n    Ответ юриста:\n    ",
        "\n\n    ",
    ),
    "rag": ("", "Вопрос пользователя:\n", "\n\nОтвет юриста:\n", "\n\n"),
}


def context_text(neighbours: Column, layout: str) -> Column:
    """One text from an ordered array of question/answer structs."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown context layout {layout!r}, choose one of {sorted(LAYOUTS)}")
    heading, before_question, before_answer, after = LAYOUTS[layout]
    blocks = F.transform(
        neighbours,
        lambda n: F.concat(
            F.lit(before_question), n["question"], F.lit(before_answer), n["answer"], F.lit(after)
        ),
    )
    return F.concat(F.lit(heading), F.array_join(blocks, ""))


def record_messages(record: Column, system_prompt: str, limit: int = 3) -> Column:
    """system, user question, system context of the first ``limit``, assistant answer."""
    return F.array(
        tx.message("system", F.lit(system_prompt)),
        tx.message("user", record["question_answer"]["question"]),
        tx.message("system", context_text(F.slice(record["context"], 1, limit), "record")),
        tx.message("assistant", record["question_answer"]["answer"]),
    )


def record_prompt(record: Column, system_prompt: str = RECORD_SYSTEM_PROMPT, limit: int = 3) -> Column:
    return F.when(
        record.isNotNull(), tx.chat_markup(record_messages(record, system_prompt, limit))
    )


def prompt_table(
    wide: DataFrame,
    system_prompt: str = RECORD_SYSTEM_PROMPT,
    limit: int = 3,
    count_tokens: Callable[[Column], Column] = token_count,
) -> DataFrame:
    """Replace every ``param_*`` record by its prompt and the prompt's token count."""
    names = [c.removeprefix("param_") for c in rt.columns_with_prefix(wide, "param_")]
    prompts = wide.select(
        *rt.columns_without_prefix(wide, "param_"),
        *[record_prompt(F.col(f"param_{n}"), system_prompt, limit).alias(f"prompt_{n}") for n in names],
    )
    return prompts.withColumns({f"len_{n}": count_tokens(F.col(f"prompt_{n}")) for n in names})


def training_texts(prompts: DataFrame, column: str, cat: str) -> DataFrame:
    """Texts of one prompt column and split."""
    return prompts.filter(F.col("cat") == cat).select(F.col(column).alias("text"))


def retriever_label(column: str) -> tuple[str, bool]:
    """(retriever name, re-ranked?) of a prompt column.

    Prompt columns start with ``prompt_``, so no ``param_`` prefix is found to
    strip and the name keeps its own prefix.
    """
    name = column.removeprefix("param_")
    return name.removesuffix("_rerank"), name.endswith("_rerank")


def message_sets(system_prompt: str, question: Column, answer: Column, context: Column) -> dict[str, Column]:
    """Message arrays without and with context; NULL where there is no context."""
    system = tx.message("system", F.lit(system_prompt))
    user = tx.message("user", question)
    assistant = tx.message("assistant", answer)
    given = context.isNotNull() & (context != "")
    between = tx.message("system", context)
    return {
        "prompt_list": F.array(system, user, assistant),
        "prompt_list_not_answer": F.array(system, user),
        "prompt_list_context": F.when(given, F.array(system, user, between, assistant)),
        "prompt_list_context_not_answer": F.when(given, F.array(system, user, between)),
    }


def prompt_variants(
    rows: DataFrame, system_prompt: str = DATASET_SYSTEM_PROMPT, lists: bool = False
) -> DataFrame:
    """Four prompts per (question, answer, context) row.

    With ``lists`` the message arrays are kept as columns as well.
    """
    sets = message_sets(system_prompt, F.col("question"), F.col("answer"), F.col("context"))
    others = [c for c in rows.columns if c not in ("question", "answer", "context")]
    given = F.col("context").isNotNull() & (F.col("context") != "")
    return rows.select(
        *others,
        tx.chat_markup(sets["prompt_list"]).alias("prompt"),
        tx.chat_markup(sets["prompt_list_not_answer"], True).alias("prompt_not_answer"),
        "answer",
        "question",
        tx.chat_markup(sets["prompt_list_context"]).alias("prompt_context"),
        tx.chat_markup(sets["prompt_list_context_not_answer"], True).alias("prompt_context_not_answer"),
        F.when(given, F.col("context")).alias("context"),
        *([c.alias(n) for n, c in sets.items()] if lists else []),
    )


def nested_neighbours(ranked: DataFrame) -> DataFrame:
    """(qid, neighbours): the kept neighbours of each question in rank order."""
    return ranked.groupBy("qid").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "question", "answer"))),
            lambda n: F.struct(n["question"].alias("question"), n["answer"].alias("answer")),
        ).alias("neighbours")
    )


def with_context(queries: DataFrame, kept: DataFrame, layout: str) -> DataFrame:
    """(index, question, answer, context); a question left without neighbours gets the heading."""
    nested = nested_neighbours(kept)
    no_one = F.array().cast("array<struct<question:string,answer:string>>")
    return queries.join(nested, "qid", "left").select(
        F.col("qid").alias("index"),
        "question",
        "answer",
        context_text(F.coalesce("neighbours", no_one), layout).alias("context"),
    )


def dataset_from_collection(
    points: DataFrame,
    rating_more: float,
    n_examples: int | None = None,
    system_prompt: str = DATASET_SYSTEM_PROMPT,
    percent_valid: int = 15,
    n_valid: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Filtered points -> neighbour context -> four prompts -> shuffled train/valid split.

    The payload is the first place of the point's own search, as the rule has it.
    """
    chosen = rt.scroll(points, rating_more, n_examples).withColumnRenamed("id", "qid")
    ranked = rt.neighbours(chosen, points, 5)
    first = ranked.filter(F.col("rank") == 1).select("qid", "question", "answer")
    rows = with_context(first, rt.dataset_rule(ranked), "dataset")
    prompts = prompt_variants(rows, system_prompt)
    return ordering.split_head_valid(prompts, "index", percent_valid, seed, n_valid)


def few_shot_messages(
    queries: DataFrame, ranked: DataFrame, system_prompt: str = FEW_SHOT_SYSTEM_PROMPT
) -> DataFrame:
    """(index, messages) without an assistant turn, examples in the second system turn."""
    rows = with_context(queries, rt.few_shot_rule(ranked), "few_shot")
    return rows.select(
        "index",
        F.array(
            tx.message("system", F.lit(system_prompt)),
            tx.message("user", F.col("question")),
            tx.message("system", F.col("context")),
        ).alias("messages"),
    )


def rag_context(found: DataFrame) -> DataFrame:
    """(qid, context) of each question's retrieved payloads."""
    return nested_neighbours(found).select("qid", context_text(F.col("neighbours"), "rag").alias("context"))


def rag_messages(
    questions: DataFrame, contexts: DataFrame, template: str = RAG_SYSTEM_TEMPLATE
) -> DataFrame:
    """(qid, context, messages): filled system prompt and the question; no history."""
    joined = questions.join(contexts, "qid", "left").withColumn(
        "context", F.coalesce("context", F.lit(""))
    )
    system = tx.fill_template(template, context=F.col("context"), user_message=F.col("question"))
    return joined.select(
        "qid",
        "context",
        F.array(tx.message("system", system), tx.message("user", F.col("question"))).alias("messages"),
    )


def sample_generations(
    eval_rows: DataFrame, text: str, generated: str, order: str, n: int = 3, columns: Sequence[str] = ()
) -> DataFrame:
    """First ``n`` evaluation rows as (prompt, generated, target)."""
    prompt, target = tx.split_prompt_target(F.col(text))
    return (
        eval_rows.orderBy(order)
        .limit(n)
        .select(*columns, prompt.alias("prompt"), F.col(generated).alias("generated"), target.alias("target"))
    )
