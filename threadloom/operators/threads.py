"""Thread preparation: flags, counts, best answer, filters, payload.

Two shapes are served. Threads that arrive as one row with an ``answers``
array (line dumps) use array expressions. Answers that arrive as rows of their
own use aggregates that combine before the shuffle, so a thread that owns a
large share of all answers is never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom import schemas

# Fixed value: status of the person who asked.
AUTHOR_STATUS = "Автор вопроса"
# Threads kept have fewer answers than this, payload texts are shorter than that.
MAX_ANSWERS = 6
MAX_TEXT = 3000

# The hand-corrected record appended once to the data set.
CORRECTED_RECORD = {
    "id": 18536837,
    "title": (
        "Как мне получить субсидии на ком. платежи, если я ухаживаю за пожилым человеком "
        "старше 80 лет."
    ),
    "description": (
        "Как мне получить субсидии на ком. платежи, если я ухаживаю за пожилым человеком "
        "старше 80 лет."
    ),
    "answers": [
        {
            "user_name": "Парфенов В.Н.",
            "status": "Юрист",
            "rating": 4.6,
            "text": (
                "К сожалению, то что вы ухаживаете за пожилым человеком старше 80 лет.-не является "
                "основанием для получения субсидии на оплату коммунальных услуг стст 153-155 ЖК РФ."
            ),
        }
    ],
}

ANSWER_FIELDS = schemas.ANSWER.fieldNames()


# --- threads as one row with an array -------------------------------------


def author_in_chat(answers: Column) -> Column:
    return F.coalesce(F.exists(answers, lambda a: a["status"] == AUTHOR_STATUS), F.lit(False))


def answer_count(answers: Column) -> Column:
    return F.coalesce(F.size(answers), F.lit(0)).cast("bigint")


def count_bin(n: Column) -> Column:
    """1..5 stay, everything else is -1."""
    return F.when(n.between(1, 5), n).otherwise(F.lit(-1)).cast("bigint")


def best_answer(answers: Column) -> Column:
    """struct(answers_max, max_rating): strictly greater wins, starting from 0.

    The first of equal ratings wins; with no positive rating it is the first
    answer with max_rating 0; without answers it is NULL and 0.
    """
    start = F.struct(
        F.lit(0).alias("i"), F.lit(0).alias("best"), F.lit(0.0).cast("double").alias("top")
    )

    def step(acc: Column, answer: Column) -> Column:
        better = F.coalesce(acc["top"] < answer["rating"], F.lit(False))
        return F.struct(
            (acc["i"] + 1).alias("i"),
            F.when(better, acc["i"]).otherwise(acc["best"]).alias("best"),
            F.when(better, answer["rating"]).otherwise(acc["top"]).alias("top"),
        )

    return F.aggregate(
        F.coalesce(answers, F.array().cast(schemas.THREAD["answers"].dataType)),
        start,
        step,
        lambda acc: F.struct(
            F.try_element_at(answers, acc["best"] + F.lit(1)).alias("answers_max"),
            acc["top"].alias("max_rating"),
        ),
    )


def first_answer_features(answers: Column, description: Column) -> Column:
    """Count, rating, text and lengths of the first answer; all NULL together."""
    first = F.try_element_at(answers, F.lit(1))
    usable = first.isNotNull() & first["text"].isNotNull() & description.isNotNull()
    return F.when(
        usable,
        F.struct(
            answer_count(answers).alias("len_answers"),
            first["rating"].alias("rating"),
            first["text"].alias("text"),
            F.length(description).cast("bigint").alias("len_description"),
            F.length(first["text"]).cast("bigint").alias("len_text"),
        ),
    )


def append_corrected_record(threads: DataFrame) -> DataFrame:
    extra = threads.sparkSession.createDataFrame([CORRECTED_RECORD], schemas.THREAD)
    return threads.unionByName(extra)


def annotate(threads: DataFrame) -> DataFrame:
    n = answer_count(F.col("answers"))
    return threads.withColumns(
        {
            "author_in_chat": author_in_chat(F.col("answers")),
            "counter_len_chat": n,
            "counter_len_chat_bins": count_bin(n),
        }
    )


def keep_short_without_author(threads: DataFrame) -> DataFrame:
    return threads.filter(~F.col("author_in_chat") & (F.col("counter_len_chat") < MAX_ANSWERS))


def prepare(threads: DataFrame) -> DataFrame:
    """Annotate, filter and attach the best answer."""
    kept = keep_short_without_author(annotate(threads))
    return kept.withColumn("_b", best_answer(F.col("answers"))).select(
        *kept.columns, "_b.answers_max", "_b.max_rating"
    )


def qa_records(prepared: DataFrame) -> DataFrame:
    return prepared.select("description", "answers_max", "id")


def above_rating(records: DataFrame, min_rating: float | None) -> DataFrame:
    """Strictly above the minimum; no filter when it is None or 0."""
    if not min_rating:
        return records
    return records.filter(F.col("answers_max.rating") > min_rating)


def payload(records: DataFrame) -> DataFrame:
    """Flat question/answer rows whose two texts are both short enough."""
    flat = records.select(
        F.col("id"),
        F.col("description").alias("question"),
        F.col("answers_max.text").alias("answer"),
        F.col("answers_max.rating").alias("rating"),
    )
    return flat.filter((F.length("question") < MAX_TEXT) & (F.length("answer") < MAX_TEXT))


# --- answers as rows --------------------------------------------------------


def _rank_rating() -> Column:
    """Ratings that cannot win (absent, zero, negative) all count as 0."""
    return F.greatest(F.coalesce(F.col("rating"), F.lit(0.0)), F.lit(0.0))


def annotate_rows(threads: DataFrame, answers: DataFrame) -> DataFrame:
    """Flags, counts, best and first answer per thread from answer rows.

    ``answers`` has thread_id, position (orderable within a thread) and the
    answer fields. Every aggregate combines before the shuffle.
    """
    whole = F.struct(*ANSWER_FIELDS)
    stats = answers.groupBy(F.col("thread_id").alias("id")).agg(
        F.count(F.lit(1)).alias("counter_len_chat"),
        F.coalesce(F.bool_or(F.col("status") == AUTHOR_STATUS), F.lit(False)).alias(
            "author_in_chat"
        ),
        F.min_by(whole, F.struct((-_rank_rating()).alias("r"), "position")).alias("answers_max"),
        F.max(_rank_rating()).alias("max_rating"),
        F.min_by(whole, F.col("position")).alias("first_answer"),
    )
    joined = threads.join(stats, "id", "left")
    n = F.coalesce(F.col("counter_len_chat"), F.lit(0)).cast("bigint")
    return joined.withColumns(
        {
            "counter_len_chat": n,
            "counter_len_chat_bins": count_bin(n),
            "author_in_chat": F.coalesce(F.col("author_in_chat"), F.lit(False)),
            "max_rating": F.coalesce(F.col("max_rating"), F.lit(0.0)),
        }
    )


def prepare_rows(threads: DataFrame, answers: DataFrame) -> DataFrame:
    return keep_short_without_author(annotate_rows(threads, answers))


def gather_short_threads(threads: DataFrame, answers: DataFrame) -> DataFrame:
    """Threads with their answers as an array, for threads of under six answers.

    Long threads are dropped by count first, so no array outgrows the bound.
    """
    short = prepare_rows(threads, answers).select(*threads.columns, "counter_len_chat")
    lists = (
        answers.join(
            short.filter(F.col("counter_len_chat") > 0).select(F.col("id").alias("thread_id")),
            "thread_id",
            "left_semi",
        )
        .groupBy(F.col("thread_id").alias("id"))
        .agg(F.array_sort(F.collect_list(F.struct("position", *ANSWER_FIELDS))).alias("_l"))
        .select(
            "id",
            F.transform("_l", lambda a: F.struct(*[a[f].alias(f) for f in ANSWER_FIELDS])).alias(
                "answers"
            ),
        )
    )
    none = F.array().cast(schemas.THREAD["answers"].dataType)
    return (
        short.drop("counter_len_chat")
        .join(lists, "id", "left")
        .withColumn("answers", F.coalesce(F.col("answers"), none))
    )
