from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators import threads as th


def answer(rating, text, status="Юрист"):
    return ("u", status, rating, text)


CASES = {
    1: [answer(3.0, "first"), answer(3.0, "second")],
    2: [answer(0.0, "first"), answer(0.0, "second")],
    3: [answer(-2.0, "first"), answer(-1.0, "second")],
    4: [answer(None, "first"), answer(2.0, "second"), answer(None, "third")],
    5: [],
    6: [answer(1.0, "a"), answer(5.0, "b"), answer(4.0, "c", th.AUTHOR_STATUS)],
    7: [answer(float(i), str(i)) for i in range(6)],
    8: [answer(1.0, "😀"), answer(1.5, "y")],
}
BEST = {1: ("first", 3.0), 2: ("first", 0.0), 3: ("first", 0.0), 4: ("second", 2.0), 5: (None, 0.0), 8: ("y", 1.5)}


@pytest.fixture(scope="module")
def threads(spark):
    rows = [(i, "t", "question", a) for i, a in CASES.items()]
    return spark.createDataFrame(rows, schemas.THREAD)


@pytest.fixture(scope="module")
def as_rows(threads):
    exploded = threads.select(
        F.col("id").alias("thread_id"), F.posexplode("answers").alias("position", "a")
    )
    return threads.drop("answers"), exploded.select("thread_id", "position", "a.*")


def test_best_answer_of_arrays(threads):
    rows = th.prepare(threads).collect()
    assert {r.id: (r.answers_max and r.answers_max.text, r.max_rating) for r in rows} == BEST


def test_best_answer_of_rows_agrees(as_rows):
    rows = th.prepare_rows(*as_rows).collect()
    assert {r.id: (r.answers_max and r.answers_max.text, r.max_rating) for r in rows} == BEST


def test_gathered_threads_agree(as_rows):
    rows = th.prepare(th.gather_short_threads(*as_rows)).collect()
    assert {r.id: (r.answers_max and r.answers_max.text, r.max_rating) for r in rows} == BEST


def test_flags_and_bins(threads):
    rows = {r.id: r for r in th.annotate(threads).collect()}
    assert [i for i, r in rows.items() if r.author_in_chat] == [6]
    assert rows[5].counter_len_chat == 0 and rows[5].counter_len_chat_bins == -1
    assert rows[7].counter_len_chat == 6 and rows[7].counter_len_chat_bins == -1
    assert rows[4].counter_len_chat_bins == 3


def test_null_answers_count_as_none(spark):
    row = th.annotate(spark.createDataFrame([(1, "t", "d", None)], schemas.THREAD)).first()
    assert (row.author_in_chat, row.counter_len_chat) == (False, 0)


def test_first_answer_features_are_null_together(threads):
    rows = {
        r.id: r.f
        for r in threads.select(
            "id", th.first_answer_features(F.col("answers"), F.col("description")).alias("f")
        ).collect()
    }
    assert rows[5] is None
    assert rows[8].len_text == 1 and rows[8].len_description == len("question")


def test_minimum_rating_is_skipped_when_falsy(threads):
    records = th.qa_records(th.prepare(threads))
    assert th.above_rating(records, 0).count() == th.above_rating(records, None).count() == records.count()
    assert [r.id for r in th.above_rating(records, 2.0).collect()] == [1]


def test_payload_drops_long_texts(spark, threads):
    records = th.qa_records(th.prepare(threads))
    long = records.withColumn("description", F.lit("x" * th.MAX_TEXT))
    assert th.payload(long).count() == 0
    assert th.payload(records).count() == len(BEST) - 1


def test_corrected_record_is_appended_once(threads):
    whole = th.append_corrected_record(threads)
    assert whole.count() == len(CASES) + 1
    assert whole.filter("id = 18536837").first().answers[0].rating == 4.6
