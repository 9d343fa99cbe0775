from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import prompts as pr, reranking as rr, retrieval as rt


@pytest.fixture(scope="module")
def points(spark):
    rows = [
        (1, "same question", "a1", 5.0, [1.0, 0.0], {"same": 1.0, "q": 1.0}),
        (2, "same question", "a2", 4.0, [1.0, 0.01], {"same": 1.0, "q": 1.0}),
        (3, "near question", "a3", 3.0, [0.9, 0.2], {"near": 1.0, "q": 1.0}),
        (4, "far", "a4", 2.0, [0.0, 1.0], {"far": 1.0, "q": 1.0}),
    ]
    return spark.createDataFrame(
        rows,
        "id long, question string, answer string, rating double, dense array<float>, text_sparse map<string,double>",
    )


def test_unknown_retriever_fails_before_running():
    with pytest.raises(ValueError, match="unknown retriever"):
        rt.retriever("nothing")


def test_single_list_fusion_keeps_order(points):
    ranking = rt.dense_topk(points.withColumnRenamed("id", "qid"), points, 4)
    before = {(r.qid, r["rank"]): r.id for r in ranking.collect()}
    after = {(r.qid, r["rank"]): r.id for r in rt.fuse([ranking], 4).collect()}
    assert before == after


def test_record_drops_first_place_and_repeated_question(spark, points):
    ids = spark.createDataFrame([(1,), (99,)], "id long")
    rows = {r.id: r.record for r in rt.create_records(points, ids, "dense_query").collect()}
    assert rows[99] is None
    assert [c.answer for c in rows[1].context] == ["a3", "a4"]
    assert rows[1].question_answer.answer == "a1"


def test_record_is_null_without_context(spark, points):
    only_twins = points.filter("id <= 2")
    ids = spark.createDataFrame([(1,)], "id long")
    assert rt.create_records(only_twins, ids, "dense_query").first().record is None


def test_rerank_is_a_stable_permutation(points):
    queries = points.withColumnRenamed("id", "qid")
    ranked = rt.attach_payload(rt.dense_topk(queries, points, 4), queries, points)
    constant = lambda q, d: F.lit(1.0)
    again = {(r.qid, r["rank"], r.id) for r in rt.rerank(ranked, constant).collect()}
    assert again == {(r.qid, r["rank"], r.id) for r in ranked.collect()}


def test_neighbour_rules(points):
    queries = points.withColumnRenamed("id", "qid")
    ranked = rt.neighbours(queries, points, 4)
    kept = lambda df, q: sorted(r["rank"] for r in df.filter(F.col("qid") == q).collect())
    assert kept(rt.dataset_rule(ranked), 1) == [3, 4]
    assert kept(rt.dataset_rule(ranked), 4) == [2]
    assert kept(rt.benchmark_rule(ranked), 1) == [3, 4]
    assert kept(rt.benchmark_rule(ranked), 4) == [2, 3, 4]
    assert kept(rt.few_shot_rule(ranked), 4) == [2, 3, 4]


def test_sweep_and_prompt_table(spark, points):
    ids = spark.createDataFrame([(1, "train"), (3, "valid"), (99, "train")], "points long, cat string")
    wide = rt.sweep(points, ids)
    assert rt.columns_with_prefix(wide, "param_") == [rt.param_name(*s) for s in rt.DEFAULT_SWEEP]
    complete = rt.complete_rows(wide)
    table = pr.prompt_table(complete)
    rows = {r.points: r for r in table.collect()}
    assert 99 not in rows and 1 in rows
    assert rows[1].prompt_dense_query.endswith("<|im_start|>assistant\na1<|im_end|>\n")
    assert rows[1].len_dense_query == len([w for w in rows[1].prompt_dense_query.split(" ") if w])
    assert not [c for c in table.columns if c.startswith("param_")]
    spark.catalog.clearCache()


def test_retriever_label_keeps_prompt_prefix():
    assert pr.retriever_label("prompt_dense_query_rerank") == ("prompt_dense_query", True)


def test_context_layouts(spark):
    df = spark.sql("select array(named_struct('question','q','answer','a')) n")
    text = lambda layout: df.select(pr.context_text(F.col("n"), layout)).first()[0]
    assert text("rag") == "Вопрос пользователя:\nq\n\nОтвет юриста:\na\n\n"
    assert text("record").endswith("\n\nВопрос гражданина:\nq\n\nОтвет юриста:\na")
    with pytest.raises(ValueError):
        pr.context_text(F.lit(None), "nothing")


def test_bounded_rerank_scores_less(spark):
    """Same places as scoring everything, far fewer pairs; bounds that tell nothing cost nothing but pairs."""
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(60)] + [f"r{i}" for i in range(400)]
    weight = np.r_[np.full(60, 3.0), np.full(400, 1.0)]
    texts = []
    for _ in range(50):  # each with five others that say much the same
        said = rng.choice(vocabulary, rng.integers(8, 40), p=weight / weight.sum())
        texts += [" ".join(np.where(rng.random(len(said)) < 0.15, rng.choice(vocabulary, len(said)), said)) for _ in range(6)]
    texts[7] = ""
    points = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, question string")
    queries = points.filter("id < 20").select(F.col("id").alias("qid"), F.col("question").alias("q_question"))
    pairs = queries.crossJoin(points).withColumn("rank", F.col("id") + 1)
    rare = rr.rarest_words(queries.withColumnRenamed("q_question", "question"), points)
    pairs = pairs.join(rare, "qid", "left")

    def scorer():
        def run(batch):
            sets = [[{w for w in text.split(" ") if w} for text in pair] for pair in batch]
            return [len(a & b) / len(a | b) if a | b else 0.0 for a, b in sets]

        return run

    every = rt.rerank(pairs).filter("rank <= 5").select("qid", "id", "rank")
    wanted = sorted(map(tuple, every.collect()))
    bound = rr.overlap_bound(F.col("q_question"), F.col("question"), F.col("rare"))
    got = rr.bounded_rerank(pairs, scorer, bound, 5).persist()
    assert sorted((r.qid, r.id, r["rank"]) for r in got.collect()) == wanted
    seen = got.select("qid", "scored").distinct().agg(F.sum("scored")).first()[0]
    assert seen < 0.4 * 20 * 300
    idle = rr.bounded_rerank(pairs, scorer, F.lit(1.0), 5)
    assert sorted((r.qid, r.id, r["rank"]) for r in idle.collect()) == wanted and idle.first().scored == 300
    got.unpersist()


def test_bounded_rerank_tells_failing_pairs(spark):
    rows = [(1, i, i + 1, "q", "bad" if i == 2 else f"c{i}") for i in range(6)]
    ranked = spark.createDataFrame(rows, "qid long, id long, rank long, q_question string, question string")

    def scorer():
        def run(batch):
            if any(b == "bad" for _, b in batch):
                raise ValueError("no")
            return [int(b[1:]) / 10 for _, b in batch]

        return run

    got = rr.bounded_rerank(ranked, scorer, F.lit(1.0), 2, attempts=1, pause=0.0).collect()
    assert [(r.id, r.pair_score, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(5, 0.5, 1), (4, 0.4, 2), (2, None, 3)]


def test_bounded_rerank_streams_its_groups(spark):
    """Questions that go on over several batches are one group; the scorer is made once a task, not once a question."""
    made = spark.sparkContext.accumulator(0)

    def make():
        made.add(1)
        return lambda pairs: [len(b) % 5 / 5 for _, b in pairs]

    rows = [(q, i, i + 1, "q", "x" * ((q * i) % 7)) for q in range(40) for i in range(9)]
    ranked = spark.createDataFrame(rows, "qid long, id long, rank long, q_question string, question string")
    former = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = rr.bounded_rerank(ranked, make, F.lit(1.0), 3).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", former)
    assert 0 < made.value <= 8
    for q in range(40):
        want = sorted((-(len(r[4]) % 5 / 5), r[2], r[1]) for r in rows if r[0] == q)[:3]
        assert sorted((r["rank"], r.id, r.scored) for r in got if r.qid == q) == [(n + 1, w[2], 9) for n, w in enumerate(want)]
