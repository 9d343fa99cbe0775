"""Nearest-neighbour joins, fusion, re-ranking, records and search comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import models
from threadloom.functions import text as tx
from threadloom.functions import vectors as vx
from threadloom.operators import ordering, reranking as rr, retrieval as rt, stats
from threadloom.operators.knn import dense_topk
from threadloom.operators.postings import dealt, join_topk, load_index, search
from threadloom.plans import inputs
from threadloom.plans.inputs import (
    DENSE,
    POINTS,
    SPARSE,
    TERMS,
    fused,
    hybrid_points,
    points,
    ranked,
    restricted,
    with_,
)
from threadloom.plans.registry import query
from threadloom.session import scratch_path
from threadloom.sources import tables as tb

RANKING = "SELECT qid, id, score, rank FROM "


def self_queries(pts):
    """Every stored point asks with its own vectors."""
    return pts.withColumnRenamed("id", "qid")


# --- scoring expressions ------------------------------------------------------


@query(
    "h16_vector_norm",
    """SELECT vec_id, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm
FROM embeddings""",
)
def h16(spark, sf_dir):
    vectors = inputs.table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", F.round(vx.norm(F.col("embedding")), 6).alias("norm"))


# --- dense, sparse, cascades, fusion --------------------------------------------


@query(
    "c1_dense_topk",
    with_(
        """vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""",
        """dense AS (SELECT q.vec_id AS qid, p.vec_id AS id, round(list_cosine_similarity(q.v, p.v), 6) + 0.0 AS score
           FROM vectors q, vectors p)""",
        ranked("best", "dense", 10),
    )
    + RANKING
    + "best",
)
def c1(spark, sf_dir):
    vectors = inputs.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("dense")
    )
    return dense_topk(self_queries(vectors), vectors, 10)


DOCUMENT_TERMS = """
doc_terms AS (
  SELECT doc_id AS id, term, CAST(count(*) AS DOUBLE) AS w
  FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents)
  WHERE term <> '' GROUP BY ALL),
item_terms AS (
  SELECT item_id AS qid, term, CAST(count(*) AS DOUBLE) AS w
  FROM (SELECT item_id, unnest(string_split(lower(text), ' ')) AS term FROM benchmark)
  WHERE term <> '' GROUP BY ALL),
sparse AS (
  SELECT qid, id, round(sum(q.w * d.w), 6) AS score FROM item_terms q JOIN doc_terms d USING (term) GROUP BY 1, 2)"""


@query("c2_sparse_topk", with_(DOCUMENT_TERMS, ranked("best", "sparse", 100)) + RANKING + "best")
def c2(spark, sf_dir):
    docs = dealt(inputs.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    items = inputs.table(spark, sf_dir, "benchmark")
    lists = models.lexical_rows(docs, "doc_id", "text", ("id", "term", "weight"))
    return join_topk(models.lexical_rows(items, "item_id", "text", ("qid", "term", "asked")), lists, 100)


BOTH = (POINTS, TERMS, DENSE, SPARSE)


@query("c2_stored_postings", with_(POINTS, TERMS, SPARSE, ranked("best", "sparse", 20)) + RANKING + "best")
def c2_stored(spark, sf_dir):
    """The lists that a replaced collection keeps answer the search."""
    path = scratch_path(spark, "collection")
    tb.replace_collection(hybrid_points(spark, sf_dir), path, dim=64)
    pts = tb.read_parts(spark, f"{path}/points")
    return search(self_queries(pts), load_index(spark, f"{path}/postings"), 20, worth=0)



@query(
    "c3_dense_then_sparse",
    with_(*BOTH, ranked("near", "dense", 50), restricted("kept", "near", "sparse"), ranked("best", "kept", 20))
    + RANKING
    + "best",
)
def c3(spark, sf_dir):
    pts = hybrid_points(spark, sf_dir)
    return rt.dense_sparse(self_queries(pts), pts, limit_dense=50, limit_sparse=20)


@query(
    "c4_sparse_then_dense",
    with_(*BOTH, ranked("near", "sparse", 50), restricted("kept", "near", "dense"), ranked("best", "kept", 20))
    + RANKING
    + "best",
)
def c4(spark, sf_dir):
    pts = hybrid_points(spark, sf_dir)
    return rt.sparse_dense(self_queries(pts), pts, limit_sparse=50, limit_dense=20)


@query(
    "c5_rank_fusion",
    with_(*BOTH, ranked("s", "sparse", 100), ranked("d", "dense", 100), fused("best", ["s", "d"], 100))
    + RANKING
    + "best",
)
def c5(spark, sf_dir):
    pts = hybrid_points(spark, sf_dir)
    return rt.hybrid(self_queries(pts), pts, 100)


@query(
    "c6_single_list_fusion",
    with_(POINTS, DENSE, ranked("d", "dense", 20), fused("best", ["d"], 20)) + RANKING + "best",
)
def c6(spark, sf_dir):
    pts = points(spark, sf_dir)
    return rt.fuse([dense_topk(self_queries(pts), pts, 20)], 20)


@query(
    "c7_overfetch_drop_first",
    with_(POINTS, DENSE, ranked("d", "dense", 8)) + "SELECT qid, id, rank FROM d WHERE rank BETWEEN 2 AND 8",
)
def c7(spark, sf_dir):
    pts = points(spark, sf_dir)
    limit = 3
    return (
        dense_topk(self_queries(pts), pts, limit + 5).filter(F.col("rank") >= 2).select("qid", "id", "rank")
    )


@query(
    "c8_retriever_by_name",
    with_(POINTS, TERMS, SPARSE, ranked("best", "sparse", 10)) + RANKING + "best",
)
def c8(spark, sf_dir):
    pts = hybrid_points(spark, sf_dir)
    return rt.retriever("sparse_queary", k=10)(self_queries(pts), pts)


@query("c19_query_by_stored_id", with_(POINTS, DENSE, ranked("d", "dense", 5)) + """SELECT d.qid, d.id, d.rank
FROM d JOIN labels l ON l.doc_id = d.qid""")
def c19(spark, sf_dir):
    pts = points(spark, sf_dir)
    ids = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return dense_topk(rt.queries_by_id(pts, ids), pts, 5).select("qid", "id", "rank")


@query("f2_topk_per_query", with_(POINTS, DENSE, ranked("d", "dense", 50)) + "SELECT qid, count(*) AS n, max(rank) AS deepest FROM d GROUP BY 1")
def f2(spark, sf_dir):
    pts = points(spark, sf_dir)
    found = dense_topk(self_queries(pts), pts, 50)
    return found.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n"), F.max("rank").cast("bigint").alias("deepest")
    )


# --- re-ranking and records ---------------------------------------------------------

OVERLAP = """round(len(list_intersect(q.words, p.words)) / (len(q.words) + len(p.words) - len(list_intersect(q.words, p.words))), 6)"""

WORDS = """
word_sets AS (
  SELECT id, question, answer, rating,
         list_distinct(list_filter(string_split(lower(question), ' '), lambda w: w <> '')) AS words
  FROM points)"""

LENGTH_RATIO = "round(least(length(q.question), length(p.question)) / greatest(length(q.question), length(p.question)), 6)"


def reranked(name: str, source: str, score: str = OVERLAP, k: int = 1_000_000) -> str:
    return f"""
{name} AS (
  SELECT qid, id, again AS rank FROM (
    SELECT c.qid, c.id, row_number() OVER (PARTITION BY c.qid ORDER BY {score} DESC, c.rank) AS again
    FROM {source} c JOIN word_sets q ON q.id = c.qid JOIN word_sets p ON p.id = c.id)
  WHERE again <= {k})"""


def context(name: str, source: str, limit: int = 3) -> str:
    """Over-fetched list without its first place and without repeated questions."""
    return f"""
{name} AS (
  SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY rank) AS rank
  FROM (SELECT c.qid, c.id, c.rank FROM {source} c JOIN points q ON q.id = c.qid JOIN points p ON p.id = c.id
        WHERE c.rank BETWEEN 2 AND {limit + 5} AND p.question <> q.question))"""


@query(
    "c9_rerank",
    with_(POINTS, WORDS, DENSE, ranked("d", "dense", 10), reranked("best", "d")) + "SELECT qid, id, rank FROM best",
)
def c9(spark, sf_dir):
    pts = points(spark, sf_dir)
    queries = self_queries(pts)
    found = rt.attach_payload(dense_topk(queries, pts, 10), queries, pts)
    return rt.rerank(found).select("qid", "id", "rank")


@query(
    "e3_rank_by_score",
    with_(POINTS, WORDS, DENSE, ranked("d", "dense", 20), reranked("best", "d", LENGTH_RATIO))
    + "SELECT qid, id, rank FROM best",
)
def e3(spark, sf_dir):
    pts = points(spark, sf_dir)
    queries = self_queries(pts)
    found = rt.attach_payload(dense_topk(queries, pts, 20), queries, pts)
    return rt.rerank(found, rt.length_ratio).select("qid", "id", "rank")


@query(
    "c9_bounded_rerank",
    with_(POINTS, WORDS, DENSE, ranked("d", "dense", 50), reranked("best", "d", k=5)) + "SELECT qid, id, rank FROM best",
)
def c9_bounded(spark, sf_dir):
    """The best five of fifty by a caller's scorer, which sees only pairs that may be among them."""
    return bounded_context(spark, sf_dir, 50, 5).select("qid", "id", "rank")


def bounded_context(spark, sf_dir, k, n):
    pts = points(spark, sf_dir)
    queries = self_queries(pts)
    found = rt.attach_payload(dense_topk(queries, pts, k), queries, pts).join(rr.rarest_words(queries, pts), "qid", "left")
    bound = rr.overlap_bound(F.col("q_question"), F.col("question"), F.col("rare"))
    return rr.bounded_rerank(found, overlap_model, bound, n).drop("rare")


@query(
    "c14_bounded_two_stage",
    with_(
        POINTS, WORDS, DENSE, ranked("d", "dense", 20), reranked("first", "d", k=8),
        reranked("second", "first", LENGTH_RATIO, 8),
    )
    + "SELECT qid, id, rank FROM second",
)
def c14_bounded(spark, sf_dir):
    first = bounded_context(spark, sf_dir, 20, 8).drop("pair_score", "scored")
    return rt.rerank(first, rt.length_ratio).select("qid", "id", "rank")


@query(
    "c14_two_stage_rerank",
    with_(
        POINTS, WORDS, DENSE, ranked("d", "dense", 20), reranked("first", "d", k=8),
        reranked("second", "first", LENGTH_RATIO, 8),
    )
    + "SELECT qid, id, rank FROM second",
)
def c14(spark, sf_dir):
    pts = points(spark, sf_dir)
    queries = self_queries(pts)
    found = rt.attach_payload(dense_topk(queries, pts, 20), queries, pts)
    return rt.two_stage_rerank(found, rt.token_overlap, rt.length_ratio, 8).select("qid", "id", "rank")


def record_text(column: str = "record"):
    """Record as one comparable text."""
    return F.concat(
        F.col(f"{column}.question_answer.answer"),
        F.lit(" <- "),
        F.array_join(F.transform(f"{column}.context", lambda c: c["answer"]), ", "),
    )


def record_sql(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT qid, 'answer ' || qid || ' <- ' || string_agg('answer ' || id, ', ' ORDER BY rank) AS record
  FROM {source} GROUP BY qid)"""


DENSE_CONTEXT = (POINTS, WORDS, DENSE, ranked("d", "dense", 100), context("ctx", "d"))


@query(
    "b13_drop_same_question",
    with_(*DENSE_CONTEXT) + "SELECT qid, id, rank FROM ctx",
)
def b13(spark, sf_dir):
    pts = points(spark, sf_dir)
    queries = self_queries(pts)
    found = rt.context_rows(queries, pts, dense_topk(queries, pts, 100))
    return found.select("qid", "id", "rank")


@query(
    "b14_empty_context_is_null",
    with_(*DENSE_CONTEXT, record_sql("built", "ctx"))
    + """SELECT d.doc_id AS id, b.record IS NULL AS missing FROM documents d LEFT JOIN built b ON b.qid = d.doc_id""",
)
def b14(spark, sf_dir):
    ids = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    pts = points(spark, sf_dir)
    built = rt.create_records(pts, ids, "dense_query")
    return built.select("id", F.col("record").isNull().alias("missing"))


@query(
    "c10_record",
    with_(*DENSE_CONTEXT, record_sql("built", "ctx")) + "SELECT qid AS id, record FROM built",
)
def c10(spark, sf_dir):
    pts = points(spark, sf_dir)
    built = rt.create_records(pts, pts.select("id"), "dense_query")
    return built.filter(F.col("record").isNotNull()).select("id", record_text().alias("record"))


@query(
    "c11_records_of_id_list",
    with_(*DENSE_CONTEXT, reranked("again", "ctx"), record_sql("built", "again"))
    + """SELECT l.doc_id AS id, b.record FROM labels l LEFT JOIN built b ON b.qid = l.doc_id""",
)
def c11(spark, sf_dir):
    ids = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    built = rt.create_records(points(spark, sf_dir), ids, "dense_query", use_reranker=True)
    return built.select("id", record_text().alias("record"))


@query(
    "c11_repeated_ids",
    with_(*DENSE_CONTEXT, reranked("again", "ctx"), record_sql("built", "again"))
    + """SELECT l.doc_id AS id, b.record FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id FROM labels WHERE doc_id % 4 = 0) l LEFT JOIN built b ON b.qid = l.doc_id""",
)
def c11_repeated(spark, sf_dir):
    """Ids given up to three times: one row per given id, each with the record of its point."""
    once = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    ids = once.unionByName(once.where("id % 2 = 0")).unionByName(once.where("id % 4 = 0"))
    built = rt.create_records(points(spark, sf_dir), ids, "dense_query", use_reranker=True)
    return built.select("id", record_text().alias("record"))


SWEEP = with_(
    *BOTH, WORDS,
    ranked("d", "dense", 100), context("c1", "d"), reranked("c2", "c1"),
    ranked("near", "dense", 50), restricted("kept", "near", "sparse"), ranked("ds", "kept", 100),
    context("c3", "ds"), reranked("c4", "c3"),
    record_sql("r1", "c1"), record_sql("r2", "c2"), record_sql("r3", "c3"), record_sql("r4", "c4"),
    """wide AS (
  SELECT l.doc_id AS points, r1.record AS param_dense_query, r2.record AS param_dense_query_rerank,
    r3.record AS param_dense_sparse_query, r4.record AS param_dense_sparse_query_rerank
  FROM labels l LEFT JOIN r1 ON r1.qid = l.doc_id LEFT JOIN r2 ON r2.qid = l.doc_id
  LEFT JOIN r3 ON r3.qid = l.doc_id LEFT JOIN r4 ON r4.qid = l.doc_id)""",
)


def sweep(spark, sf_dir):
    ids = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("points"))
    return rt.sweep(hybrid_points(spark, sf_dir), ids)


def readable(wide):
    return wide.select(
        "points", *[record_text(c).alias(c) for c in rt.columns_with_prefix(wide, "param_")]
    )


@query("c12_sweep", SWEEP + "SELECT * FROM wide")
def c12(spark, sf_dir):
    return readable(sweep(spark, sf_dir))


@query(
    "b16_complete_sweep_rows",
    SWEEP
    + """SELECT * FROM wide WHERE param_dense_query IS NOT NULL AND param_dense_query_rerank IS NOT NULL
AND param_dense_sparse_query IS NOT NULL AND param_dense_sparse_query_rerank IS NOT NULL""",
)
def b16(spark, sf_dir):
    return readable(rt.complete_rows(sweep(spark, sf_dir)))


@query(
    "b17_columns_by_prefix",
    "SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders",
)
def b17(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    orders = orders.withColumnsRenamed({"o_custkey": "param_cust", "o_totalprice": "param_price"})
    return orders.select(*rt.columns_without_prefix(orders, "param_"))


@query(
    "d11_non_null_counts",
    SWEEP
    + """SELECT count(param_dense_query) AS param_dense_query, count(param_dense_query_rerank) AS param_dense_query_rerank,
count(param_dense_sparse_query) AS param_dense_sparse_query,
count(param_dense_sparse_query_rerank) AS param_dense_sparse_query_rerank FROM wide""",
)
def d11(spark, sf_dir):
    wide = sweep(spark, sf_dir)
    return stats.non_null_counts(wide, rt.columns_with_prefix(wide, "param_"))


# --- questions from outside, context rules ----------------------------------------------

QUESTION_CTES = """
question_terms AS (
  SELECT item_id AS qid, term, CAST(count(*) AS DOUBLE) AS w
  FROM (SELECT item_id, unnest(string_split(lower(text), ' ')) AS term FROM benchmark)
  WHERE term <> '' GROUP BY ALL),
qsparse AS (
  SELECT qid, id, round(sum(q.w * d.w), 6) AS score FROM question_terms q JOIN terms d USING (term) GROUP BY 1, 2)"""


def questions(spark, sf_dir):
    return inputs.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"),
        F.col("text").alias("question"),
        models.lexical_weights(F.col("text")).alias("text_sparse"),
    )


QUESTION_BEST = with_(
    POINTS, TERMS, QUESTION_CTES, ranked("s", "qsparse", 100), fused("best", ["s"], 100)
)


@query(
    "c15_question_context",
    QUESTION_BEST
    + """SELECT b.qid, b.id, b.rank, p.answer FROM best b JOIN points p USING (id) WHERE b.rank <= 5""",
)
def c15(spark, sf_dir):
    found = rt.question_context(questions(spark, sf_dir), hybrid_points(spark, sf_dir), "sparse_queary")
    return found.select("qid", "id", "rank", "answer")


@query("c15_encoded_question_context")
def c15_encoded(spark, sf_dir):
    """Questions and points encoded by the stand-in model, dense then sparse."""
    encoded = models.encode_column(F.col("question"))
    items = inputs.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("question")
    )
    pts = points(spark, sf_dir).drop("dense")
    as_vectors = lambda df: df.withColumn("_e", encoded).select(
        *df.columns, F.col("_e.dense").alias("dense"), F.col("_e.lexical").alias("text_sparse")
    )
    found = rt.question_context(as_vectors(items), as_vectors(pts), "dense_sparse_query", scorer=rt.token_overlap)
    return found.select("qid", "id", "rank", "answer")


NEIGHBOURS = (POINTS, DENSE, ranked("d", "dense", 5))

NEIGHBOUR_ROWS = """
n AS (
  SELECT d.qid, d.id, d.rank, p.question, q.question AS q_question FROM d
  JOIN points p ON p.id = d.id JOIN points q ON q.id = d.qid),
flags AS (
  SELECT qid, coalesce(max(CASE WHEN rank = 2 THEN question END) = max(CASE WHEN rank = 1 THEN question END), false) AS same_first,
    coalesce(max(CASE WHEN rank = 2 THEN question END) = max(q_question), false) AS same_own
  FROM n GROUP BY 1)"""


def _neighbours(spark, sf_dir, limit=5):
    pts = points(spark, sf_dir)
    return rt.neighbours(self_queries(pts), pts, limit)


@query(
    "c16_dataset_neighbour_rule",
    with_(*NEIGHBOURS, NEIGHBOUR_ROWS)
    + """SELECT qid, id, rank FROM n JOIN flags USING (qid)
WHERE CASE WHEN same_first THEN rank BETWEEN 3 AND 5 ELSE rank = 2 END""",
)
def c16(spark, sf_dir):
    return rt.dataset_rule(_neighbours(spark, sf_dir)).select("qid", "id", "rank")


@query(
    "c17_benchmark_neighbour_rule",
    with_(*NEIGHBOURS, NEIGHBOUR_ROWS)
    + """SELECT qid, id, rank FROM n JOIN flags USING (qid)
WHERE CASE WHEN same_own THEN rank BETWEEN 3 AND 5 ELSE rank BETWEEN 2 AND 5 END""",
)
def c17(spark, sf_dir):
    return rt.benchmark_rule(_neighbours(spark, sf_dir)).select("qid", "id", "rank")


@query(
    "c18_few_shot_rule",
    with_(POINTS, DENSE, ranked("d", "dense", 10)) + "SELECT qid, id, rank FROM d WHERE rank BETWEEN 2 AND 4",
)
def c18(spark, sf_dir):
    return rt.few_shot_rule(_neighbours(spark, sf_dir, 10)).select("qid", "id", "rank")


# --- comparison of search modes -----------------------------------------------------------

MODES = with_(
    *BOTH,
    ranked("d1000", "dense", 1000), ranked("s1000", "sparse", 1000),
    "d AS (SELECT * FROM d1000 WHERE rank <= 100)", "s AS (SELECT * FROM s1000 WHERE rank <= 100)",
    restricted("sd0", "s1000", "dense"), ranked("sd", "sd0", 100),
    restricted("ds0", "d1000", "sparse"), ranked("ds", "ds0", 100),
    fused("f1", ["d"], 100), fused("f2", ["s"], 100), fused("f3", ["s", "d"], 100),
    fused("f4", ["sd"], 100), fused("f5", ["ds"], 100),
    """modes AS (
  SELECT 'dense' AS mode, qid, id, rank - 1 AS rank FROM f1 UNION ALL SELECT 'sparse', qid, id, rank - 1 FROM f2
  UNION ALL SELECT 'sparse+dense', qid, id, rank - 1 FROM f3 UNION ALL SELECT 'sparce_dense', qid, id, rank - 1 FROM f4
  UNION ALL SELECT 'dence_sparse', qid, id, rank - 1 FROM f5),
shown AS (SELECT m.*, p.question FROM modes m JOIN points p USING (id) WHERE m.rank BETWEEN 1 AND 5)""",
)


def _modes(spark, sf_dir):
    pts = hybrid_points(spark, sf_dir)
    return rt.compare_modes(self_queries(pts), pts, n=5)


def compare_rows(spark, sf_dir):
    return _modes(spark, sf_dir).select(
        "mode", "qid", "id", F.col("rank").cast("bigint").alias("rank"), "question"
    )


@query("c13_search_comparison", MODES + "SELECT mode, qid, id, rank FROM shown")
def c13(spark, sf_dir):
    return compare_rows(spark, sf_dir).drop("question")


@query(
    "c20_numbered_documents",
    MODES
    + r"""SELECT mode, qid, string_agg('Документ ' || rank || E'\n\n\n' || question || E'\n\n\n', '' ORDER BY rank) AS texts
FROM shown GROUP BY 1, 2""",
)
def c20(spark, sf_dir):
    return rt.comparison_table(_modes(spark, sf_dir)).select("mode", "qid", "texts")


@query(
    "d9_retrieved_length",
    MODES + "SELECT mode, qid, CAST(sum(length(question)) AS BIGINT) AS total_chars FROM shown GROUP BY 1, 2",
)
def d9(spark, sf_dir):
    return stats.scored_length(_modes(spark, sf_dir), ["mode", "qid"], "question")


# --- point filters, look-ups, samples --------------------------------------------------------


@query("a8_lookup", with_(POINTS) + """SELECT p.id, p.answer, p.rating, round(list_sum(p.dense), 6) AS dense_sum
FROM points p JOIN labels l ON l.doc_id = p.id""")
def a8(spark, sf_dir):
    ids = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    found = rt.lookup(points(spark, sf_dir), ids)
    return found.select("id", "answer", "rating", F.round(vx.array_sum(F.col("dense")), 6).alias("dense_sum"))


@query("a9_filtered_scroll", with_(POINTS) + "SELECT id, answer, rating FROM points WHERE rating >= 7 ORDER BY id LIMIT 50")
def a9(spark, sf_dir):
    return rt.scroll(points(spark, sf_dir), 7, 50).select("id", "answer", "rating")


@query("b11_range_filter", with_(POINTS) + "SELECT id, rating FROM points WHERE rating >= 5")
def b11(spark, sf_dir):
    return rt.scroll(points(spark, sf_dir), 5).select("id", "rating")


@query("a10_random_sample", with_(POINTS) + "SELECT id FROM points ORDER BY md5('42:' || id), id LIMIT 100")
def a10(spark, sf_dir):
    return ordering.random_sample(points(spark, sf_dir).select("id"), "id", 100)


@query(
    "b12_filter_after_sample",
    with_(POINTS, "sampled AS (SELECT * FROM points ORDER BY md5('42:' || id), id LIMIT 100)")
    + "SELECT id, rating FROM sampled WHERE rating > 5",
)
def b12(spark, sf_dir):
    sampled = ordering.random_sample(points(spark, sf_dir).select("id", "rating"), "id", 100)
    return sampled.filter("rating > 5")


def failing_model():
    """A caller's pair scorer that cannot score some pairs, and with one of them no batch."""
    score = overlap_model()

    def run(pairs):
        if any((len(a) + len(b)) % 11 == 0 for a, b in pairs):
            raise ValueError("cannot score")
        return score(pairs)

    return run


@query(
    "b15_row_error_is_null",
    with_(
        *DENSE_CONTEXT,
        """failed AS (SELECT DISTINCT c.qid FROM ctx c JOIN points q ON q.id = c.qid JOIN points p ON p.id = c.id
    WHERE (length(q.question) + length(p.question)) % 11 = 0)""",
        reranked("again", "ctx"), record_sql("built", "again"),
    )
    + """SELECT l.doc_id AS id, CASE WHEN f.qid IS NULL THEN b.record END AS record
FROM labels l LEFT JOIN built b ON b.qid = l.doc_id LEFT JOIN failed f ON f.qid = l.doc_id""",
)
def b15(spark, sf_dir):
    """The error of a record leaves NULL in its place; unknown ids do too."""
    ids = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    model = models.pair_scorer(failing_model, attempts=1, pause=0.0)
    scorer = lambda question, candidate: F.round(model(question, candidate), 6)
    built = rt.create_records(points(spark, sf_dir), ids, "dense_query", use_reranker=True, scorer=scorer)
    return built.select("id", record_text().alias("record"))


@query("b19_equality_lookup", "SELECT doc_id, quality IS NULL AS unlabelled FROM documents LEFT JOIN labels USING (doc_id) WHERE quality = 1 OR quality IS NULL")
def b19(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id")
    labelled = docs.join(inputs.table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    kept = labelled.filter((F.col("quality") == 1) | F.col("quality").isNull())
    return kept.select("doc_id", F.col("quality").isNull().alias("unlabelled"))


@query(
    "j1_encoder",
    """SELECT doc_id, 64 AS dim, CAST(len(list_distinct(list_filter(string_split(lower(text), ' '), lambda w: w <> ''))) AS INTEGER) AS terms, CAST(NULL AS VARCHAR) AS error FROM documents""",
)
def j1(spark, sf_dir):
    docs = inputs.spread(spark, sf_dir, "documents")
    encoded = docs.select("doc_id", models.encode_column(F.col("text")).alias("e"))
    return encoded.select(
        "doc_id", F.size("e.dense").alias("dim"), F.size("e.lexical").alias("terms"), F.col("e.error").alias("error")
    )


@query(
    "j1_lexical_weights",
    """SELECT doc_id AS id, term, CAST(count(*) AS DOUBLE) AS weight
FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents) WHERE term <> '' GROUP BY ALL""",
)
def j1_lexical(spark, sf_dir):
    docs = inputs.spread(spark, sf_dir, "documents")
    return models.lexical_rows(docs, "doc_id", "text", ("id", "term", "weight"))


@query(
    "j1_lexical_maps",
    """SELECT doc_id AS id, CAST(count(*) AS INTEGER) AS terms, CAST(sum(n) AS DOUBLE) AS words
FROM (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents) WHERE term <> '' GROUP BY ALL) GROUP BY 1""",
)
def j1_lexical_maps(spark, sf_dir):
    docs = inputs.spread(spark, sf_dir, "documents").select("doc_id", models.lexical_weights(F.col("text")).alias("w"))
    return docs.select(F.col("doc_id").alias("id"), F.size("w").alias("terms"), vx.array_sum(F.map_values("w")).alias("words"))


@query(
    "j2_pair_score",
    with_(POINTS, WORDS, DENSE, ranked("d", "dense", 3))
    + f"SELECT d.qid, d.id, {OVERLAP} AS score FROM d JOIN word_sets q ON q.id = d.qid JOIN word_sets p ON p.id = d.id",
)
def j2(spark, sf_dir):
    found = _neighbours(spark, sf_dir, 3)
    return found.select("qid", "id", rt.token_overlap(F.col("q_question"), F.col("question")).alias("score"))


def overlap_model():
    """A caller's pair scorer: shared distinct words over all distinct words."""

    def score(pairs):
        sets = [[{w for w in text.lower().split(" ") if w} for text in pair] for pair in pairs]
        return [len(a & b) / len(a | b) if a | b else 0.0 for a, b in sets]

    return score


@query(
    "j2_caller_scorer",
    with_(POINTS, WORDS, DENSE, ranked("d", "dense", 3))
    + f"SELECT d.qid, d.id, {OVERLAP} AS score FROM d JOIN word_sets q ON q.id = d.qid JOIN word_sets p ON p.id = d.id",
)
def j2_caller(spark, sf_dir):
    scorer = models.pair_scorer(overlap_model)
    score = F.round(scorer(F.col("q_question"), F.col("question")), 6)
    return _neighbours(spark, sf_dir, 3).select("qid", "id", score.alias("score"))


@query("h15_token_count", "SELECT doc_id, len(list_filter(string_split(text, ' '), lambda w: w <> '')) AS n_tokens FROM documents")
def h15(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select("doc_id", models.token_count(F.col("text")).alias("n_tokens"))


@query(
    "j7_tokenizer",
    f"SELECT doc_id, array_to_string({inputs.word_ids_sql('text')}, ' ') AS ids FROM documents",
)
def j7(spark, sf_dir):
    docs = inputs.spread(spark, sf_dir, "documents")
    ids = models.word_ids(F.col("text")).cast("array<string>")
    return docs.select("doc_id", F.array_join(ids, " ").alias("ids"))


@query(
    "h4_labelled_context",
    with_(*DENSE_CONTEXT)
    + r"""SELECT qid, string_agg('Документ ' || rank || E'\n\n\n' || p.question || E'\n\n\n', '' ORDER BY rank) AS texts
FROM ctx JOIN points p USING (id) GROUP BY 1""",
)
def h4(spark, sf_dir):
    pts = points(spark, sf_dir)
    queries = self_queries(pts)
    found = rt.context_rows(queries, pts, dense_topk(queries, pts, 100))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("rank", "question"))), lambda r: r["question"])
    return found.groupBy("qid").agg(tx.numbered_documents(texts).alias("texts"))


def hashed_words():
    """A caller's tokenizer: words hashed like the built-in one."""
    import hashlib

    return lambda text: [int(hashlib.md5(w.encode()).hexdigest()[:15], 16) for w in text.split(" ") if w]


@query(
    "j7_caller_tokenizer",
    f"SELECT doc_id, array_to_string({inputs.word_ids_sql('text')}, ' ') AS ids FROM documents",
)
def j7_caller(spark, sf_dir):
    docs = inputs.spread(spark, sf_dir, "documents")
    ids = models.tokenizer_udf(hashed_words)(F.col("text")).cast("array<string>")
    return docs.select("doc_id", F.array_join(ids, " ").alias("ids"))
