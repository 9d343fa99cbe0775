"""Retrieval: rankings, cascades, fusion, re-ranking, records, context rules.

A ranking is a table (qid, id, score, rank). Every step works on all questions
at once; only lists of at most ``limit`` neighbours are nested per question.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.functions import text as tx
from threadloom.operators.blocks import kept
from threadloom.operators.knn import ROUND_DIGITS, best_per_query, dense_topk, topk_among
from threadloom.operators.postings import sparse_topk

Scorer = Callable[[Column, Column], Column]

# Constant of the reciprocal-rank-fusion paper.
RRF_K = 60


def sparse_among(candidates: DataFrame, queries: DataFrame, points: DataFrame, k: int, stored: bool = False) -> DataFrame:
    """Candidates re-ranked by term weights."""
    return topk_among(candidates, queries, points, k, "sparse", "text_sparse", stored=stored)


def dense_among(candidates: DataFrame, queries: DataFrame, points: DataFrame, k: int, stored: bool = False) -> DataFrame:
    """Candidates re-ranked by cosine."""
    return topk_among(candidates, queries, points, k, "dense", "dense", stored=stored)


def dense_sparse(
    queries: DataFrame, points: DataFrame, limit_dense: int = 1000, limit_sparse: int = 100
) -> DataFrame:
    """Dense candidates, re-ranked by term weights."""
    candidates = dense_topk(queries, points, limit_dense, nested=True)
    return sparse_among(candidates, queries, points, limit_sparse)


def sparse_dense(
    queries: DataFrame, points: DataFrame, limit_sparse: int = 1000, limit_dense: int = 100
) -> DataFrame:
    """Sparse candidates, re-ranked by cosine."""
    candidates = sparse_topk(queries, points, limit_sparse, nested=True)
    return dense_among(candidates, queries, points, limit_dense)


def fuse(rankings: Sequence[DataFrame], limit: int = 100, k: int = RRF_K) -> DataFrame:
    """Reciprocal-rank fusion. One ranking keeps its order."""
    parts = [r.select("qid", "id", "rank") for r in rankings]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    fused = stacked.groupBy("qid", "id").agg(
        F.round(F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank"))), 12).alias("score")
    )
    return best_per_query(fused, limit)


def hybrid(queries: DataFrame, points: DataFrame, limit: int = 100, k: int = RRF_K) -> DataFrame:
    """Sparse and dense lists fused."""
    return fuse([sparse_topk(queries, points, limit), dense_topk(queries, points, limit)], limit, k)


RETRIEVERS: dict[str, Callable[..., DataFrame]] = {
    # Retriever names, spelled as callers pass them.
    "sparse_queary": sparse_topk,
    "dense_query": dense_topk,
    "dense_sparse_query": dense_sparse,
}


def retriever(name: str, **settings) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Retriever by name; an unknown name fails before anything runs."""
    try:
        chosen = RETRIEVERS[name]
    except KeyError:
        raise ValueError(f"unknown retriever {name!r}, choose one of {sorted(RETRIEVERS)}") from None
    return lambda queries, points: chosen(queries, points, **settings)


def queries_by_id(points: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Stored points used as questions with their own vectors."""
    # an id asked for twice is one question
    wanted = ids.select(F.col(id_col).alias("id")).distinct()
    return points.join(wanted, "id").withColumnRenamed("id", "qid")


def lookup(points: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Points of an id list, with payload and vectors."""
    return points.join(ids.select(F.col(id_col).alias("id")), "id")


def scroll(points: DataFrame, min_rating: float, limit: int | None = None) -> DataFrame:
    """Points with rating >= the bound; in id order when limited."""
    kept = points.filter(F.col("rating") >= min_rating)
    return kept if limit is None else kept.orderBy("id").limit(limit)


def token_overlap(question: Column, candidate: Column) -> Column:
    """Offline pair scorer: shared distinct words over all distinct words."""
    a = F.array_distinct(tx.words(F.lower(question)))
    b = F.array_distinct(tx.words(F.lower(candidate)))
    union = F.size(F.array_union(a, b))
    return F.when(
        union > 0, F.round(F.size(F.array_intersect(a, b)) / union, ROUND_DIGITS)
    ).otherwise(F.lit(0.0))


def length_ratio(question: Column, candidate: Column) -> Column:
    """Second offline pair scorer: shorter length over longer length."""
    a, b = F.length(question), F.length(candidate)
    return F.when(
        F.greatest(a, b) > 0, F.round(F.least(a, b) / F.greatest(a, b), ROUND_DIGITS)
    ).otherwise(F.lit(0.0))


def rerank(
    ranked: DataFrame, scorer: Scorer = token_overlap, question: str = "q_question", text: str = "question"
) -> DataFrame:
    """New rank by pair score; equal scores keep their former order."""
    order = Window.partitionBy("qid").orderBy(F.desc("pair_score"), "rank")
    return (
        ranked.withColumn("pair_score", scorer(F.col(question), F.col(text)))
        .withColumn("_r", F.row_number().over(order).cast("bigint"))
        .drop("rank")
        .withColumnRenamed("_r", "rank")
    )


def two_stage_rerank(ranked: DataFrame, first: Scorer | None, second: Scorer, n: int) -> DataFrame:
    """The second scorer sees the first one's best ``n``, or everything without a first."""
    if first is not None:
        ranked = rerank(ranked, first).filter(F.col("rank") <= n)
    return rerank(ranked, second).filter(F.col("rank") <= n)


def attach_payload(ranking: DataFrame, queries: DataFrame, points: DataFrame) -> DataFrame:
    """Candidate payload and the question's own text next to each rank."""
    found = ranking.select("qid", "id", "rank").join(
        points.select("id", "question", "answer", "rating"), "id"
    )
    return found.join(queries.select("qid", F.col("question").alias("q_question")), "qid")


def context_rows(
    queries: DataFrame,
    points: DataFrame,
    ranking: DataFrame,
    limit: int = 3,
    scorer: Scorer | None = None,
) -> DataFrame:
    """Ranked context of each question, as rows.

    The list is over-fetched by five, its first place (taken to be the
    question itself) is dropped by position, and candidates with the
    question's text are removed before re-ranking.
    """
    fused = fuse([ranking], limit=limit + 5)
    kept = attach_payload(fused.filter(F.col("rank") >= 2), queries, points)
    kept = kept.filter(F.col("question") != F.col("q_question"))
    if scorer is not None:
        return reranked_context(kept, scorer)
    order = Window.partitionBy("qid").orderBy("rank")
    return kept.withColumn("_r", F.row_number().over(order).cast("bigint")).drop("rank").withColumnRenamed("_r", "rank")


def reranked_context(context: DataFrame, scorer: Scorer) -> DataFrame:
    """Context in the order of pair scores; a question with a pair that could not be scored has none.

    Its record is NULL then, and every other question keeps its own.
    """
    failed = F.count_if(F.col("pair_score").isNull()).over(Window.partitionBy("qid"))
    return rerank(context, scorer).withColumn("_failed", failed).filter(F.col("_failed") == 0).drop("_failed")


PAYLOAD_FIELDS = ("question", "answer", "rating")


def records(ids: DataFrame, queries: DataFrame, context: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, record): NULL when the id is unknown or its context is empty."""
    nested = context.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", *PAYLOAD_FIELDS))).alias("_c")
    )
    record = F.struct(
        F.struct(*PAYLOAD_FIELDS).alias("question_answer"),
        F.transform("_c", lambda c: F.struct(*[c[f].alias(f) for f in PAYLOAD_FIELDS])).alias("context"),
    )
    built = queries.join(nested, "qid").select(F.col("qid").alias(id_col), record.alias("record"))
    return ids.join(built, id_col, "left")


def create_records(
    points: DataFrame,
    ids: DataFrame,
    retriver_type: str,
    use_reranker: bool = False,
    limit: int = 3,
    scorer: Scorer = token_overlap,
    id_col: str = "id",
) -> DataFrame:
    """Retrieval records of an id list in one job."""
    settings = {"limit_dense": 50} if retriver_type == "dense_sparse_query" else {}
    search = retriever(retriver_type, **settings)
    queries = queries_by_id(points, ids, id_col)
    ranking = search(queries, points)
    context = context_rows(queries, points, ranking, limit, scorer if use_reranker else None)
    return records(ids, queries, context, id_col)


DEFAULT_SWEEP = (
    ("dense_query", False),
    ("dense_query", True),
    ("dense_sparse_query", False),
    ("dense_sparse_query", True),
)


def param_name(retriver_type: str, use_rerank: bool) -> str:
    return f"param_{retriver_type}{'_rerank' if use_rerank else ''}"


def sweep(
    points: DataFrame,
    ids: DataFrame,
    settings: Sequence[tuple[str, bool]] = DEFAULT_SWEEP,
    limit: int = 3,
    scorer: Scorer = token_overlap,
    id_col: str = "points",
) -> DataFrame:
    """One ``param_*`` record column per retriever setting.

    The lists of all retrievers are one long table of ids and ranks: it meets the
    payload once, every pair is scored once per list, and one aggregate per
    question turns the settings into columns.
    """
    queries = queries_by_id(points, ids, id_col)
    names = list(dict.fromkeys(name for name, _ in settings))
    long = None
    for name in names:
        extra = {"limit_dense": 50} if name == "dense_sparse_query" else {}
        fused = fuse([retriever(name, **extra)(queries, points)], limit=limit + 5)
        part = fused.filter(F.col("rank") >= 2).select("qid", "id", "rank", F.lit(name).alias("retriever"))
        long = part if long is None else long.unionByName(part)
    asked = queries.select("qid", *[F.col(f).alias(f"q_{f}") for f in PAYLOAD_FIELDS])
    kept = long.join(points.select("id", *PAYLOAD_FIELDS), "id").join(asked, "qid")
    kept = kept.filter(F.col("question") != F.col("q_question"))
    per_list = Window.partitionBy("qid", "retriever")
    placed = kept.withColumn("pair_score", scorer(F.col("q_question"), F.col("question"))).withColumns(
        {
            "_plain": F.row_number().over(per_list.orderBy("rank")),
            "_rerank": F.row_number().over(per_list.orderBy(F.desc("pair_score"), "rank")),
            "_failed": F.count_if(F.col("pair_score").isNull()).over(per_list),
        }
    )
    columns = []
    for name, use_rerank in settings:
        wanted = F.col("retriever") == name
        if use_rerank:  # a list with a pair that could not be scored gives no record
            wanted = wanted & (F.col("_failed") == 0)
        place = F.col("_rerank" if use_rerank else "_plain").alias("rank")
        context = F.array_sort(F.collect_list(F.when(wanted, F.struct(place, *PAYLOAD_FIELDS))))
        columns.append(context.alias(param_name(name, use_rerank)))
    own = F.first(F.struct(*[F.col(f"q_{f}").alias(f) for f in PAYLOAD_FIELDS])).alias("_own")
    nested = placed.groupBy("qid").agg(own, *columns)
    records_of = [
        F.when(
            F.size(param_name(*setting)) > 0,
            F.struct(
                F.col("_own").alias("question_answer"),
                F.transform(param_name(*setting), lambda c: F.struct(*[c[f].alias(f) for f in PAYLOAD_FIELDS])).alias("context"),
            ),
        ).alias(param_name(*setting))
        for setting in settings
    ]
    return ids.join(nested.select(F.col("qid").alias(id_col), *records_of), id_col, "left")


def complete_rows(wide: DataFrame) -> DataFrame:
    """Rows where every sweep column has a record."""
    return wide.dropna(how="any", subset=columns_with_prefix(wide, "param_"))


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def columns_without_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if not c.startswith(prefix)]


# --- context rules of the older data sets -----------------------------------


def neighbours(queries: DataFrame, points: DataFrame, limit: int = 5) -> DataFrame:
    """Nearest stored points of each question with payload and rank."""
    return attach_payload(dense_topk(queries, points, limit), queries, points)


def _with_second_same(ranked: DataFrame, own: Column) -> DataFrame:
    """Flag per question: does the second place repeat the question ``own``?"""
    by_question = Window.partitionBy("qid")
    second = F.max(F.when(F.col("rank") == 2, F.col("question") == own)).over(by_question)
    return ranked.withColumn("_same", F.coalesce(second, F.lit(False)))


def dataset_rule(ranked: DataFrame) -> DataFrame:
    """Top five: a repeated second place keeps 3..5, otherwise only 2 is kept.

    The comparison is with the first place, which is taken as the record.
    """
    first = F.max(F.when(F.col("rank") == 1, F.col("question"))).over(Window.partitionBy("qid"))
    flagged = _with_second_same(ranked.withColumn("_first", first), F.col("_first"))
    keep = F.when(F.col("_same"), F.col("rank").between(3, 5)).otherwise(F.col("rank") == 2)
    return flagged.filter(keep).drop("_same", "_first")


def benchmark_rule(ranked: DataFrame) -> DataFrame:
    """Places 2..5, without the second when it repeats the question."""
    flagged = _with_second_same(ranked, F.col("q_question"))
    keep = F.when(F.col("_same"), F.col("rank").between(3, 5)).otherwise(F.col("rank").between(2, 5))
    return flagged.filter(keep).drop("_same")


def few_shot_rule(ranked: DataFrame) -> DataFrame:
    """Places 2..4 as they are."""
    return ranked.filter(F.col("rank").between(2, 4))


def question_context(
    queries: DataFrame,
    points: DataFrame,
    retriver_type: str = "dense_sparse_query",
    limit: int = 5,
    scorer: Scorer | None = None,
) -> DataFrame:
    """First ``limit`` payloads for each new question (nothing is dropped)."""
    settings = {"limit_dense": 100} if retriver_type == "dense_sparse_query" else {}
    ranking = fuse([retriever(retriver_type, **settings)(queries, points)], limit=100)
    ranked = attach_payload(ranking, queries, points)
    if scorer is not None:
        ranked = rerank(ranked, scorer)
    return ranked.filter(F.col("rank") <= limit)


# --- comparison of search modes ---------------------------------------------


def compare_modes(
    queries: DataFrame, points: DataFrame, n: int = 5, wide_limit: int = 1000, limit: int = 100
) -> DataFrame:
    """Best ``n`` texts per question and search mode, first place dropped.

    Modes: dense, sparse, both fused, sparse then dense, dense then sparse.
    """
    # every search reads the vectors several times, so they are computed once; of the wide lists only ids are read
    asking = kept(queries.select("qid", "dense", "text_sparse"), "asking")
    stored = kept(points.select("id", "dense", "text_sparse"), "stored")
    wide = lambda found, name: kept(found.select("qid", "ids"), name, compression="zstd")
    dense = wide(dense_topk(asking, stored, wide_limit, nested=True), "dense-ranking")
    sparse = wide(sparse_topk(asking, stored, wide_limit, nested=True), "sparse-ranking")
    place = F.posexplode(F.slice("ids", 1, limit)).alias("_place", "id")
    top = lambda lists: lists.select("qid", place).select("qid", "id", (F.col("_place") + 1).cast("bigint").alias("rank"))
    modes = {
        # Mode names, spelled as the result columns are.
        "dense": [top(dense)],
        "sparse": [top(sparse)],
        "sparse+dense": [top(sparse), top(dense)],
        "sparce_dense": [dense_among(sparse, asking, stored, limit, stored=True)],
        "dence_sparse": [sparse_among(dense, asking, stored, limit, stored=True)],
    }
    out = None
    for mode, rankings in modes.items():
        ranked = fuse(rankings, limit).filter(F.col("rank").between(2, limit))
        ranked = ranked.select("qid", "id", (F.col("rank") - 1).alias("rank"), F.lit(mode).alias("mode"))
        out = ranked if out is None else out.unionByName(ranked)
    found = out.join(points.select("id", "question", "answer", "rating"), "id")
    found = found.join(queries.select("qid", F.col("question").alias("q_question")), "qid")
    return found if n is None else found.filter(F.col("rank") <= n)


def comparison_table(rows: DataFrame) -> DataFrame:
    """Per question and mode: numbered texts and their total length."""
    return rows.groupBy("qid", "mode").agg(
        tx.numbered_documents(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "question"))), lambda r: r["question"])
        ).alias("texts"),
        F.sum(F.length("question")).alias("texts_len"),
    )
