"""Re-ranking that scores no more pairs than the wanted places need.

A pair scorer is the costly step of a search. Where a cheap upper bound of the
score is known, candidates are scored in the order of their bounds, and a
question stops once its n-th best score is out of reach of every bound left. The
places are those of scoring everything. A question's candidates are one group of
bounded length (the limit of the search that found them); a task gets its groups
in order and holds one of them besides an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from threadloom.functions import models
from threadloom.functions import text as tx
from threadloom.operators.knn import ROUND_DIGITS

# Words of a question that its bound looks for.
RARE_WORDS = 16
# Pairs of one model call.
BATCH = 8


def rarest_words(queries: DataFrame, points: DataFrame, n: int = RARE_WORDS, qid: str = "qid", text: str = "question") -> DataFrame:
    """(qid, rare): the ``n`` words of each question that the fewest points hold; unknown words come first."""
    said = lambda df, key: df.select(F.col(key).alias(key), F.explode(F.array_distinct(tx.words(F.lower(text)))).alias("word"))
    held = said(points, "id").groupBy("word").agg(F.count(F.lit(1)).alias("points"))
    rank = F.row_number().over(Window.partitionBy(qid).orderBy("points", "word"))
    asked = said(queries, qid).join(held, "word", "left").withColumn("points", F.coalesce("points", F.lit(0)))
    return asked.withColumn("_r", rank).filter(F.col("_r") <= n).groupBy(qid).agg(F.collect_list("word").alias("rare"))


def overlap_bound(question: Column, candidate: Column, rare: Column) -> Column:
    """No word overlap of the two is larger: from their numbers of words, and the rare words that are missing."""
    a, b = F.array_distinct(tx.words(F.lower(question))), F.array_distinct(tx.words(F.lower(candidate)))
    rare = F.coalesce(rare, F.array().cast("array<string>"))
    missing = F.size(rare) - F.size(F.array_intersect(rare, b))
    shared = F.least(F.size(b), F.size(a) - missing)
    union = F.size(a) + F.size(b) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def _rounded(scores: np.ndarray) -> np.ndarray:
    """Half up, as column expressions round."""
    scale = 10.0**ROUND_DIGITS
    return np.floor(scores * scale + 0.5) / scale


def bounded_rerank(
    ranked: DataFrame,
    make_scorer: Callable[[], Callable],
    bound: Column,
    n: int,
    question: str = "q_question",
    text: str = "question",
    batch_size: int = BATCH,
    attempts: int = models.ATTEMPTS,
    pause: float = models.PAUSE_SECONDS,
) -> DataFrame:
    """The best ``n`` of each question by a caller's pair scorer, with ``pair_score``, new ``rank`` and ``scored``.

    ``bound`` must be no smaller than the score. Equal scores keep their former
    order. ``scored`` is the number of pairs the model saw for the question.
    Pairs that the model fails on are returned behind the others, with a NULL
    score, so that a caller can tell them.
    """
    kept = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = T.StructType(
        [*kept, T.StructField("pair_score", T.DoubleType()), T.StructField("rank", T.LongType()), T.StructField("scored", T.LongType())]
    )
    names = [f.name for f in kept]
    order = [F.col("qid"), F.desc_nulls_last("_bound"), F.col("rank")]
    rows = ranked.withColumn("_bound", bound).repartition("qid").sortWithinPartitions(*order)

    def place(group: pa.Table, call) -> tuple[list[int], list, int]:
        """Rows of the best and of the failed pairs, their scores, and the number of pairs seen."""
        # a hair above the bound: scores are rounded
        bounds = [np.nan if x is None else x + 10.0**-ROUND_DIGITS for x in group.column("_bound").to_pylist()]
        scores, known = [], []
        while len(scores) < len(bounds):
            if len(known) >= n and known[n - 1] > bounds[len(scores)]:
                break
            part = group.slice(len(scores), batch_size)
            found, _ = call([list(p) for p in zip(part.column(question).to_pylist(), part.column(text).to_pylist())])
            scores += [None if x is None or x != x else x for x in found]
            known = sorted((x for x in scores if x is not None), reverse=True)
        former = group.column("rank").to_pylist()
        rounded = [None if x is None else float(_rounded(np.float64(x))) for x in scores]
        good = sorted((i for i, x in enumerate(rounded) if x is not None), key=lambda i: (-rounded[i], former[i]))[:n]
        failed = sorted((i for i, x in enumerate(rounded) if x is None), key=lambda i: former[i])
        return good + failed, [rounded[i] for i in good + failed], len(scores)

    def answers(table: pa.Table, starts: np.ndarray, call) -> pa.RecordBatch:
        """Placed rows of the groups between the starts."""
        at, scores, ranks, seen = [], [], [], []
        for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist()):
            picked, values, scored = place(table.slice(start, stop - start), call)
            at += [start + i for i in picked]
            scores += values
            ranks += range(1, len(picked) + 1)
            seen += [scored] * len(picked)
        columns = [table.column(name).take(pa.array(at, pa.int64())).combine_chunks() for name in names]
        columns += [pa.array(scores, pa.float64()), pa.array(ranks, pa.int64()), pa.array(seen, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, left = models.isolated(make_scorer(), attempts, pause), []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*left, batch]).combine_chunks()
            qid = table.column("qid").combine_chunks()
            starts = np.r_[0, 1 + np.flatnonzero(pc.not_equal(qid[1:], qid[:-1]).to_numpy(zero_copy_only=False))]
            # the last group may go on in the next batch
            left = table.slice(starts[-1]).to_batches()
            if len(starts) > 1:
                yield answers(table, starts, call)
        if left:
            table = pa.Table.from_batches(left)
            yield answers(table, np.array([0, table.num_rows]), call)

    return rows.mapInArrow(best, schema)
