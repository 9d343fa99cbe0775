"""Nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each half is quantised on its own, and the
pair of nearest centroids is a vector's cell. A query ranks the centroids of
both halves by inner product and walks the pairs in the order of their sums
with a heap, until the cells it has met hold a given share of all entries;
every entry of a met cell is then scored exactly, in double precision.

Centroids are fitted on about ``SAMPLE_ROWS`` distinct vectors, chosen by hash;
all vectors are indexed. On that sample the share is calibrated against brute
force: the smallest one that finds ``TARGET`` of the true neighbours. Spread
vectors without clusters need a large share, clustered ones a small one.

Equal vectors are one entry that keeps only the ids that can be reported (one
more than the neighbours asked for, the smallest), so a vector that very many
rows share costs as much as any other. Entries of one first-half centroid are
dealt over shelves of bounded size, queries over blocks of bounded size; a task
scores a block against a shelf and emits the best of each query.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do those whose length is not the most frequent
one (the longer, of equally frequent ones) and rows with a null id. Rows that
share the query's id are the query's own. Repeated query rows are searched once.
Ties go to the smaller id. Fewer candidates than asked for are all returned.
Empty tables give empty results.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadloom.llm.base import query, table, written

SAMPLE_ROWS = 20_000
TARGET = 0.95
SHELF_ROWS = 8_192
QUERY_BLOCK = 4_096
_STEP = 256  # queries scored at a time


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, vector (array<double>) of the rows that take part."""
    v = F.col("vector")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    rows = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & fine & F.exists(v, lambda x: x != 0)
    )
    common = rows.groupBy(F.size("vector").alias("n")).count().agg(F.max_by("n", F.struct("count", "n"))).first()[0]
    return rows.where(F.size("vector") == F.lit(common or 0))


def _kmeans(points: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    centres = points[np.random.default_rng(7).choice(len(points), k, replace=False)]
    for _ in range(rounds):
        own = np.argmax(points @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        count = np.bincount(own, minlength=k)
        filled = count > 0
        centres[filled] = sums[filled] / count[filled, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(points @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """Cells in descending order of the summed scores of their halves, until they hold ``wanted`` entries."""
    order_a, order_b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    best_a, best_b = first[order_a].tolist(), second[order_b].tolist()
    order_a, order_b = order_a.tolist(), order_b.tolist()
    heap = [(-(best_a[0] + best_b[0]), 0, 0)]
    met, cells = 0, []
    while heap and met < wanted:
        _, i, j = heapq.heappop(heap)
        size = int(sizes[order_a[i], order_b[j]])
        if size:
            cells.append((order_a[i], order_b[j]))
            met += size
        # each pair is reached once: from the left in the first column, else from above
        if j == 0 and i + 1 < len(best_a):
            heapq.heappush(heap, (-(best_a[i + 1] + best_b[0]), i + 1, 0))
        if j + 1 < len(best_b):
            heapq.heappush(heap, (-(best_a[i] + best_b[j + 1]), i, j + 1))
    return cells


@dataclass
class Index:
    first: np.ndarray
    second: np.ndarray
    share: float

    @property
    def cut(self) -> int:
        return self.first.shape[1]

    def cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _nearest(points[:, : self.cut], self.first), _nearest(points[:, self.cut :], self.second)


def fit(sample: np.ndarray, entries: int, k: int, target: float = TARGET) -> Index:
    """Centroids for ``entries`` vectors and the calibrated share for ``k`` neighbours."""
    cut = (sample.shape[1] + 1) // 2
    centres = max(1, min(len(sample), 1024, round(2.2 * entries**0.25)))
    index = Index(_kmeans(sample[:, :cut], centres), _kmeans(sample[:, cut:], centres), 1.0) if sample.shape[1] > 1 else Index(
        _kmeans(sample, centres), np.zeros((1, 0)), 1.0
    )
    asked = np.arange(0, len(sample), max(1, len(sample) // 200))
    a, b = index.cells(sample)
    sizes = np.zeros((len(index.first), len(index.second)), dtype=np.int64)
    np.add.at(sizes, (a, b), 1)
    needed = []
    for own in asked:
        q = sample[own]
        scores = sample @ q
        scores[own] = -np.inf  # by inner product a vector need not be its own nearest
        true = np.argsort(-scores)[: min(k, len(sample) - 1)]
        met, place = 0, {}
        for cell in walk(index.first @ q[:cut], index.second @ q[cut:], sizes, len(sample)):
            met += sizes[cell]
            place[cell] = met / len(sample)
        needed.extend(place[(a[t], b[t])] for t in true)
    if needed:
        index.share = float(min(1.0, np.quantile(needed, target) + 0.01))
    return index


def search(rows: DataFrame, is_query: str, k: int = 20, vec_id: str = "vec_id", vector: str = "vector", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score. ``is_query``: SQL condition on ``vec_id``."""
    spark = rows.sparkSession
    good = usable(rows, vec_id, vector).withColumn("entry", F.xxhash64("vector"))
    # repeated rows first become one id; a row number below k + 2 is settled within each task before the shuffle
    ranked = (
        good.select("entry", "vec_id").distinct()
        .withColumn("n", F.row_number().over(Window.partitionBy("entry").orderBy("vec_id"))).where(F.col("n") <= k + 1)
        .groupBy("entry").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    entries = written(good.groupBy("entry").agg(F.first("vector").alias("vector")).join(ranked, "entry"), "entries")
    asking = good.where(is_query).select("entry", F.col("vec_id").alias("query_id")).distinct()
    total = entries.count()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], schema)
    part = F.pmod(F.hash("entry"), F.lit(1_000_000)) < max(1, int(1_000_000 * min(1.0, sample_rows / total)))
    sample = entries.where(part).select("vector").toArrow()["vector"].combine_chunks()  # about sample_rows vectors
    if not len(sample):
        sample = entries.limit(1).select("vector").toArrow()["vector"].combine_chunks()
    points = sample.values.to_numpy(zero_copy_only=False).reshape(len(sample), -1)
    shared = spark.sparkContext.broadcast(fit(points, total, k))

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = shared.value.cells(matrix(batch[1]))
                yield pa.RecordBatch.from_arrays([batch[0], batch[1], batch[2], pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["entry", "vector", "ids", "a", "b"])

    placed = written(entries.select("entry", "vector", "ids").mapInArrow(locate, "entry bigint, vector array<double>, ids array<bigint>, a int, b int"), "cells")
    counted = placed.groupBy("a", "b").count().toPandas()  # at most the square of the centroids
    sizes = np.zeros((len(shared.value.first), len(shared.value.second)), dtype=np.int64)
    sizes[counted["a"], counted["b"]] = counted["count"]
    shelves = np.maximum(1, -(-sizes.sum(axis=1) // SHELF_ROWS))
    queries = placed.join(asking.select("entry").distinct(), "entry", "left_semi")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    wanted = max(shared.value.share * total, k + 1)
    plan = spark.sparkContext.broadcast((sizes, shelves))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, shelves = plan.value
        index = shared.value
        for batch in batches:
            points = matrix(batch[1]) if batch.num_rows else np.zeros((0, 1))
            for low in range(0, batch.num_rows, 64):
                rows, shelf_a, shelf_n, seconds = [], [], [], []
                for r in range(low, min(low + 64, batch.num_rows)):
                    q = points[r]
                    met: dict[int, list[int]] = {}
                    for a, b in walk(index.first @ q[: index.cut], index.second @ q[index.cut :], sizes, wanted):
                        met.setdefault(a, []).append(b)
                    for a, bs in met.items():
                        for n in range(int(shelves[a])):
                            rows.append(r), shelf_a.append(a), shelf_n.append(n), seconds.append(bs)
                own = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch[0].take(own), batch[1].take(own), pa.array(shelf_a, pa.int32()), pa.array(shelf_n, pa.int32()), pa.array(seconds, pa.list_(pa.int32()))],
                    names=["entry", "vector", "a", "shelf", "seconds"],
                )

    routed = queries.select("entry", "vector").mapInArrow(route, "entry bigint, vector array<double>, a int, shelf int, seconds array<int>").withColumn(
        "block", F.pmod(F.hash("entry"), F.lit(blocks))
    )
    deal = F.array(*[F.lit(int(n)) for n in shelves])
    shelved = placed.select("entry", "vector", F.element_at("ids", 1).alias("least"), "a", "b", F.pmod(F.xxhash64("entry"), F.element_at(deal, F.col("a") + 1)).cast("int").alias("shelf")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": np.zeros(0, np.int64), "entry": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(left) or not len(right):
            return empty
        data, cell = np.stack(right["vector"].to_numpy()), right["b"].to_numpy()
        ids, entry, least = left["entry"].to_numpy(), right["entry"].to_numpy(), right["least"].to_numpy()
        # how far a sum may be off in another order of addition
        size = np.abs(data).sum(axis=1).max() * np.finfo(float).eps * data.shape[1]
        width = int(cell.max()) + 1
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for low in range(0, len(left), _STEP):
            asked = np.stack(left["vector"].to_numpy()[low : low + _STEP])
            allowed = np.zeros((len(asked), width), dtype=bool)
            for r, seconds in enumerate(left["seconds"].to_numpy()[low : low + _STEP]):
                allowed[r, seconds[seconds < width]] = True
            scores = np.where(allowed[:, cell], asked @ data.T, -np.inf)
            best = min(k + 1, len(data))
            edge = np.partition(scores, len(data) - best, axis=1)[:, len(data) - best]
            for r in range(len(asked)):
                # everything that may tie with the last place; the exact sums and the ids decide
                c = np.flatnonzero((scores[r] >= edge[r] - 4 * size * np.abs(asked[r]).max()) & (scores[r] > -np.inf))
                exact = (asked[r] * data[c]).sum(axis=1)
                order = np.lexsort((least[c], -exact))[:best]
                out.append((np.full(len(order), ids[low + r]), entry[c[order]], exact[order]))
        return pd.DataFrame({n: np.concatenate([part[i] for part in out]) for i, n in enumerate(("query", "entry", "score"))})

    keys = ["a", "shelf", "block"]
    near = routed.groupBy(*keys).cogroup(shelved.groupBy(*keys)).applyInPandas(score, "query bigint, entry bigint, score double")
    # k + 1 entries are enough, one may be the query alone; ids only then come in
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least_id")
    listed = (
        near.join(entries.select("entry", "ids", F.element_at("ids", 1).alias("least_id")), "entry")
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
        .groupBy("query")
        .agg(
            F.slice(
                F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("id")))))), 1, 2 * (k + 1)
            ).alias("found")
        )
    )
    found = asking.join(listed, F.col("entry") == F.col("query")).select(
        "query_id", F.posexplode(F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)).alias("rank", "hit")
    )
    return found.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.s")).alias("score"))


@query("op2_multi_index")
def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", 20, vector="embedding")
