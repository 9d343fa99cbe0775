"""Exact top-k joins of a query table with a point table by cosine, and among given pairs.

A block of queries is scored against Arrow batches of points, and only the best
``k`` per query leave a task, so pairs are never materialised. The point table
is not shuffled when the queries fit a checked size. Beyond it the points pass the query blocks of
``blocks``, or, where there are many, both sides meet in co-grouped cells, where
the triangle inequality rules out the cells that cannot hold a better neighbour.
All ways return the same, exact result. Sparse search is in ``postings``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

# Largest query side shipped whole to the tasks.
MAX_SHIPPED_QUERIES = 16_384
MAX_SHIPPED_BYTES = 256 << 20
# Block sizes of the co-grouped way.
QUERY_BLOCK = 4_096
POINT_BLOCK = 65_536
# Most cells of the dense index; their centres are held by driver and tasks.
MAX_CELLS = 2_048
# Up to this many cells little can be ruled out: all points pass the query blocks instead.
FEW_CELLS = 16
# Added to the similarity a cell may still offer: covers rounding of scores and angles.
BOUND_SLACK = 1e-5
# Score-matrix cells held at a time inside one task.
CELLS = 1_000_000
ROUND_DIGITS = 6


def _column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    column = batch.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _whole(array: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(array, pa.ChunkedArray):
        return pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], array.type)
    return array


class _DenseBlock:
    """Unit query vectors, scored by one matrix product per batch of points."""

    def __init__(self, vectors: pa.Array):
        self.matrix = _unit_rows(vectors)
        self.size = len(self.matrix)

    def score(self, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, None]]:
        points = _unit_rows(vectors)
        if self.size and len(points) and points.shape[1] != self.matrix.shape[1]:
            raise ValueError("query and point vectors differ in dimension")
        step = max(1, CELLS // max(1, self.size))
        for start in range(0, len(points), step):
            yield start, self.matrix @ points[start : start + step].T, None


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    if not len(vectors):
        return np.zeros((0, 0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if vectors.null_count or len(flat) % len(vectors):
        raise ValueError("vectors must be present and of one dimension")
    rows = flat.reshape(len(vectors), -1)
    lengths = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


class _SparseBlock:
    """Query weights as a term-by-query matrix, in slices of bounded width."""

    WIDTH = 128

    def __init__(self, weights: pa.Array):
        self.size = len(weights)
        rows, keys, values = _map_parts(weights)
        self.positive = bool((values > 0).all())
        self.slices = []
        for start in range(0, self.size, self.WIDTH):
            stop = min(start + self.WIDTH, self.size)
            inside = (rows >= start) & (rows < stop)
            picked = pc.filter(keys, pa.array(inside))
            encoded = pc.dictionary_encode(picked)
            terms = encoded.dictionary
            matrix = np.zeros((len(terms), stop - start))
            present = np.zeros((len(terms), stop - start), dtype=bool)
            codes = encoded.indices.to_numpy(zero_copy_only=False)
            matrix[codes, rows[inside] - start] = values[inside]
            present[codes, rows[inside] - start] = True
            self.slices.append((start, stop, terms, matrix, present))

    def score(self, weights: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        step = max(1, CELLS // (max(1, self.size) * 4))
        for start in range(0, len(weights), step):
            part = weights.slice(start, step)
            scores = np.zeros((self.size, len(part)))
            rows, keys, values = _map_parts(part)
            # positive weights: a shared term shows as a positive score
            signed = not self.positive or not (values > 0).all()
            shared = np.zeros((self.size, len(part)), dtype=bool) if signed else None
            for low, high, terms, matrix, present in self.slices:
                codes = pc.index_in(keys, value_set=terms)
                known = np.flatnonzero(pc.is_valid(codes).to_numpy(zero_copy_only=False))
                if not len(known):
                    continue
                codes = codes.take(pa.array(known)).to_numpy(zero_copy_only=False)
                into = None if shared is None else shared[low:high]
                self._add(scores[low:high], into, rows[known], codes, values[known], matrix, present)
            yield start, scores, scores > 0 if shared is None else shared

    @staticmethod
    def _add(scores, shared, rows, codes, values, matrix, present) -> None:
        # rows are ascending: cut on row borders so that one piece stays small
        limit = max(1, CELLS // matrix.shape[1])
        low = 0
        while low < len(rows):
            high = min(low + limit, len(rows))
            picked = slice(low, high)
            starts = np.flatnonzero(np.r_[True, np.diff(rows[picked]) != 0])
            targets = rows[picked][starts]
            weighted = matrix[codes[picked]] * values[picked, None]
            scores[:, targets] += np.add.reduceat(weighted, starts, axis=0).T
            if shared is not None:
                shared[:, targets] |= np.logical_or.reduceat(present[codes[picked]], starts, axis=0).T
            low = high


def _map_parts(weights: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row number, key and value of every entry of a map column."""
    offsets = weights.offsets.to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(weights)), np.diff(offsets))
    keys = weights.keys.slice(offsets[0], offsets[-1] - offsets[0])
    values = weights.items.slice(offsets[0], offsets[-1] - offsets[0])
    return rows, keys, values.to_numpy(zero_copy_only=False).astype(np.float64)


_BLOCKS = {"dense": _DenseBlock, "sparse": _SparseBlock}


class _Best:
    """Running best ``k`` per query: score descending, id ascending.

    Entries that reach the floor of their query are gathered and cut back to
    ``k`` a query whenever their number has doubled. The floor rises with every
    cut, so later tiles cost one comparison a cell.
    """

    def __init__(self, queries: int, k: int):
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.rows = np.uint16 if queries <= 1 << 16 else np.int64  # short keys are sorted by radix
        self.parts, self.held, self.limit = [], 0, max(queries * k, CELLS // 4)

    def add(self, scores: np.ndarray, points: np.ndarray, shared: np.ndarray | None) -> None:
        """A tile of queries by points."""
        if shared is not None:
            scores = np.where(shared, scores, -np.inf)
        open_ = np.flatnonzero(self.floor == -np.inf)
        if scores.shape[1] > self.k and len(open_):
            cut = scores.shape[1] - self.k
            self.floor[open_] = np.round(np.partition(scores[open_], cut, axis=1)[:, cut], ROUND_DIGITS) + 0.0
        # rounding may lift a score by half a digit
        slack = np.where(np.isfinite(self.floor), 10.0**-ROUND_DIGITS + 1e-12 * np.abs(self.floor), 0.0)
        keep = scores >= (self.floor - slack)[:, None]
        if len(open_):
            keep &= scores > -np.inf
        rows, columns = np.nonzero(keep)
        self.add_entries(rows, points[columns], scores[rows, columns])

    def add_entries(self, rows: np.ndarray, points: np.ndarray, scores: np.ndarray) -> None:
        scores = np.round(scores, ROUND_DIGITS) + 0.0
        reach = scores >= self.floor[rows]
        self.parts.append((rows[reach].astype(self.rows), points[reach], scores[reach]))
        self.held += len(self.parts[-1][0])
        if self.held > 2 * self.limit:
            self._cut()

    def _cut(self) -> None:
        rows, points, scores = (np.concatenate(c) for c in zip(*self.parts))
        order = np.argsort(rows, kind="stable")
        rows, points, scores = rows[order], points[order], scores[order]
        counts = np.bincount(rows, minlength=len(self.floor))
        starts = np.cumsum(counts) - counts
        full = np.flatnonzero(counts >= self.k)
        full = full[np.argsort(counts[full], kind="stable")]
        at = 0
        while at < len(full):
            # rows of similar length side by side; one row alone may be longer than a tile
            stop = at + 1
            while stop < len(full) and counts[full[stop]] * (stop + 1 - at) <= CELLS:
                stop += 1
            some, width = full[at:stop], counts[full[stop - 1]]
            place = np.arange(width)
            inside = place < counts[some][:, None]
            tile = np.where(inside, scores[np.minimum(starts[some][:, None] + place, len(scores) - 1)], -np.inf)
            self.floor[some] = np.partition(tile, width - self.k, axis=1)[:, width - self.k]
            at = stop
        keep = scores >= self.floor[rows]
        rows, points, scores = rows[keep], points[keep], scores[keep]
        # more than k are left where several share the k-th score: the smallest ids stay
        over = np.bincount(rows, minlength=len(self.floor)) - self.k
        tied = np.flatnonzero((over[rows] > 0) & (scores == self.floor[rows]))
        if len(tied):
            tied = tied[np.lexsort((points[tied], rows[tied]))]
            _, first, n = np.unique(rows[tied], return_index=True, return_counts=True)
            place = np.arange(len(tied)) - np.repeat(first, n)
            drop = tied[place >= np.repeat(n - over[rows[tied[first]]], n)]
            left = np.ones(len(rows), dtype=bool)
            left[drop] = False
            rows, points, scores = rows[left], points[left], scores[left]
        self.parts, self.held = [(rows, points, scores)], len(rows)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Query rows, points, scores and ranks, in order."""
        if not self.held:
            return None
        self._cut()
        rows, points, scores = self.parts[0]
        order = np.lexsort((points, -scores, rows))
        rows, points, scores = rows[order].astype(np.int64), points[order], scores[order]
        first = np.r_[0, np.flatnonzero(np.diff(rows)) + 1]
        rank = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)])) + 1
        return rows, points, scores, rank


def _rank_block(block, ids: np.ndarray, batches, k: int) -> pa.RecordBatch | None:
    """Best ``k`` points of the batches for every query of the block.

    A batch with an ``asked`` column (the query ids each point may answer) is
    scored for those pairs only.
    """
    best = _Best(block.size, k)
    order = np.argsort(ids, kind="stable")
    for batch in batches:
        point_ids = _column(batch, "id").to_numpy(zero_copy_only=False)
        asked = _column(batch, "asked") if "asked" in batch.schema.names else None
        for start, scores, shared in block.score(_column(batch, "v")):
            width = scores.shape[1]
            if asked is not None:
                allowed = _allowed(asked.slice(start, width), ids, order, scores.shape)
                shared = allowed if shared is None else shared & allowed
            best.add(scores, point_ids[start : start + width], shared)
    found = best.result()
    if found is None:
        return None
    rows, points, scores, _ = found
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[rows]), pa.array(points), pa.array(scores)],
        names=["qid", "id", "score"],
    )


def _allowed(asked: pa.Array, ids: np.ndarray, order: np.ndarray, shape) -> np.ndarray:
    """Query-by-point mask from each point's list of query ids."""
    mask = np.zeros(shape, dtype=bool)
    wanted = asked.flatten().to_numpy(zero_copy_only=False)
    columns = np.repeat(np.arange(len(asked)), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
    mask[order[np.searchsorted(ids, wanted, sorter=order)], columns] = True
    return mask


def dense_topk(
    queries: DataFrame,
    points: DataFrame,
    k: int = 100,
    vector: str = "dense",
    qid: str = "qid",
    pid: str = "id",
    max_shipped: int = MAX_SHIPPED_QUERIES,
    nested: bool = False,
) -> DataFrame:
    """Best ``k`` points per query by cosine as (qid, id, score, rank), or as lists (qid, ids, scores) if ``nested``."""
    from threadloom.operators import blocks

    queries, points = _sides(queries, points, vector, qid, pid)
    schema = _result_schema(queries, points)
    shipped = _shippable(queries, max_shipped)
    if shipped is not None:
        found = best_per_query(_score_shipped(shipped, points, k, _DenseBlock, schema), k)
        return blocks.nested(found) if nested else found
    n_points = points.count()
    n_cells = min(MAX_CELLS, max(1, -(-n_points // POINT_BLOCK)))
    if n_cells <= FEW_CELLS:
        lists = blocks.dense_topk_of_blocks(queries, points, k)
        return lists if nested else blocks.ranked_rows(lists)
    found = best_per_query(_score_cells(queries, points, k, schema, n_cells), k)
    return blocks.nested(found) if nested else found


def topk_among(
    candidates: DataFrame,
    queries: DataFrame,
    points: DataFrame,
    k: int,
    kind: str,
    vector: str,
    max_shipped: int = MAX_SHIPPED_QUERIES,
    stored: bool = False,
) -> DataFrame:
    """Best ``k`` per query among given pairs, (qid, id) or lists (qid, ids), by another similarity.

    ``stored`` candidates and queries are read several times as they are.

    With shippable queries a point travels once, next to the list of queries
    that asked for it (no longer than the query side). Otherwise queries and
    points meet in blocks, each query with the list of its own candidates.
    """
    from threadloom.operators.blocks import ranked_rows, topk_among_blocks

    queries, points = _sides(queries, points, vector, "qid", "id")
    schema = _result_schema(queries, points)
    shipped = _shippable(queries, max_shipped)
    if shipped is not None:
        if "ids" in candidates.columns:
            candidates = candidates.select("qid", F.explode("ids").alias("id"))
        asked = candidates.groupBy("id").agg(F.collect_list("qid").alias("asked"))
        partial = _score_shipped(shipped, points.join(asked, "id"), k, _BLOCKS[kind], schema)
    else:
        return ranked_rows(topk_among_blocks(candidates, queries, points, k, kind, stored))
    return best_per_query(partial, k)


def _sides(queries: DataFrame, points: DataFrame, vector: str, qid: str, pid: str):
    return (
        queries.select(F.col(qid).alias("qid"), F.col(vector).alias("v")),
        points.select(F.col(pid).alias("id"), F.col(vector).alias("v")),
    )


def _result_schema(queries: DataFrame, points: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", queries.schema["qid"].dataType),
            T.StructField("id", points.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def best_per_query(scored: DataFrame, k: int) -> DataFrame:
    """Rank by score, ties by id; the filter on the rank prunes before the shuffle."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    kept = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return kept.withColumn("rank", F.col("rank").cast("bigint"))


def _shippable(queries: DataFrame, max_rows: int) -> pa.Table | None:
    """The query side, if it is within the checked row and byte bounds."""
    if max_rows <= 0:
        return None
    held = queries.limit(max_rows + 1).persist()
    try:
        rows, entries = held.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.size("v").cast("bigint")), F.lit(0))
        ).first()
        if rows > max_rows or entries * 32 > MAX_SHIPPED_BYTES:
            return None
        return held.toArrow()
    finally:
        held.unpersist()


def _score_shipped(table: pa.Table, points: DataFrame, k: int, block_type, schema) -> DataFrame:
    spark = points.sparkSession
    shipped = spark.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = shipped.value
        ids = _whole(local.column("qid")).to_numpy(zero_copy_only=False)
        block = block_type(_whole(local.column("v")))
        found = _rank_block(block, ids, batches, k)
        if found is not None:
            yield found

    # one partial list per scan split; the splits keep the parallelism of the scan
    return points.mapInArrow(score, schema)


def _meet(left: DataFrame, right: DataFrame, keys: list[str], k: int, block_type, schema) -> DataFrame:
    """Score the points and queries of each co-grouped block."""
    names = schema.fieldNames()
    empty = pa.schema([(f.name, _arrow_type(f.dataType)) for f in schema.fields]).empty_table()

    def score(point_table: pa.Table, query_table: pa.Table) -> pa.Table:
        if not query_table.num_rows or not point_table.num_rows:
            return empty
        ids = _whole(query_table.column("qid")).to_numpy(zero_copy_only=False)
        block = block_type(_whole(query_table.column("v")))
        found = _rank_block(block, ids, point_table.to_batches(), k)
        return empty if found is None else pa.Table.from_batches([found]).select(names)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, schema)


def _score_cells(queries: DataFrame, points: DataFrame, k: int, schema, n_cells: int) -> DataFrame:
    """Dense vectors: nearest cells first, then only the cells that may still help.

    A first round over each query's nearest cells fixes a score that any later
    neighbour has to reach. By the triangle inequality of angles no point of a
    cell is closer to the query than the cell's centre less its radius, so
    cells below that score are left out without losing a neighbour.
    """
    spark = points.sparkSession
    # at most MAX_CELLS vectors
    chosen = points.orderBy(F.xxhash64("id"), "id").limit(n_cells).select("v").toArrow()
    centres = spark.sparkContext.broadcast(_unit_rows(_whole(chosen.column("v"))))
    id_type = schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines = _unit_rows(batch.column("v")) @ centres.value.T
            cell = cosines.argmax(axis=1)
            nearest = cosines[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("v"),
                    pa.array(cell.astype(np.int32)),
                    pa.array(np.arccos(np.clip(nearest, -1.0, 1.0))),
                ],
                names=["id", "v", "cell", "angle"],
            )

    vector_type = points.schema["v"].dataType.simpleString()
    placed = points.mapInArrow(place, f"id {id_type}, v {vector_type}, cell int, angle double")
    # at most MAX_CELLS rows
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).toArrow()
    found = sizes.column("cell").to_numpy()
    count = np.zeros(n_cells, dtype=np.int64)
    radius = np.full(n_cells, -np.inf)
    count[found] = sizes.column("n").to_numpy()
    radius[found] = sizes.column("radius").to_numpy()

    def first_cells(cosines: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """Nearest cells until they hold k points between them."""
        order = np.argsort(-cosines, axis=1, kind="stable")
        before = np.cumsum(count[order], axis=1) - count[order]
        take = np.zeros(cosines.shape, dtype=bool)
        np.put_along_axis(take, order, (before < k) & (count[order] > 0), axis=1)
        return take

    def other_cells(cosines: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """Cells not seen yet whose best possible score reaches the floor."""
        angles = np.arccos(np.clip(cosines, -1.0, 1.0)) - radius[None, :]
        possible = np.cos(np.maximum(angles, 0.0)) + BOUND_SLACK
        reach = (possible >= floors[:, None]) & (count > 0)[None, :]
        return reach & ~first_cells(cosines, floors)

    def visits(rows: DataFrame, choose) -> DataFrame:
        qid_type = schema["qid"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                floors = batch.column("floor").to_numpy(zero_copy_only=False)
                wanted = choose(_unit_rows(batch.column("v")) @ centres.value.T, floors)
                row, cell = np.nonzero(wanted)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("qid").take(at), batch.column("v").take(at), pa.array(cell.astype(np.int32))],
                    names=["qid", "v", "cell"],
                )

        kind = rows.schema["v"].dataType.simpleString()
        return rows.select("qid", "v", "floor").mapInArrow(run, f"qid {qid_type}, v {kind}, cell int")

    def round_of(asked: DataFrame) -> DataFrame:
        """Large cells are cut into point blocks, busy ones into query blocks."""
        plan = asked.groupBy("cell").agg(
            F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("nq")
        )
        blocks = spark.createDataFrame(
            [(int(c), max(1, -(-int(count[c]) // POINT_BLOCK))) for c in found], "cell int, np int"
        )
        # at most MAX_CELLS rows
        plan = F.broadcast(plan.join(blocks, "cell"))
        left = placed.join(plan, "cell").select(
            "id", "v", "cell",
            F.pmod(F.xxhash64("id"), F.col("np")).cast("int").alias("pb"),
            F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"),
        )
        right = asked.join(plan, "cell").select(
            "qid", "v", "cell",
            F.pmod(F.xxhash64("qid"), F.col("nq")).cast("int").alias("qb"),
            F.explode(F.sequence(F.lit(0), F.col("np") - 1)).alias("pb"),
        )
        return _meet(left, right, ["cell", "pb", "qb"], k, _DenseBlock, schema)

    first = best_per_query(round_of(visits(queries.withColumn("floor", F.lit(-2.0)), first_cells)), k)
    first = first.drop("rank").persist()
    floors = first.groupBy("qid").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-2.0)).alias("floor")
    )
    later = queries.join(floors, "qid", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)))
    return first.unionByName(round_of(visits(later, other_cells)))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    types = {
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.StringType(): pa.string(),
        T.DoubleType(): pa.float64(),
    }
    return types[kind]
