"""Blocks of queries against all points, for query sides that are too large to be sent to every task.

Queries are dealt by a hash of their id; a task holds one query block, and all
points stream past it. Points are written once, in packed chunks, and every task
reads these files: a cartesian product of the one stream of chunks with the query
blocks, so that no copy of the points is shuffled or kept. Sums of pairs stay in a
tile of bounded size inside the task, and the best ``k`` of each query leave it with
their ranks, as one row of lists a query. The work is that of all pairs (or of the
given ones); what is moved are the queries, once, and their lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from threadloom.operators import knn
from threadloom.session import scratch_path

# Weights (or vector components) of one query block or of the points looked up at a time,
# and results held for one query block.
BLOCK_ENTRIES = 2_000_000
BLOCK_RESULTS = 2_000_000
BLOCK_QUERIES = 8_192
# There are this many query blocks, if they have this many entries each.
LEAST_BLOCKS, LEAST_ENTRIES = 24, 20_000
# Products expanded at a time inside one task.
WORK = 2_000_000
# A term that one query in so many holds is multiplied as a column, not as a list.
FREQUENT = 10
# Ranked points of one batch of results.
RESULT_ROWS = 100_000
# Bytes of one row group of chunks: a reader holds a whole one.
GROUP_BYTES = 8 << 20
# monotonically_increasing_id counts the rows of a task in these bits.
ROW_BITS = (1 << 33) - 1


def _lists(terms: pa.Array, weights: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row number, term and weight of every entry; entries without a weight take no part."""
    lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
    rows, keys, values = np.repeat(np.arange(len(terms)), lengths), terms.flatten(), weights.flatten()
    if values.null_count:
        valid = pc.is_valid(values)
        rows, keys, values = rows[valid.to_numpy(zero_copy_only=False)], keys.filter(valid), values.filter(valid)
    return rows, keys, values.to_numpy(zero_copy_only=False).astype(np.float64)


def _codes(keys: pa.Array, value_set: pa.Array) -> np.ndarray:
    """Places of the keys in a set, -1 for unknown ones; of keys in a dictionary only its words are looked up."""
    if isinstance(keys, pa.DictionaryArray):
        return _codes(keys.dictionary, value_set)[keys.indices.to_numpy(zero_copy_only=False)]
    return pc.fill_null(pc.index_in(keys, value_set=value_set), -1).to_numpy(zero_copy_only=False)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of several runs, one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


class _Inverted:
    """Query terms as inverted lists of (query row, weight)."""

    def __init__(self, terms: pa.Array, weights: pa.Array):
        self.size = len(terms)
        rows, keys, values = _lists(terms, weights)
        encoded = pc.dictionary_encode(keys)
        self.terms, codes = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        self.rows, self.values = rows[order], values[order]
        self.lengths = np.bincount(codes, minlength=len(self.terms))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.positive = bool((values > 0).all())
        # terms without a column have place -1; columns hold at most FREQUENT cells for an entry
        frequent = np.flatnonzero(self.lengths * FREQUENT > self.size)
        self.place = np.full(len(self.terms), -1)
        self.place[frequent] = np.arange(len(frequent))
        self.columns = self._matrix(rows, self.place[codes], values, self.size, len(frequent))

    @staticmethod
    def _matrix(rows: np.ndarray, places: np.ndarray, values: np.ndarray | None, height: int, width: int) -> np.ndarray:
        own = places >= 0
        weights = None if values is None else values[own]
        return np.bincount(rows[own] * width + places[own], weights, height * width).reshape(height, width)

    def score(self, terms: pa.Array, weights: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first point, query-by-point scores, which share a term) of runs of points."""
        rows, keys, values = _lists(terms, weights)
        codes = _codes(keys, self.terms)
        known = codes >= 0
        rows, codes, values = rows[known], codes[known], values[known]
        signed = not self.positive or not (values > 0).all()
        places = self.place[codes]
        all_rows, all_values, all_places = rows, values, places
        # columns cannot tell a sum of zero from no shared term
        listed = np.ones(len(rows), dtype=bool) if signed else places < 0
        rows, codes, values = rows[listed], codes[listed], values[listed]
        lengths = self.lengths[codes]
        done = np.cumsum(lengths)
        all_bounds = np.searchsorted(all_rows, np.arange(len(terms) + 1))
        bounds = np.searchsorted(rows, np.arange(len(terms) + 1))
        width = max(1, knn.CELLS // max(1, self.size))
        for start in range(0, len(terms), width):
            stop = min(start + width, len(terms))
            if signed or not self.columns.shape[1]:
                scores = np.zeros((stop - start) * self.size)
            else:
                own = slice(all_bounds[start], all_bounds[stop])
                columns = self._matrix(all_rows[own] - start, all_places[own], all_values[own], stop - start, self.columns.shape[1])
                scores = (columns @ self.columns.T).reshape(-1)
            shared = np.zeros(len(scores), dtype=bool) if signed else None
            low = bounds[start]
            while low < bounds[stop]:
                limit = done[low] - lengths[low] + WORK
                high = min(max(low + 1, np.searchsorted(done, limit, side="right")), bounds[stop])
                own, n = rows[low:high] - start, lengths[low:high]
                at = _spread(self.starts[codes[low:high]], n)
                base, span = own[0] * self.size, (own[-1] + 1 - own[0]) * self.size
                cell = np.repeat(own * self.size - base, n) + self.rows[at]
                scores[base : base + span] += np.bincount(cell, np.repeat(values[low:high], n) * self.values[at], span)
                if shared is not None:
                    shared[base + cell] = True
                low = high
            found = scores > 0 if shared is None else shared
            yield start, *(np.ascontiguousarray(x.reshape(-1, self.size).T) for x in (scores, found))


def _column(table: pa.Table, name: str) -> pa.Array:
    return knn._whole(table.column(name))


def _numpy(table: pa.Table, name: str) -> np.ndarray:
    return _column(table, name).to_numpy(zero_copy_only=False)


def _packed(rows: pa.RecordBatch | pa.Table) -> bytes:
    """Rows as compressed bytes, their terms as places in a dictionary of their own."""
    table = pa.Table.from_batches([rows]) if isinstance(rows, pa.RecordBatch) else rows
    columns = [_column(table, name) for name in table.schema.names]
    coded = [
        pa.ListArray.from_arrays(c.offsets, pc.dictionary_encode(c.values)) if name == "terms" else c
        for name, c in zip(table.schema.names, columns)
    ]
    table = pa.table(coded, names=table.schema.names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(cell: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(cell.as_buffer()).read_all()


class _Search:
    """The best points of one query block, by one similarity with all points."""

    def __init__(self, queries: pa.Table, block, k: int):
        self.ids, self.block = _numpy(queries, "qid"), block
        self.best = knn._Best(len(self.ids), k)

    def add(self, points: pa.Table) -> None:
        ids = _numpy(points, "id")
        for start, scores, shared in self._scores(points):
            self.best.add(scores, ids[start : start + scores.shape[1]], shared)

    def result(self):
        return self.ids, self.best.result()


class _SparseSearch(_Search):
    def __init__(self, queries: pa.Table, k: int):
        super().__init__(queries, _Inverted(_column(queries, "terms"), _column(queries, "weights")), k)

    def _scores(self, points: pa.Table):
        return self.block.score(_column(points, "terms"), _column(points, "weights"))


class _DenseSearch(_Search):
    def __init__(self, queries: pa.Table, k: int):
        super().__init__(queries, knn._DenseBlock(_column(queries, "v")), k)

    def _scores(self, points: pa.Table):
        return self.block.score(_column(points, "v"))


class _SparsePairs:
    """Sums of given pairs: the terms of some points that the queries know, looked up query by query."""

    def __init__(self, queries: pa.Table):
        rows, keys, self.values = _lists(_column(queries, "terms"), _column(queries, "weights"))
        encoded = pc.dictionary_encode(keys)
        self.terms, self.codes = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False)
        self.bounds = np.searchsorted(rows, np.arange(queries.num_rows + 1))
        self.weight, self.asked = np.zeros(len(self.terms)), np.zeros(len(self.terms), dtype=bool)

    def part(self, points: pa.Table) -> tuple[np.ndarray, ...]:
        """Known entries of some points: how many each has, their terms and weights."""
        rows, keys, values = _lists(_column(points, "terms"), _column(points, "weights"))
        codes = _codes(keys, self.terms)
        known = codes >= 0
        return np.bincount(rows[known], minlength=points.num_rows), codes[known], values[known]

    def gather(self, parts: list[tuple[np.ndarray, ...]]) -> None:
        lengths, self.point_codes, self.point_values = (np.concatenate(c) for c in zip(*parts))
        self.point_bounds = np.concatenate([[0], np.cumsum(lengths)])

    def score(self, row: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of one query with points, and which of them share a term."""
        own = slice(self.bounds[row], self.bounds[row + 1])
        self.weight[self.codes[own]], self.asked[self.codes[own]] = self.values[own], True
        lengths = self.point_bounds[at + 1] - self.point_bounds[at]
        entry = _spread(self.point_bounds[at], lengths)
        owner, hit = np.repeat(np.arange(len(at)), lengths), self.asked[self.point_codes[entry]]
        entry, owner = entry[hit], owner[hit]
        sums = np.bincount(owner, self.weight[self.point_codes[entry]] * self.point_values[entry], len(at))
        self.weight[self.codes[own]], self.asked[self.codes[own]] = 0.0, False
        return sums, np.bincount(owner, minlength=len(at)) > 0


class _DensePairs:
    def __init__(self, queries: pa.Table):
        self.left = knn._unit_rows(_column(queries, "v"))

    def part(self, points: pa.Table) -> tuple[np.ndarray, ...]:
        right = knn._unit_rows(_column(points, "v"))
        if right.shape[1] != self.left.shape[1]:
            raise ValueError("query and point vectors differ in dimension")
        return (right,)

    def gather(self, parts: list[tuple[np.ndarray, ...]]) -> None:
        (self.right,) = (np.concatenate(c) for c in zip(*parts))

    def score(self, row: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.right[at] @ self.left[row], np.ones(len(at), dtype=bool)


_PAIRS = {"sparse": _SparsePairs, "dense": _DensePairs}


class _Among:
    """The best of given pairs: points are gathered up to a bound, then each query looks up its own.

    The table holds the vectors of the queries and, in rows without one, lists of their candidates.
    """

    def __init__(self, rows: pa.Table, k: int, kind: str):
        lists = pc.is_valid(rows.column("asked"))
        queries, asked = rows.filter(pc.invert(lists)), rows.filter(lists)
        self.pairs, self.ids = _PAIRS[kind](queries), _numpy(queries, "qid")
        # a query that stands there twice is one place and two rows
        places = pc.dictionary_encode(_column(queries, "qid"))
        self.place = places.indices.to_numpy(zero_copy_only=False)
        owners, self.asked = self._candidates(asked, places.dictionary)
        self.bounds = np.searchsorted(owners, np.arange(len(places.dictionary) + 1))
        self.best, self.parts, self.point_ids, self.held = knn._Best(len(self.ids), k), [], [], 0

    @staticmethod
    def _candidates(asked: pa.Table, places: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Place of the query and candidate of every pair, once each; queries without a vector are not asked."""
        lists = _column(asked, "asked")
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        rows, ids = np.repeat(_codes(_column(asked, "qid"), places), lengths), lists.flatten().to_numpy(zero_copy_only=False)
        rows, ids = rows[rows >= 0], ids[rows >= 0]
        order = np.lexsort((ids, rows))
        rows, ids = rows[order], ids[order]
        once = np.ones(len(rows), dtype=bool)
        once[1:] = (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1])
        return rows[once], ids[once]

    def add(self, points: pa.Table) -> None:
        if not len(self.ids):
            return
        self.parts.append(self.pairs.part(points))
        self.point_ids.append(_numpy(points, "id"))
        self.held += max(points.num_rows, self.parts[-1][-1].size)
        if self.held > BLOCK_ENTRIES:
            self._meet()

    def _meet(self) -> None:
        self.pairs.gather(self.parts)
        point_ids = np.concatenate(self.point_ids)
        self.parts, self.point_ids, self.held = [], [], 0
        order = np.argsort(point_ids, kind="stable")
        low, high = (np.searchsorted(point_ids[order], self.asked, side=s) for s in ("left", "right"))
        found = np.flatnonzero(high > low)
        bounds = np.searchsorted(found, self.bounds)
        for row in np.flatnonzero(np.diff(bounds)[self.place]):
            own = found[bounds[self.place[row]] : bounds[self.place[row] + 1]]
            at = order[_spread(low[own], high[own] - low[own])]
            sums, shared = self.pairs.score(row, at)
            self.best.add_entries(np.full(int(shared.sum()), row), point_ids[at[shared]], sums[shared])

    def result(self):
        if self.parts:
            self._meet()
        return self.ids, self.best.result()


def as_lists(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """A map of term weights as two arrays."""
    return vectors.select(key, F.map_keys(vector).alias("terms"), F.map_values(vector).alias("weights")).where(F.size("terms") > 0)


def gathered(entries: DataFrame, key: str, weight: str) -> DataFrame:
    """The same from rows (key, term, weight)."""
    pairs = F.collect_list(F.struct("term", F.col(weight).alias("weight"))).alias("_e")
    return entries.groupBy(key).agg(pairs).select(key, F.col("_e.term").alias("terms"), F.col("_e.weight").alias("weights"))


def kept(rows: DataFrame, name: str, **options) -> DataFrame:
    """Rows that are counted and then read again, written once."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.options(**options).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _blocks(queries: DataFrame, size, k: int, pairs: int = 0) -> int:
    """Number of query blocks; ``pairs`` are candidates besides the entries of the vectors."""
    n, asked = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    per_block, asked = max(1, min(BLOCK_QUERIES, BLOCK_RESULTS // k)), asked + pairs
    return max(1, -(-n // per_block), -(-asked // BLOCK_ENTRIES), min(LEAST_BLOCKS, -(-asked // LEAST_ENTRIES)))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([_packed(batch)], pa.binary())], names=["chunk"])


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of a partition, which is one query block."""
    rows = [batch for batch in batches if batch.num_rows]
    if rows:
        packed = _packed(pa.Table.from_batches(rows).drop_columns("qb"))
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["block"])


def _passed(queries: DataFrame, points: DataFrame, nq: int, make) -> DataFrame:
    """(qid, ids, scores) of query blocks that all points stream past; places in the lists are the ranks.

    A task is one query block: the block comes with its first chunk of points, in
    whatever order these are read. ``make`` builds the search of a block from its rows.
    """
    groups = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
    chunks = kept(points.mapInArrow(_chunks, "chunk binary"), "point-chunks", compression="none", **groups)
    asking = queries.select(F.pmod(F.xxhash64("qid"), F.lit(nq)).cast("int").alias("qb"), "*").repartitionById(nq, "qb")
    pairs = chunks.coalesce(1).crossJoin(asking.mapInArrow(_block, "block binary").hint("shuffle_replicate_nl"))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)) == 0
    rows = pairs.select("chunk", F.when(first, F.col("block")).alias("block"))
    kinds = [df.schema[name].dataType for df, name in ((queries, "qid"), (points, "id"))]
    qid_type, id_type = (knn._arrow_type(kind) for kind in kinds)

    def ranked(search) -> Iterator[pa.RecordBatch]:
        ids, found = search.result()
        if found is None:
            return
        row, point, score, rank = found
        first = np.r_[np.flatnonzero(rank == 1), len(row)]
        per_batch = max(1, RESULT_ROWS // search.best.k)
        for start in range(0, len(first) - 1, per_batch):
            bounds = first[start : start + per_batch + 1]
            part, offsets = slice(bounds[0], bounds[-1]), pa.array(bounds - bounds[0], pa.int32())
            columns = [
                pa.array(ids[row[bounds[:-1]]], type=qid_type),
                pa.ListArray.from_arrays(offsets, pa.array(point[part], type=id_type)),
                pa.ListArray.from_arrays(offsets, pa.array(score[part], type=pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["qid", "ids", "scores"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = None
        for batch in batches:
            for chunk, block in zip(batch.column("chunk"), batch.column("block")):
                if block.is_valid:
                    search = make(_unpacked(block))
                search.add(_unpacked(chunk))
        if search is not None:
            yield from ranked(search)

    qid, pid = (kind.simpleString() for kind in kinds)
    return rows.mapInArrow(run, f"qid {qid}, ids array<{pid}>, scores array<double>")


def ranked_rows(lists: DataFrame) -> DataFrame:
    """(qid, id, score, rank) of lists in the order of their ranks."""
    each = lists.select("qid", F.posexplode(F.arrays_zip("ids", "scores")).alias("_place", "_found"))
    return each.select("qid", F.col("_found.ids").alias("id"), F.col("_found.scores").alias("score"), (F.col("_place") + 1).cast("bigint").alias("rank"))


def nested(ranking: DataFrame) -> DataFrame:
    """The lists of ranked rows."""
    held = ranking.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("_found"))
    return held.select("qid", F.col("_found.id").alias("ids"), F.col("_found.score").alias("scores"))


def sparse_topk_of_blocks(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Lists of the top-k of tables (qid, terms, weights), read twice, and (id, terms, weights)."""
    return _passed(queries, points, _blocks(queries, F.size("terms"), k), lambda own: _SparseSearch(own, k))


def dense_topk_of_blocks(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Lists of the top-k of tables (qid, v), read twice, and (id, v)."""
    return _passed(queries, points, _blocks(queries, F.size("v").cast("bigint"), k), lambda own: _DenseSearch(own, k))


def topk_among_blocks(candidates: DataFrame, queries: DataFrame, points: DataFrame, k: int, kind: str, stored: bool = False) -> DataFrame:
    """Lists of the best ``k`` per query among given (qid, id) or (qid, ids) of tables (qid, v) and (id, v).

    A query goes to its block with its candidates. Both are written first, unless
    they are ``stored`` already, as they are counted and then read.
    """
    if kind == "sparse":
        queries, points = as_lists(queries, "qid", "v"), as_lists(points, "id", "v")
    lists = F.col("ids") if "ids" in candidates.columns else F.array("id")
    asked = candidates.select("qid", lists.alias("asked"))
    if not stored:
        queries, asked = kept(queries, "query-vectors"), kept(asked, "candidates", compression="zstd")
    pairs = asked.agg(F.coalesce(F.sum(F.size("asked")), F.lit(0))).first()[0]
    size = F.size("terms" if kind == "sparse" else "v").cast("bigint")
    rows = queries.unionByName(asked, allowMissingColumns=True)
    return _passed(rows, points, _blocks(queries, size, k, pairs), lambda own: _Among(own, k, kind))
