"""Best-fit packing by patterns fitted to the length histogram.

Texts become pieces of at most ``capacity`` tokens. Only the histogram of piece
lengths (at most ``capacity`` numbers, whatever the corpus) reaches the driver.
There, patterns of one to three lengths that fill a sequence are enumerated,
repeat counts are fitted to the histogram by non-negative least squares and
rounded down, and what is left is packed best fit, longest first, many equal
sequences at a time. The result is a plan: for each length, ranges of ranks and
where they go. Its rows are bounded by the lengths, not by the pieces. Pieces
get their rank among those of their length and are placed by a look-up.

Defined results: null and empty texts are one piece with the end id. Repeated
rows are packed each. An empty table gives an empty result. Columns other than
id and text are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadloom.llm.base import query, table, written
from threadloom.llm.tokens import encoder, runs

CAPACITY = 2048
THIRD_STEPS = 32  # triples take their second length from this many steps of the capacity
RANK_ROWS = 100_000


def piece_table(documents: DataFrame, tokenizer: str, end_id: int, capacity: int, spaced: bool, keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row_key, piece, start, length, ids_crc32 (and ids) of every piece."""
    kind = dict(documents.dtypes)[doc_id]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaced).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            at = 0
            for run in runs(batch[2]):
                source, piece, start, length, crc, kept = [], [], [], [], [], []
                for ids in encode(run):
                    ids += end
                    total = len(ids) // 4
                    first = total % capacity or capacity if total > capacity else total
                    low, number = 0, 0
                    while low < total:
                        high = min(low + (first if not low else capacity), total)
                        part = ids[low * 4 : high * 4]
                        source.append(at), piece.append(number), start.append(low), length.append(high - low)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            kept.append(np.frombuffer(part, dtype="<i4"))
                        low, number = high, number + 1
                    at += 1
                own = pa.array(source, pa.int64())
                columns = [batch[0].take(own), batch[1].take(own), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "row_key", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(np.concatenate(kept))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, row_key bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row_key"), F.col(text).cast("string").alias("text")
    ).mapInArrow(cut, schema)


def patterns(capacity: int, lengths: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none) that fill a sequence: singles, pairs, triples."""
    present = np.zeros(capacity + 1, dtype=bool)
    present[lengths] = True
    found = [np.array([[capacity, 0, 0]])] if present[capacity] else []
    a = np.arange(1, capacity)
    b = capacity - a
    pair = (a >= b) & present[a] & present[b]
    found.append(np.stack([a[pair], b[pair], np.zeros(pair.sum(), dtype=int)], axis=1))
    step = max(1, capacity // THIRD_STEPS)
    one, two = np.meshgrid(a, np.arange(step, capacity, step), indexing="ij")
    one, two = one.ravel(), two.ravel()
    three = capacity - one - two
    whole = three > 0
    one, two, three = one[whole], two[whole], three[whole]
    triple = present[one] & present[two] & present[three] & (one >= three)
    found.append(np.stack([one[triple], two[triple], three[triple]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=int)


def fit(table_of: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative repeat counts x that make the patterns' lengths add up to the histogram.

    Accelerated projected gradient steps on ||Ax - h||^2, lengths weighted by
    their tokens; A has three entries a column and is never formed.
    """
    weight = np.sqrt(np.arange(len(histogram)) / len(histogram))
    weight[0] = 0

    def forward(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(table_of[:, k], weights=x, minlength=len(histogram)) for k in range(3)) * weight

    def back(y: np.ndarray) -> np.ndarray:
        y = y * weight
        return y[table_of].sum(axis=1)

    x = np.zeros(len(table_of))
    probe = np.ones(len(table_of))
    for _ in range(20):
        probe = back(forward(probe))
        top = np.linalg.norm(probe)
        probe /= top
    target = histogram * weight
    y, momentum = x, 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(forward(y) - target) / (1.05 * top))
        later = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = new + (momentum - 1) / later * (new - x)
        x, momentum = new, later
    return x


def plan(histogram: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """(rows, sequences): rows of (length, first rank, ranks, first sequence, pieces a sequence, offset).

    ``histogram[n]``: pieces of n tokens.
    """
    left = histogram.astype(np.int64).copy()
    used = np.zeros_like(left)
    rows: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, sequence: int, copies: int, each: int, offset: int) -> None:
        rows.append((length, int(used[length]), copies * each, sequence, each, offset))
        used[length] += copies * each
        left[length] -= copies * each

    shapes = patterns(capacity, np.flatnonzero(left[1:]) + 1)
    if len(shapes):
        repeats = np.floor(fit(shapes, left)).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            lengths, need = np.unique(shapes[k][shapes[k] > 0], return_counts=True)
            copies = min(int(repeats[k]), int((left[lengths] // need).min()))
            if copies <= 0:
                continue
            offset = 0
            for length, each in zip(lengths.tolist(), need.tolist()):
                place(length, sequences, copies, each, offset)
                offset += length * each
            sequences += copies
    # best fit of the rest: open sequences by free room, many equal ones at a time
    rooms: list[int] = []
    open_runs: dict[int, list[tuple[int, int]]] = {}

    def add(room: int, sequence: int, copies: int) -> None:
        if not room or not copies:
            return
        if room not in open_runs:
            bisect.insort(rooms, room)
            open_runs[room] = []
        open_runs[room].append((sequence, copies))

    for length in range(capacity, 0, -1):
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            count = int(left[length])
            if at < len(rooms):
                room = rooms[at]
                sequence, copies = open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room]
                    del rooms[at]
            else:
                room, sequence = capacity, sequences
                copies = -(-count // (capacity // length))
                sequences += copies
            each = room // length
            if count >= copies * each:
                filled = copies
            elif count >= each:
                filled = count // each
            else:
                each, filled = count, 1
            place(length, sequence, filled, each, capacity - room)
            add(room - length * each, sequence, filled)
            add(room, sequence + filled, copies - filled)
    out = np.array(rows, dtype=np.int64).reshape(-1, 6)
    return out[np.lexsort((out[:, 1], out[:, 0]))], sequences


def _with_ranks(pieces: DataFrame) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0.

    Lengths are dealt into buckets by row, so that a length that very many
    pieces share is numbered by many tasks; bucket totals give the first ranks.
    """
    buckets = 1 + pieces.count() // RANK_ROWS
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row_key", "piece"), F.lit(buckets)))
    totals = dealt.groupBy("length", "bucket").agg(F.count("*").alias("own"))
    bases = totals.withColumn("base", F.sum("own").over(Window.partitionBy("length").orderBy("bucket")) - F.col("own")).drop("own")
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row_key", "piece")) - 1
    return (
        dealt.withColumn("inside", inside).join(bases, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("inside")).drop("base", "inside", "bucket")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset. ``pieces`` is a written ``piece_table``."""
    counts = pieces.groupBy("length").count().toArrow()  # at most ``capacity`` rows
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    histogram[counts["length"].to_numpy()] = counts["count"].to_numpy()
    rows, _ = plan(histogram, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(rows)
    names = pieces.columns

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        keys = (at[:, 0] << 48) + at[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = at[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            inside = rank - row[:, 1]
            sequence = row[:, 3] + inside // row[:, 4]
            offset = row[:, 5] + (inside % row[:, 4]) * length
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes) + ", sequence_id bigint, offset bigint"
    return _with_ranks(pieces).mapInArrow(look_up, schema)


def pack_documents(documents: DataFrame, tokenizer: str | None = None, end_id: int = 0, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return pack(written(piece_table(documents, path, end_id, capacity, spaced=True, keep_ids=keep_ids), "pieces"), capacity)


@query("op7_pattern_packing")
def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
