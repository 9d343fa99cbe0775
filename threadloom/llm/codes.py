"""Token ids as directly addressable codes.

An id is cut into 8-bit chunks. Level k holds the k-th chunk of every id that
has one, a bitmap that says which of them continue on the next level, and a
rank directory (ones before each block of 512 bits). The place of an id on the
next level is the rank of its bit, so any token is read without decoding a
block.

File, little-endian: magic ``DAC1``, documents, tokens, levels (u64 each); the
documents' ids (i64), null flags (u8) and starts within the file (u64, one more
than documents); then per level its length (u64), chunks (u8), bitmap (u64
words) and directory (u64).

Files hold whole documents in ascending id order (null ids first, ties by text)
and about ``FILE_TOKENS`` tokens; a longer document has a file of its own.
Defined results: null and empty texts have the end id only. Repeated rows are
written each. Other columns are ignored. An empty table has no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadloom.llm.base import query, table, written
from threadloom.llm.files import new_file, open_file
from threadloom.llm.tokens import encoder, runs
from threadloom.llm.warc import spread
from threadloom.session import scratch_path

MAGIC = b"DAC1"
FILE_TOKENS = 1 << 20
BLOCK_WORDS = 8


def _ones(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).astype(np.int64)


def pack_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, directory) of every level."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.zeros(-(-len(rest) // 64) * 64, dtype=np.uint8)
        bits[: len(rest)] = more
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        blocks = np.add.reduceat(_ones(words), np.arange(0, len(words), BLOCK_WORDS)) if len(words) else np.zeros(0, np.int64)
        levels.append(((rest & 255).astype(np.uint8), words, (np.cumsum(blocks) - blocks).astype(np.uint64)))
        if not more.any():
            return levels
        rest = rest[more] >> np.uint32(8)


def pack_file(doc_ids: list, starts: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
    levels = pack_levels(ids)
    yield MAGIC + np.array([len(doc_ids), len(ids), len(levels)], dtype="<u8").tobytes()
    yield np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes()
    yield np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes()
    yield starts.astype("<u8").tobytes()
    for chunks, words, directory in levels:
        yield np.array([len(chunks)], dtype="<u8").tobytes()
        yield chunks.tobytes()
        yield words.astype("<u8").tobytes()
        yield directory.astype("<u8").tobytes()


class CodeFile:
    """Reader over a file's bytes (or a memory map of them); nothing is decoded up front."""

    def __init__(self, raw):
        if bytes(raw[:4]) != MAGIC:
            raise ValueError("not a code file")
        self._raw, self._at = raw, 4
        documents, self.tokens_total, levels = (int(x) for x in self._take(3, "<u8"))
        self.doc_ids = self._take(documents, "<i8")
        self.doc_nulls = self._take(documents, np.uint8)
        self.starts = self._take(documents + 1, "<u8").astype(np.int64)
        self.levels = []
        for _ in range(levels):
            size = int(self._take(1, "<u8")[0])
            chunks = self._take(size, np.uint8)
            words = self._take(-(-size // 64), "<u8")
            self.levels.append((chunks, words, self._take(-(-len(words) // BLOCK_WORDS), "<u8")))

    def _take(self, count: int, kind) -> np.ndarray:
        out = np.frombuffer(self._raw, dtype=kind, count=count, offset=self._at)
        self._at += out.nbytes
        return out

    @staticmethod
    def _rank(level, i: int) -> int:
        """Ones before bit i."""
        _, words, directory = level
        word = i >> 6
        block = word // BLOCK_WORDS
        inside = words[block * BLOCK_WORDS : word]
        low = int(words[word]) & ((1 << (i & 63)) - 1) if i & 63 else 0
        return (int(directory[block]) if block < len(directory) else _total(level)) + int(_ones(inside).sum()) + low.bit_count()

    def token(self, i: int) -> int:
        """The i-th token of the file."""
        if not 0 <= i < self.tokens_total:
            raise IndexError(i)
        value = shift = 0
        for level in self.levels:
            chunks, words, _ = level
            value |= int(chunks[i]) << shift
            if not int(words[i >> 6]) >> (i & 63) & 1:
                return value
            i, shift = self._rank(level, i), shift + 8
        raise ValueError("a code does not end")

    def tokens(self, first: int, last: int) -> np.ndarray:
        """Tokens first .. last-1."""
        if first >= last:
            return np.zeros(0, dtype=np.uint32)
        out = np.zeros(last - first, dtype=np.uint32)
        where = np.arange(last - first)
        for depth, level in enumerate(self.levels):
            chunks, words, _ = level
            out[where] |= chunks[first:last].astype(np.uint32) << np.uint32(8 * depth)
            low, high = first >> 6, -(-last // 64)
            bits = np.unpackbits(words[low:high].view(np.uint8), bitorder="little")[first - low * 64 : last - low * 64]
            where = where[bits.astype(bool)]
            if not len(where):
                break
            first = self._rank(level, first)
            last = first + len(where)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


def _total(level) -> int:
    return int(_ones(level[1]).sum())


def write_codes(documents: DataFrame, root: str, tokenizer: str, end_id: int, spaced: bool, doc_id: str = "doc_id", text: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the files below ``root``; (part, number, path, documents, tokens, base) of each.

    ``base`` is the number of ids in all files before it. Texts move once, to
    ranges of ids; what is added up afterwards has a row per file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer, spaced).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        doc_ids: list = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            counts = np.array([len(x) // 4 for x in held], dtype=np.int64)
            path = f"{root}/part-{part:05d}-{number:05d}.dac"
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            with new_file(path) as out:
                for piece in pack_file(doc_ids, np.concatenate([[0], np.cumsum(counts)]), ids):
                    out.write(piece)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "path": [path],
                 "documents": pa.array([len(doc_ids)], pa.int64()), "tokens": pa.array([len(ids)], pa.int64())}
            )

        for batch in batches:
            own = batch[0].to_pylist()
            at = 0
            for run in runs(batch[1]):
                for ids in encode(run):
                    ids += end
                    if held and size + len(ids) // 4 > file_tokens:
                        yield flush()
                        number, size = number + 1, 0
                        doc_ids.clear(), held.clear()
                    doc_ids.append(own[at])
                    held.append(ids)
                    size += len(ids) // 4
                    at += 1
        if held:
            yield flush()

    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    files = written(
        rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(write, "part int, number int, path string, documents bigint, tokens bigint"),
        "code-files",
    )
    parts = files.groupBy("part").agg(F.sum("tokens").alias("own"))  # one row a task of the job above
    before = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("part_base"))
    earlier = F.sum("tokens").over(Window.partitionBy("part").orderBy("number")) - F.col("tokens")
    return files.withColumn("earlier", earlier).join(before, "part").select(
        "part", "number", "path", "documents", "tokens", (F.col("part_base") + F.col("earlier")).alias("base")
    )


def read_codes(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids of every document in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                with open_file(path) as source:
                    codes = CodeFile(source.read())
                step = 2000
                for low in range(0, len(codes.doc_ids), step):
                    high = min(low + step, len(codes.doc_ids))
                    starts = codes.starts[low : high + 1]
                    ids = codes.tokens(int(starts[0]), int(starts[-1]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(codes.doc_ids[low:high], mask=codes.doc_nulls[low:high].astype(bool)),
                            pa.array(starts[:-1] + base),
                            pa.ListArray.from_arrays(pa.array((starts - starts[0]).astype(np.int32)), pa.array(ids.view(np.int32))),
                        ],
                        names=["doc_id", "start", "ids"],
                    )

    return files.select("path", "base").mapInArrow(read, "doc_id bigint, start bigint, ids array<int>")


def summaries(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids, from the files."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch[2].offsets.to_numpy().astype(np.int64)
            raw = batch[2].values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch[0], batch[1], pa.array(np.diff(offsets)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return read_codes(files).mapInArrow(add, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


@query("op1_token_codes")
def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_codes(
        table(spark, sf_dir, "documents"), scratch_path(spark, "codes"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, spaced=False
    )
    return summaries(spread(written(files, "code-bases")))
