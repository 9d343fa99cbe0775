"""Periodic runs of words: stretches that repeat themselves at once.

A run is a stretch of words with smallest period q (words q apart are the same),
at least ``max(min_length, 2 * q)`` long, that no neighbouring word extends.

Method, online dyadic square catching: every completed block of 2^k words (at a
multiple of 2^k) is a catcher for squares of period 2^(k+1)-1 to 2^(k+2)-2,
whose first half must hold such a block. Each appended word ends one suffix of
2^k words per level, which is compared with the two catchers whose periods it
can complete. A catch grows to the left and right by comparing words, so equal
fingerprints alone decide nothing; stretches that reach the newest word stay
open and grow with it. Squares of one period that touch are one run, and a
multiple of a known run's period inside that run is the same run.

Words are appended in chunks, so the comparisons of a chunk are a few array
operations a level; memory is in proportion to one chunk and one document.
Documents are independent rows: nothing is shuffled and no group exists.

Defined results: null and empty text have no words and no runs; their collapsed
text is empty. Ids are not used, so null and repeated ids are as good as others.
Repeated rows give repeated results. The other columns stay unless an output
column has their name; then the output replaces them. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from threadloom.llm.base import query, table
from threadloom.llm.words import mix

MIN_LENGTH = 12
#: words detected together; longer documents are appended in chunks of as many
CHUNK_WORDS = 1 << 17
_C = np.uint64(0x9E3779B97F4A7C15)


class SquareCatcher:
    """Runs of a sequence of word numbers that is appended bit by bit."""

    def __init__(self, min_length: int = MIN_LENGTH, max_period: int | None = None):
        self.min_length = min_length
        self.max_period = max_period
        self.codes = np.zeros(1024, dtype=np.int64)
        #: number of the longest-period run known at each word, -1 for none
        self.owner = np.full(1024, -1, dtype=np.int32)
        self.n = 0
        self.levels: list[tuple[int, np.ndarray]] = []
        self.live: dict[int, tuple[int, int | None]] = {}
        self.checked: dict[int, int] = {}
        self.found: list[list[int]] = []

    def append(self, codes: np.ndarray) -> None:
        old, n = self.n, self.n + len(codes)
        if n > len(self.codes):
            grown = max(n, 2 * len(self.codes))
            self.codes = np.concatenate([self.codes[:old], np.zeros(grown - old, dtype=np.int64)])
            self.owner = np.concatenate([self.owner[:old], np.full(grown - old, -1, dtype=np.int32)])
        self.codes[old:n] = codes
        self.n = n
        for period, (left, number) in list(self.live.items()):
            self._settle(period, left, self._right(period, old - period), number)
        level, size = 0, 1
        while size <= n and (self.max_period is None or 2 * size - 1 <= self.max_period):
            self._compare(level, size, old)
            level, size = level + 1, 2 * size
        for level, (base, prints) in enumerate(self.levels):  # older blocks wait for nothing any more
            kept = max(base, n + 1 - (6 << level))
            self.levels[level] = (kept, prints[kept - base :].copy())

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs of the words so far, by start, then period."""
        best: dict[tuple[int, int], int] = {}
        for start, end, period in self.found:
            if period < best.get((start, end), period + 1):
                best[start, end] = period
        return sorted((start, end - start, period) for (start, end), period in best.items())

    def _right(self, period: int, at: int) -> int:
        """First place from ``at`` on whose word differs from the one a period later (or has none there)."""
        step, limit = 64, self.n - period
        while at < limit:
            stop = min(at + step, limit)
            differs = self.codes[at:stop] != self.codes[at + period : stop + period]
            first = int(differs.argmax())
            if differs[first]:
                return at + first
            at, step = stop, step * 4
        return at

    def _left(self, period: int, at: int) -> int:
        """Start of the equal stretch that ends before ``at``."""
        step = 64
        while at > 0:
            stop = max(at - step, 0)
            differs = (self.codes[stop:at] != self.codes[stop + period : at + period])[::-1]
            first = int(differs.argmax())
            if differs[first]:
                return at - first
            at, step = stop, step * 4
        return at

    def _settle(self, period: int, left: int, right: int, number: int | None) -> None:
        """Notes an equal stretch: a run if long enough, open if it reaches the newest word."""
        if right - left >= max(period, self.min_length - period):
            if number is None:
                number = len(self.found)
                self.found.append([left, right + period, period])
                self.owner[left : right + period] = number
            else:
                self.owner[self.found[number][1] : right + period] = number
                self.found[number][1] = right + period
        self.checked[period] = right
        if right == self.n - period:
            self.live[period] = (left, number)
        else:
            self.live.pop(period, None)

    def _compare(self, level: int, size: int, old: int) -> None:
        """Suffixes of ``size`` words that the newest words end, against the blocks that wait for them."""
        first, last = max(0, old - size + 1), self.n - size + 1
        if level:
            base, below = self.levels[level - 1]
            half = size // 2
            fresh = mix(below[first - base : last - base] * _C + below[first + half - base : last + half - base])
        else:
            fresh = mix(self.codes[first:last].view(np.uint64))
        base, prints = self.levels[level] if level < len(self.levels) else (first, fresh[:0])
        prints = np.concatenate([prints, fresh])
        least = 2 * size - 1
        places = np.arange(max(first, least), last)
        blocks = (places - least) >> level << level
        keys = []
        many = (self.n >> level) + 1
        for behind in (0, size):
            skipped = int(np.searchsorted(blocks, behind))  # blocks before the first word
            ends, starts = places[skipped:], blocks[skipped:] - behind
            equal = np.flatnonzero(prints[ends - base] == prints[starts - base])
            keys.append((ends[equal] - starts[equal]) * many + (starts[equal] >> level))
        self.levels[level : level + 1] = [(base, prints)]
        keys = np.sort(np.concatenate(keys))
        if len(keys):
            self._catch(keys, many, level, size)

    def _catch(self, keys: np.ndarray, many: int, level: int, size: int) -> None:
        """Neighbouring equal blocks of one period grow into stretches, smallest period first."""
        edges = np.flatnonzero(np.diff(keys) != 1) + 1
        starts = np.concatenate([[0], edges])
        ends = np.concatenate([edges, [len(keys)]])
        periods = keys[starts] // many
        left = (keys[starts] % many) << level
        right = left + ((ends - starts) << level)
        # beyond the blocks a stretch has less than a block on either side, unless it reaches the newest word
        open_end = right + size + periods >= self.n
        long_enough = right - left + 2 * (size - 1) >= np.maximum(periods, self.min_length - periods)
        wanted = open_end | long_enough
        for period, at, stop in zip(periods[wanted].tolist(), left[wanted].tolist(), right[wanted].tolist()):
            while at < stop:
                if at < self.checked.get(period, 0):
                    at += size
                    continue
                number = self.owner[at]
                if number >= 0:
                    _, end, known = self.found[number]
                    if period % known == 0 and end >= stop + period:
                        break
                reach = self._right(period, at)
                if reach > at:
                    self._settle(period, self._left(period, at), reach, None)
                at = max(at + size, reach >> level << level)


def runs_of_documents(documents: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Runs of each document's words; a batch is one sequence, cut by words that occur nowhere else."""
    sizes = [len(words) for words in documents]
    codes = np.empty(sum(sizes) + len(sizes), dtype=np.int64)
    starts, at, base = [], 0, 0
    for number, words in enumerate(documents):
        known: dict[bytes, int] = {}
        codes[at : at + len(words)] = [known.setdefault(w, len(known)) for w in words]
        codes[at : at + len(words)] += base
        codes[at + len(words)] = -1 - number
        base += len(known)
        starts.append(at)
        at += len(words) + 1
    catcher = SquareCatcher(min_length, max(sizes, default=0) // 2 or 1)
    for first in range(0, len(codes), CHUNK_WORDS):
        catcher.append(codes[first : first + CHUNK_WORDS])
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    found = catcher.runs()
    owners = np.searchsorted(starts, [start for start, _, _ in found], side="right") - 1
    for (start, length, period), owner in zip(found, owners.tolist()):
        out[owner].append((start - starts[owner], length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds behind its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join(compress(words, keep.tolist()))


def _batches(column: pa.Array) -> Iterator[list[list[bytes]]]:
    """Words of consecutive texts, about ``CHUNK_WORDS`` together (a longer text alone)."""
    pending: list[list[bytes]] = []
    count = 0
    for value in column:
        words = (value.as_py() or b"").split()  # the six ASCII spaces of the contract
        if pending and count + len(words) > CHUNK_WORDS:
            yield pending
            pending, count = [], 0
        pending.append(words)
        count += len(words)
    if pending:
        yield pending


def collapse_runs(
    docs: DataFrame, text: str = "text", output: tuple[str, str] = ("runs", "collapsed_text"), min_length: int = MIN_LENGTH
) -> DataFrame:
    """``docs`` with its runs (array of start, length, period in words) and the text without their repeats."""
    runs_name, text_name = output
    kept = [name for name in docs.columns if name not in output]
    run = T.StructType.fromDDL("start bigint, length bigint, period bigint")
    # places instead of names inside the task: mapInArrow takes no name with a dot
    given = docs.select(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(kept)], F.col(f"`{text}`").cast("binary").alias("words_of"))
    schema = T.StructType(given.schema.fields[:-1]).add("runs", T.ArrayType(run)).add("rest", T.StringType())
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(batch.num_columns - 1)
            first = 0
            for documents in _batches(source):
                found = runs_of_documents(documents, min_length)
                rows = batch.slice(first, len(documents))
                first += len(documents)
                runs = pa.array([[dict(zip(("start", "length", "period"), run)) for run in part] for part in found], kind)
                texts = pa.array([collapsed(words, part) for words, part in zip(documents, found)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], runs, texts], schema.names)

    return given.mapInArrow(detect, schema).toDF(*kept, runs_name, text_name)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """A tenth of the texts (by checksum of the id) repeat a piece of themselves to their end; null ids never do."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    n = F.size("__w").cast("bigint")
    words = F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
    repeated = F.expr("array_join(transform(sequence(0L, size(__w) - 1L), i -> __w[cast(if(i < __a, i, __a + (i - __a) % __p) as int)]), ' ')")
    chosen = docs.select("doc_id", "text", words.alias("__w"))
    placed = chosen.withColumns({"__a": F.when(n > 0, a)}).withColumns({"__p": F.when(n > 0, p)})
    return placed.select("doc_id", F.when(F.size("__w") > 0, repeated).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    """Runs of every whole document and digests of what collapsing leaves."""
    done = collapse_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    longest = F.expr(
        "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    )
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return done.withColumn("__best", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("__best.start")).alias("start"),
        F.col("__best.length").alias("length"),
        (-F.col("__best.period")).alias("period"),
        F.floor(F.expr("1000 * __best.length div (-__best.period)")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )
