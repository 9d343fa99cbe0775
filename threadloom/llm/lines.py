"""Repeated runs of lines, found with a suffix array over line ids.

Lines that occur once can take part in no repeated run and are set aside. The
others get ids by rank; prefix doubling then ranks the suffixes by their first
1, 2, 4, ... lines: each round pairs the rank of a suffix with the rank of the
suffix that many lines later, sorts the pairs over all tasks and gives equal
pairs one rank. A suffix whose rank is its own leaves the rounds. The rounds end
at the depth that the shortest qualifying runs need.

A run qualifies when it has ``min_words`` words. The suffixes that agree over
the qualifying length form an interval of the suffix array (their longest common
prefix is that long), looked up as the pair of ranks of the first and the last
power of two of its lines. All members of an interval but the first in corpus
order are later copies. The shortest qualifying runs from each line on and up to
each line cover exactly the maximal runs, so their union is what is deleted.

A line is known by two independent 64-bit hashes of its bytes.

Corpus order is (document id, null ids last, then text hash), then the line.
Defined results: a null text stays null, an empty one is one empty line without
words; both lose nothing. Repeated rows are copies: the first stays. A run may
overlap its own copy; then its first lines stay. Words are runs without ASCII
white space. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from threadloom.llm import words as W
from threadloom.llm.base import query, table, tidy, written

MIN_WORDS = 50


def _line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines of every text, and each text's first line number in the run."""
    breaks = np.flatnonzero(data == 10)
    per_text = np.bincount(np.searchsorted(offsets, breaks, side="right") - 1, minlength=len(offsets) - 1) + 1
    first = np.concatenate([[0], np.cumsum(per_text)])
    starts = np.empty(first[-1], dtype=np.int64)
    ends = np.empty(first[-1], dtype=np.int64)
    opening = np.zeros(first[-1], dtype=bool)
    opening[first[:-1]] = True
    closing = np.zeros(first[-1], dtype=bool)
    closing[first[1:] - 1] = True
    starts[opening], starts[~opening] = offsets[:-1], breaks + 1
    ends[closing], ends[~closing] = offsets[1:], breaks
    return starts, ends, first


def _lines_of(column: pa.Array, min_words: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(row, rows' line counts, line arrays) for runs of texts.

    Line arrays: number in the text, two hashes, last line of the shortest window
    with enough words that begins here, first line of the shortest that ends here
    (-1: none).
    """
    for row, data, offsets in W.slices(column):
        starts, ends, first = _line_spans(data, offsets)
        words, _, _ = W.spans(data, offsets, W.NON_SPACE)
        per_line = np.bincount(np.searchsorted(starts, words, side="right") - 1, minlength=len(starts))
        total = np.concatenate([[0], np.cumsum(per_line)])
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        number = np.arange(len(starts)) - first[owner]
        stop = np.searchsorted(total, total[:-1] + min_words, side="left")
        forward = np.where(stop <= first[owner + 1], stop - 1 - first[owner], -1)
        begin = np.searchsorted(total, total[1:] - min_words, side="right") - 1
        backward = np.where((begin >= first[owner]) & (total[1:] >= min_words), begin - first[owner], -1)
        yield row, np.diff(first), [number, W.span_hashes(data, starts, ends).view(np.int64), W.byte_hashes(data, starts, ends, 1).view(np.int64), forward, backward]


_LINE_SCHEMA = (
    "row_key bigint, doc_id {kind}, text_hash bigint, line int, hash bigint, second bigint, until int, since int"
)


def line_table(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row per line of ``documents`` (row_key, doc_id, text); null texts have none."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, counts, (number, hashes, second, forward, backward) in _lines_of(batch[3], min_words):
                source = pa.array(np.repeat(np.arange(row, row + len(counts)), counts))
                yield pa.RecordBatch.from_arrays(
                    [batch[k].take(source) for k in range(3)]
                    + [pa.array(number.astype(np.int32)), pa.array(hashes), pa.array(second)]
                    + [pa.array(forward.astype(np.int32)), pa.array(backward.astype(np.int32))],
                    names=["row_key", "doc_id", "text_hash", "line", "hash", "second", "until", "since"],
                )

    rows = documents.where("text is not null").select("row_key", "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(scan, _LINE_SCHEMA.format(kind=dict(documents.dtypes)["doc_id"]))


def _ranked(frame: DataFrame, *order: str) -> DataFrame:
    """``rank`` in the order of the columns: rows are sorted over all tasks, numbers grow with the task and the row."""
    return frame.orderBy(*order).withColumn("rank", F.monotonically_increasing_id())


def later_copies(lines: DataFrame) -> DataFrame:
    """row_key, first, last of every shortest qualifying window that is not the first of its kind.

    ``lines`` is a written ``line_table``.
    """
    repeated = lines.groupBy("hash", "second").count().where("count > 1").drop("count")
    ids = written(_ranked(repeated, "hash", "second"), "line-ids")
    level = written(lines.join(ids, ["hash", "second"]).select("row_key", "line", "rank"), "ranks-0")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "row_key").alias("doc")
    windows = written(
        lines.where("until >= 0").select("row_key", place, F.col("line").alias("first"), F.col("until").alias("last"))
        .unionByName(lines.where("since >= 0").select("row_key", place, F.col("since").alias("first"), F.col("line").alias("last")))
        .join(level.select("row_key", F.col("line").alias("first"), F.col("rank").alias("head_line")), ["row_key", "first"])
        .join(level.select("row_key", F.col("line").alias("last"), F.col("rank").alias("tail_line")), ["row_key", "last"])
        .drop("head_line", "tail_line")
        .distinct(),
        "windows",
    )
    deepest = windows.agg(F.max(F.expr("last - first + 1"))).first()[0] or 0
    later = windows.select("row_key", "first", "last").where("false")
    depth = 0
    while deepest >= 1 << depth:
        step = 1 << depth
        keyed = (
            windows.withColumn("size", F.expr("last - first + 1"))
            .where(f"size >= {step} and size < {2 * step}")
            .join(level.select("row_key", F.col("line").alias("first"), F.col("rank").alias("head")), ["row_key", "first"])
            .join(
                level.select("row_key", (F.col("line") + (step - 1)).alias("last"), F.col("rank").alias("tail")),
                ["row_key", "last"],
            )
        )
        interval = (
            keyed.groupBy("size", "head", "tail")
            .agg(F.min(F.struct("doc", "first")).alias("origin"), F.count("*").alias("members"))
            .where("members > 1")
        )
        found = keyed.join(interval, ["size", "head", "tail"]).where(F.struct("doc", "first") > F.col("origin"))
        # written round by round: the plans stay small, and their shuffle files can go
        later = later.unionByName(written(found.select("row_key", "first", "last"), f"later-{depth}"))
        tidy(lines.sparkSession)
        depth += 1
        if deepest < 1 << depth:
            break
        pairs = written(
            level.join(
                level.select("row_key", (F.col("line") - step).alias("line"), F.col("rank").alias("next")), ["row_key", "line"]
            ),
            f"pairs-{depth}",
        )
        shared = pairs.groupBy("rank", "next").count().where("count > 1").select(F.col("rank").alias("head"), F.col("next").alias("tail"))
        ranks = written(_ranked(shared, "head", "tail"), f"pair-ranks-{depth}")
        level = written(
            pairs.withColumnRenamed("rank", "head").withColumnRenamed("next", "tail").join(ranks, ["head", "tail"]).select("row_key", "line", "rank"),
            f"ranks-{depth}",
        )
        if level.isEmpty():
            break
    return written(later.distinct(), "later-copies")


_REWRITTEN = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("n_deleted", T.LongType()), T.StructField("runs", T.StringType())]
)


@F.pandas_udf(_REWRITTEN)
def _without(texts: pd.Series, windows: pd.Series) -> pd.DataFrame:
    kept_texts, deleted, runs = [], [], []
    for text, spans in zip(texts, windows):
        if text is None or spans is None:
            kept_texts.append(text), deleted.append(0), runs.append("")
            continue
        lines = text.split("\n")
        merged: list[list[int]] = []
        for first, last in sorted((int(s["first"]), int(s["last"])) for s in spans):
            if merged and first <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        left, at = [], 0
        for first, last in merged:
            left.extend(lines[at:first])
            at = last + 1
        left.extend(lines[at:])
        kept_texts.append("\n".join(left))
        deleted.append(sum(last - first + 1 for first, last in merged))
        runs.append(",".join(f"{first}-{last}" for first, last in merged))
    return pd.DataFrame({"text": kept_texts, "n_deleted": deleted, "runs": runs})


def dedup_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, output: tuple[str, str, str] = ("kept_text", "n_deleted", "runs")) -> DataFrame:
    """Every column of ``documents`` as it is, with kept_text, n_deleted and runs ("first-last", from 0, comma-joined).

    ``kept_text`` is the text without the lines of later copies.
    """
    names = documents.columns
    rows = written(
        documents.select(
            F.monotonically_increasing_id().alias("row_key"), *[F.col(f"`{name}`").alias(f"col_{i}") for i, name in enumerate(names)]
        ),
        "documents",
    )
    own_id, own_text = f"col_{names.index(doc_id)}", f"col_{names.index(text)}"
    lines = written(line_table(rows.select("row_key", F.col(own_id).alias("doc_id"), F.col(own_text).alias("text")), min_words), "lines")
    windows = later_copies(lines).groupBy("row_key").agg(F.collect_set(F.struct("first", "last")).alias("windows"))
    hit = F.col("windows").isNotNull()
    # texts without deletions do not go through Python
    done = rows.join(windows, "row_key", "left").withColumn("done", _without(F.when(hit, F.col(own_text)), "windows"))
    return done.select(
        *[F.col(f"col_{i}").alias(name) for i, name in enumerate(names)],
        F.when(hit, F.col("done.text")).otherwise(F.col(own_text)).alias(output[0]),
        F.col("done.n_deleted").alias(output[1]),
        F.col("done.runs").alias(output[2]),
    )


_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS k FROM documents
), l AS (
  SELECT k, unnest(range(1, len(s) + 1)) - 1 AS i, unnest(s) AS line FROM (SELECT k, string_split(text, chr(10)) AS s FROM d WHERE text IS NOT NULL)
), w AS (
  SELECT k, i, line, len(list_filter(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS n FROM l
), p AS (
  SELECT b.k, b.i, b.n, a.k AS ak, b.i - a.i AS diagonal FROM w a JOIN w b ON a.line = b.line AND (a.k < b.k OR (a.k = b.k AND a.i < b.i))
), g AS (
  SELECT *, i - row_number() OVER (PARTITION BY k, ak, diagonal ORDER BY i) AS island FROM p
), r AS (
  SELECT k, ak, diagonal, island FROM g GROUP BY k, ak, diagonal, island HAVING sum(n) >= 50
), x AS (
  SELECT DISTINCT g.k, g.i FROM g JOIN r USING (k, ak, diagonal, island)
), y AS (
  SELECT k, i, i - row_number() OVER (PARTITION BY k ORDER BY i) AS part FROM x
), z AS (
  SELECT k, part, min(i) AS first, max(i) AS last FROM y GROUP BY k, part
), runs AS (
  SELECT k, string_agg(first || '-' || last, ',' ORDER BY first) AS runs, sum(last - first + 1) AS n FROM z GROUP BY k
), kept AS (
  SELECT l.k, string_agg(line, chr(10) ORDER BY l.i) AS t FROM l ANTI JOIN x ON l.k = x.k AND l.i = x.i GROUP BY l.k
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_deleted, coalesce(runs, '') AS runs,
  CASE WHEN text IS NULL THEN NULL ELSE coalesce(t, '') END AS kept_text
FROM d LEFT JOIN runs USING (k) LEFT JOIN kept USING (k)
"""


@query("op9_line_dedup", _SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_deleted", "runs", "kept_text")
