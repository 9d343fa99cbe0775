"""Benchmark decontamination by winnowed fingerprints.

Benchmark and corpus are winnowed alike: of every ``SPAN - GRAM + 1``
consecutive k-gram hashes the smallest (the last of equal ones) is kept, so a
shared span of ``SPAN`` words always shares a kept fingerprint. Fingerprints
are joined; each hit is extended to the spans of ``SPAN`` words around it, and
those are joined with the spans of the benchmark, which decides. Items of fewer
words have one window, the whole item; their lengths are few, and for each the
corpus is hashed at that length.

A filter of fixed size over the benchmark's fingerprints keeps corpus rows that
cannot join from leaving the scan; it drops nothing that matters.

Defined results: null and empty texts have no words; they hit nothing and are
not contaminated. Rows with the same id are separate documents, items with the
same id count once. Items with a null id are one item: its windows hit like any
other's, it is counted, and it is left out of the list of ids. With an empty benchmark nothing
is hit. Texts are used whole. Columns are read by name, others are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.llm import words as W
from threadloom.llm.base import bitmap, in_bitmap, query, table, written

SPAN, GRAM = 10, 5
_WINDOW = SPAN - GRAM + 1
_U = np.uint64

_HITS = "array<struct<place:int, size:int, print:bigint, spans:array<bigint>>>"


def _sized(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of grams of different sizes do not meet."""
    return W.mix(hashes ^ _U(size * 0x5851F42D4C957F2D & (1 << 64) - 1))


def _selected(grams: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places of the winnowed grams; ``whole[i]``: the span that begins at i lies in one text."""
    count = len(whole)
    best = grams[:count].copy()
    at = np.arange(count)
    for step in range(1, _WINDOW):
        other = grams[step : step + count]
        better = other <= best
        best[better] = other[better]
        at[better] = np.arange(count)[better] + step
    chosen = np.zeros(len(grams), dtype=bool)
    chosen[at[whole]] = True
    return np.flatnonzero(chosen)


def _hits(hashes: np.ndarray, texts: np.ndarray, lengths: tuple[int, ...], keep) -> list[tuple]:
    """(word places, gram size, prints, span table) of the prints that ``keep`` admits.

    The span table has a row for each hit: the hashes of the spans that hold the
    gram, 0 where such a span leaves the text.
    """
    found = []
    spans, whole = W.gram_hashes(hashes, texts, SPAN)
    if len(spans):
        grams, _ = W.gram_hashes(hashes, texts, GRAM)
        places = _selected(grams, whole)
        prints = _sized(grams[places], GRAM)
        kept = keep(prints)
        places, prints = places[kept], prints[kept]
        spans = np.where(whole, spans | _U(1), _U(0))
        around = places[:, None] - np.arange(_WINDOW)[None, :]
        inside = (around >= 0) & (around < len(spans))
        found.append((places, GRAM, prints, np.where(inside, spans[np.clip(around, 0, len(spans) - 1)], _U(0))))
    for size in lengths:
        grams, whole = W.gram_hashes(hashes, texts, size)
        prints = _sized(grams, size)
        places = np.flatnonzero(whole & keep(prints)) if len(grams) else np.zeros(0, dtype=np.int64)
        found.append((places, -size, prints[places], np.zeros((len(places), 0), dtype=np.uint64)))
    return found


def _texts(column: pa.Array, lengths: tuple[int, ...], keep) -> Iterator[tuple[np.ndarray, pa.Array, int]]:
    """Word counts and hits of runs of texts."""
    for _, data, offsets in W.slices(column):
        low = W.lower_ascii(data)
        starts, ends, owner = W.spans(low, offsets, W.ALPHANUMERIC)
        hashes = W.span_hashes(low, starts, ends)
        rows = len(offsets) - 1
        counts = np.bincount(owner, minlength=rows)
        base = np.cumsum(counts) - counts
        parts = _hits(hashes, owner, lengths, keep)
        places = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, dtype=np.int64)
        sizes = np.concatenate([np.full(len(p[0]), p[1], dtype=np.int32) for p in parts]) if parts else np.zeros(0, np.int32)
        prints = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, dtype=np.uint64)
        widths = np.concatenate([np.full(len(p[0]), p[3].shape[1], dtype=np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
        flat = np.concatenate([p[3].ravel() for p in parts]) if parts else np.zeros(0, dtype=np.uint64)
        own = owner[places] if len(places) else np.zeros(0, dtype=np.int64)
        order = np.argsort(own, kind="stable")
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(widths)]), pa.int32()), pa.array(flat.view(np.int64))
        ).take(pa.array(order))
        hits = pa.StructArray.from_arrays(
            [
                pa.array((places - base[own])[order].astype(np.int32)),
                pa.array(sizes[order]),
                pa.array(prints[order].view(np.int64)),
                lists,
            ],
            names=["place", "size", "print", "spans"],
        )
        per_text = np.bincount(own, minlength=rows)
        yield counts, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32()), hits), rows


def fingerprints(frame: DataFrame, key: str, text: str, lengths: tuple[int, ...], words: bytes | None) -> DataFrame:
    """key, n_words and hits of every row; with ``words`` only prints in that filter."""
    shared = frame.sparkSession.sparkContext.broadcast(words) if words is not None else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.int64) if shared is not None else None
        keep = (lambda p: in_bitmap(bits, p)) if bits is not None else (lambda p: np.ones(len(p), dtype=bool))
        for batch in batches:
            row = 0
            for counts, hits, rows in _texts(batch[1], lengths, keep):
                yield pa.RecordBatch.from_arrays(
                    [batch[0].slice(row, rows), pa.array(counts.astype(np.int64)), hits], names=[key, "n_words", "hits"]
                )
                row += rows

    kind = dict(frame.dtypes)[key]
    return frame.select(key, F.col(text).cast("string")).mapInArrow(scan, f"`{key}` {kind}, n_words bigint, hits {_HITS}")


def _windows(rows: DataFrame, *keys: str) -> DataFrame:
    """The spans of every hit, or the gram itself where it is a whole short item."""
    hit = F.explode("hits").alias("hit")
    flat = rows.select(*keys, "n_words", hit).select(*keys, "n_words", "hit.*")
    long = flat.where("size > 0").select(*keys, "n_words", "print", "place", F.posexplode("spans").alias("back", "span")).where("span <> 0")
    short = flat.where("size < 0")
    return long.select(
        *keys, "n_words", "print", (F.col("place") - F.col("back")).alias("first"), F.lit(SPAN).alias("size"), "span"
    ).unionByName(
        short.select(*keys, "n_words", "print", F.col("place").alias("first"), (-F.col("size")).alias("size"), F.col("print").alias("span"))
    )


def _covered(pairs: Column) -> Column:
    """Words under the union of (first, end) pairs."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.array_sort(pairs),
        start,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["first"], acc["end"]))).cast("bigint").alias("n"),
            F.greatest(acc["end"], x["end"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, items (distinct ids, sorted as text), unnamed (an item without id hit) and hit spans (first, end) per document.

    ``keep`` columns are carried beside them.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("item_text"))
    sized = written(fingerprints(items, "item", "item_text", tuple(range(1, SPAN)), None), "benchmark-prints")
    # an item of fewer words than a span is its own window; its shorter grams are not
    windows = written(
        _windows(sized, "item").where(f"(n_words >= {SPAN} and size = {SPAN}) or (n_words < {SPAN} and size = n_words)"),
        "benchmark-spans",
    )
    prints = windows.select("print").distinct()
    lengths = tuple(sorted(row[0] for row in windows.where(f"size < {SPAN}").select("size").distinct().collect()))
    rows = documents.select(
        F.monotonically_increasing_id().alias("row_key"), F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("doc_text"), *keep
    )
    scanned = _scan_documents(rows, lengths, bitmap(prints, "print"), keep)
    scanned = written(scanned, "document-prints")
    hits = _windows(scanned.where(F.size("hits") > 0), "row_key").join(prints, "print", "left_semi")
    spans = windows.select("span", "size").distinct()
    matched = written(hits.join(spans, ["span", "size"], "left_semi").select("row_key", "first", "size", "span").distinct(), "matched-spans")
    covered = matched.groupBy("row_key").agg(
        F.array_sort(F.collect_set(F.struct("first", (F.col("first") + F.col("size")).alias("end")))).alias("hit_spans")
    )
    named = (
        matched.select("row_key", "span", "size").distinct()
        .join(windows.select("span", "size", "item").distinct(), ["span", "size"])
        .groupBy("row_key")
        .agg(
            F.array_sort(F.transform(F.collect_set("item"), lambda i: i.cast("string"))).alias("items"),
            F.max(F.col("item").isNull()).alias("unnamed"),
        )
    )
    none = F.array().cast("array<string>")
    return (
        scanned.drop("hits")
        .join(covered, "row_key", "left")
        .join(named, "row_key", "left")
        .select(
            "doc_id", "row_key", "n_words",
            F.coalesce(_covered(F.col("hit_spans")), F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("items", none).alias("items"), F.coalesce("unnamed", F.lit(False)).alias("unnamed"), "hit_spans", *keep,
        )
    )


def _scan_documents(rows: DataFrame, lengths: tuple[int, ...], words: bytes, keep: tuple[str, ...]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(words)
    extra = [f"kept_{i}" for i in range(len(keep))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.int64)
        for batch in batches:
            row = 0
            for counts, hits, n in _texts(batch[2], lengths, lambda p: in_bitmap(bits, p)):
                columns = [batch[0].slice(row, n), batch[1].slice(row, n), pa.array(counts.astype(np.int64)), hits]
                columns += [batch[3 + i].slice(row, n) for i in range(len(extra))]
                yield pa.RecordBatch.from_arrays(columns, names=["row_key", "doc_id", "n_words", "hits", *extra])
                row += n

    kinds = dict(rows.dtypes)
    schema = f"row_key bigint, doc_id {kinds['doc_id']}, n_words bigint, hits {_HITS}"
    schema += "".join(f", {e} {kinds[k]}" for e, k in zip(extra, keep))
    return rows.mapInArrow(scan, schema).withColumnsRenamed(dict(zip(extra, keep)))


_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bi AS (
  SELECT item_id, w, len(w) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id, least(n, 10) AS size, array_to_string(w[i : i + least(n, 10) - 1], ' ') AS g FROM bi
), sizes AS (SELECT DISTINCT size FROM bw), di AS (
  SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size
), m AS (
  SELECT DISTINCT k, i, size, item_id FROM (SELECT k, i, size, array_to_string(w[i : i + size - 1], ' ') AS g FROM di) x JOIN bw USING (size, g)
), h AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + size)) AS p FROM m) GROUP BY k
), t AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (k) LEFT JOIN t USING (k)
"""


@query("op10_decontaminate", _SQL)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        (F.size("items") + F.col("unnamed").cast("int")).cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
