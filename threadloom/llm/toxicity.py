"""Toxicity from character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the hashed character n-grams (3 to 5) that it contains.
Each is scaled by r = log of the smoothed share of toxic texts with it over that
of other texts; a logistic regression on the scaled features gives the weights.
Ratios and weights are learned from at most about ``TRAIN_ROWS`` labelled
documents, chosen by a hash of their id, and kept for every n-gram that at least
``MIN_TEXTS`` of these texts hold and whose shares differ clearly (by the z score,
``MIN_Z`` or more); the ``1 << BITS`` buckets bound the model. Rarer n-grams only
add noise: without ``MIN_TEXTS`` held-out AUC and accuracy fall (README). Every document is scored over its whole text in one pass
without a shuffle.

Labels: a document is toxic if any of its labels says 1; null labels and null
ids are ignored. Scores are from the text alone.
Defined results: null and empty texts have no n-grams and get the score of the
intercept. Repeated rows get equal scores. Without labelled rows of both kinds
the score is the toxic share of the labels (0 without any). An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.llm import words as W
from threadloom.llm.base import query, table, written

GRAMS = (3, 4, 5)
BITS = 20
TRAIN_ROWS = 20_000
MIN_TEXTS, MIN_Z = 5, 3.0
SLICE_BYTES = 1 << 19  # hashes of a slice take some two hundred bytes a character
_U = np.uint64


def _grams(column: pa.Array) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(row, rows, [(text numbers, buckets) for each n]) of runs of texts, ASCII letters lowered."""
    for row, data, offsets in W.slices(column, SLICE_BYTES):
        low = W.lower_ascii(data)
        characters = np.frombuffer(low.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4")
        begins = (low & 0xC0) != 0x80
        bounds = np.concatenate([[0], np.cumsum(begins)])[offsets]
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        codes = W.mix(characters.astype(np.uint64) + _U(1))
        found = []
        for n in GRAMS:
            hashes, whole = W.gram_hashes(codes, owner, n)
            found.append((owner[: len(hashes)], hashes >> _U(64 - BITS), whole))
        yield row, len(offsets) - 1, [(own[whole], bucket[whole].astype(np.int64)) for own, bucket, whole in found]


def _present(rows: int, grams, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, of the wanted buckets only."""
    keys = []
    for own, bucket in grams:
        if wanted is not None:
            kept = wanted[bucket]
            own, bucket = own[kept], bucket[kept]
        keys.append((own << BITS) | bucket)
    key = np.unique(np.concatenate(keys))
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def _constant(share: float) -> Model:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return Model(np.zeros(0, dtype=np.int64), np.zeros(0), float(np.log(share / (1 - share))))


def label_table(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """One label for each labelled id."""
    return (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    )


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """``labelled``: doc_id, text, label (0 or 1)."""
    spark = labelled.sparkSession
    size = labelled.count()
    if not size:
        return _constant(0.0)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, train_rows / size))
    sample = written(labelled.where(part).select("label", F.col("text").cast("string").alias("text")), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            label = batch[0].to_numpy()
            for row, rows, grams in _grams(batch[1]):
                own, bucket = _present(rows, grams)
                for k in (0, 1):
                    totals[k] += np.bincount(bucket[label[row + own] == k], minlength=1 << BITS)
        seen = np.flatnonzero(totals.any(axis=0))
        for low in range(0, len(seen), 1 << 16):
            part = seen[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(totals[0][part]), pa.array(totals[1][part])], names=["bucket", "clean", "toxic"])

    kinds = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    clean, toxic = kinds.get(0, 0), kinds.get(1, 0)
    if not clean or not toxic:
        return _constant(toxic / max(1, clean + toxic))
    pooled = (F.col("toxic") + F.col("clean")) / (clean + toxic)
    z = (F.col("toxic") / toxic - F.col("clean") / clean) / F.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / clean) + 1e-12)
    ratio = F.log((F.col("toxic") + 1) / (toxic + 2)) - F.log((F.col("clean") + 1) / (clean + 2))
    chosen = (
        sample.mapInArrow(count, "bucket bigint, clean bigint, toxic bigint")
        .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= MIN_TEXTS)
        .select("bucket", ratio.alias("ratio"), F.abs(z).alias("z"))
        .where(F.col("z") >= MIN_Z)
        .toPandas().sort_values("bucket")  # at most 1 << BITS
    )
    buckets, ratios = chosen["bucket"].to_numpy(np.int64), chosen["ratio"].to_numpy()
    if not len(buckets):
        return _constant(toxic / (clean + toxic))
    shared = spark.sparkContext.broadcast(buckets)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        wanted = np.zeros(1 << BITS, dtype=bool)
        wanted[known] = True
        for batch in batches:
            for row, rows, grams in _grams(batch[1]):
                own, bucket = _present(rows, grams, wanted)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=rows))]).astype(np.int32)
                places = pa.array(bucket).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch[0].slice(row, rows).cast(pa.float64()), pa.ListArray.from_arrays(pa.array(bounds), places)], names=["label", "places"]
                )

    rows = written(sample.mapInArrow(features, "label double, places array<string>"), "features")
    vocabulary = CountVectorizerModel.from_vocabulary([str(b) for b in buckets], "places", "present")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="present", outputCol="features")
    scaled = scale.transform(vocabulary.setBinary(True).transform(rows)).select("label", "features")
    # without standardisation: the ratios are the scale of the features
    model = LogisticRegression(maxIter=60, regParam=1e-4, standardization=False, tol=1e-5).fit(scaled)
    return Model(buckets, model.coefficients.toArray() * ratios, float(model.intercept))


def score(documents: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), output: str = "score") -> DataFrame:
    """The ``keep`` columns of every row and its score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = [f"kept_{i}" for i in range(len(keep))]
    kinds = dict(documents.dtypes)
    # a kept text is not sent twice
    moved = [name for name, k in zip(names, keep) if k != text or kinds[k] != "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        weights = np.zeros(1 << BITS)
        weights[known.buckets] = known.weights
        wanted = weights != 0
        for batch in batches:
            for row, rows, grams in _grams(batch[0]):
                own, bucket = _present(rows, grams, wanted)
                total = known.intercept + np.bincount(own, weights=weights[bucket], minlength=rows)
                kept = [batch[1 + moved.index(n) if n in moved else 0].slice(row, rows) for n in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], names=[*names, "score"])

    schema = ", ".join([*[f"{n} {kinds[k]}" for n, k in zip(names, keep)], "score double"])
    rows = documents.select(F.col(text).cast("string").alias("text"), *[F.col(f"`{k}`").alias(n) for n, k in zip(names, keep) if n in moved])
    return rows.mapInArrow(run, schema).select(*[F.col(n).alias(k) for n, k in zip(names, keep)], F.col("score").alias(output))


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    known = label_table(labels).where(~held_out(F.col("doc_id")))
    return fit(documents.select("doc_id", "text").join(known, "doc_id"), train_rows)


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit_on(documents, table(spark, sf_dir, "labels"))
    return score(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
