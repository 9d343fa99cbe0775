"""Global order without a single-task sort: ranks, running totals, splits, samples.

A global ``row_number`` or running sum over one window pulls every row into
one task. Here rows are first cut into ordered buckets, bucket totals (a small
table) are accumulated, and each bucket is then numbered on its own.

Buckets follow measured counts: the key range is split into equal cells, cells
that hold too many rows are split again, and neighbours are joined up to the
wanted size. There are at least as many buckets as shuffle partitions and as
many more as their size asks for.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

# Most rows one bucket should hold; a bucket is sorted by one task.
ROWS_PER_BUCKET = 1_000_000
# Parts of a cell that is split.
CELLS = 256
# Cut points that are compared in an expression; more are looked up in Arrow batches.
COMPARED_CUTS = 32
# Leading digits of a hex key that place it; they are exact in a double.
HEX_DIGITS = 13


def sample_key(id_col: Column, seed: int = 42) -> Column:
    """Reproducible uniform order key for an id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string")))


def _wanted_rows(df: DataFrame, rows: int, buckets: int | None) -> int:
    """Rows of a bucket."""
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return max(1, min(ROWS_PER_BUCKET, -(-rows // buckets)))
    return max(1, -(-rows // buckets))


def numeric_bounds(df: DataFrame, key: str, buckets: int | None = None) -> list[float]:
    """Ordered cut points of ``key``: a bucket holds the values up to its cut, and no more rows than wanted.

    Only one value that is repeated more often, being one place in the order,
    makes a larger bucket. Every level of splitting is one aggregate with a row
    per cell that has values.
    """
    value = F.col(key).cast("double")
    finite = df.select(F.when(F.abs(value) <= 1.7e308, value).alias("v")).filter(F.col("v").isNotNull())
    low, high, rows = finite.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not rows or low == high:
        return []
    wanted = _wanted_rows(df, rows, buckets)

    def measured(cell: Column) -> pd.DataFrame:
        found = finite.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        return found.toPandas().sort_values("low")

    cells = measured(F.floor((F.col("v") - low) / (high / 2 - low / 2) * (CELLS / 2)))
    while True:
        cuts = cells["high"].to_numpy()
        dense = cells[(cells["n"] > wanted) & (cells["low"] < cells["high"])]
        if dense.empty:
            break
        # the lowest value of a dense cell is cut off too, in case it is what makes it dense
        inner = [np.r_[a, np.linspace(a, b, CELLS + 1)[1:-1]] for a, b in zip(dense["low"], dense["high"])]
        finer = np.unique(np.concatenate([cuts, *inner]))
        if len(finer) == len(cuts):
            break
        cells = measured(bucket_of(F.col("v"), finer[:-1].tolist()))
    held, out = 0, []
    for n, top in zip(cells["n"], cells["high"]):
        if held and held + n > wanted:
            out.append(last)
            held = 0
        held, last = held + n, float(top)
    return out


def bucket_of(key: Column, bounds: Sequence[float]) -> Column:
    """Bucket number of a numeric key; buckets are ordered like the key."""
    value = key.cast("double")
    if len(bounds) <= COMPARED_CUTS:
        number = F.lit(0)
        for cut in bounds:
            number = number + (value > F.lit(float(cut))).cast("int")
        return number
    cuts = np.asarray(bounds)

    @F.pandas_udf("int")
    def locate(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, values.to_numpy(dtype=float), side="left"))

    return locate(value)


def hashed_bucket(df: DataFrame, key: str, buckets: int | None = None) -> Column:
    """Bucket number of a hex digest, whose values are spread evenly."""
    rows = df.count()
    number = -(-rows // _wanted_rows(df, rows, buckets)) if rows else 1
    place = F.conv(F.substring(F.col(key), 1, HEX_DIGITS), 16, 10).cast("double") / float(16**HEX_DIGITS)
    return F.floor(place * number).cast("int")


def running_total(
    df: DataFrame,
    key: str,
    weight: Column | None = None,
    partition: Sequence[str] = (),
    out: str = "running_total",
    hashed_key: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Inclusive running sum of ``weight`` (1 by default) in ``key`` order.

    ``key`` must be unique within a partition. ``hashed_key`` marks a hex digest.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    upto = [Window.unboundedPreceding, Window.currentRow]
    bucket = hashed_bucket(df, key, buckets) if hashed_key else bucket_of(F.col(key), numeric_bounds(df, key, buckets))
    work = df.withColumn("_w", weight).withColumn("_b", bucket)
    totals = work.groupBy(*partition, "_b").agg(F.sum("_w").alias("_t"))
    before = (
        Window.partitionBy(*partition)
        .orderBy("_b")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *partition, "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*partition, "_b").orderBy(key).rowsBetween(*upto)
    return (
        work.join(offsets, [*partition, "_b"])
        .withColumn(out, F.col("_offset") + F.sum("_w").over(inside))
        .drop("_w", "_b", "_offset")
    )


def global_row_number(
    df: DataFrame, key: str, partition: Sequence[str] = (), out: str = "rn", **kwargs
) -> DataFrame:
    """Consecutive numbers from 1 in ``key`` order."""
    return running_total(df, key, partition=partition, out=out, **kwargs)


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def percent_floor(n: Column, percent: int) -> Column:
    """int(n / 100 * percent) with the same operation order, in double."""
    return F.floor(n.cast("double") / F.lit(100.0) * F.lit(float(percent)))


def random_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Uniform reproducible sample of ``n`` rows without replacement."""
    return (
        df.withColumn("_k", sample_key(F.col(id_col), seed)).orderBy("_k", id_col).limit(n).drop("_k")
    )


def seeded_shuffle(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """All rows in a reproducible random order."""
    return df.withColumn("_k", sample_key(F.col(id_col), seed)).orderBy("_k", id_col).drop("_k")


def shuffled_position(df: DataFrame, id_col: str, seed: int = 42, out: str = "rn") -> DataFrame:
    """Position of each row in the shuffled order, without sorting globally."""
    keyed = df.withColumn("_k", sample_key(F.col(id_col), seed))
    return global_row_number(keyed, "_k", out=out, hashed_key=True).drop("_k")


def split_tail_valid(df: DataFrame, id_col: str, percent: int = 20, seed: int = 42) -> DataFrame:
    """Sampled order; the last int(n/100*percent) rows are 'valid', the rest 'train'."""
    n = row_count(df)
    numbered = shuffled_position(df, id_col, seed)
    return numbered.withColumn(
        "cat", F.when(F.col("rn") > n - percent_floor(n, percent), "valid").otherwise("train")
    )


def split_head_valid(
    df: DataFrame,
    id_col: str,
    percent: int | None = 15,
    seed: int = 0,
    n_valid: int | None = None,
) -> DataFrame:
    """Shuffled order; the first int(n/100*percent), or ``n_valid``, rows are 'valid'."""
    size = F.lit(n_valid) if n_valid is not None else percent_floor(row_count(df), percent)
    numbered = shuffled_position(df, id_col, seed)
    return numbered.withColumn(
        "split", F.when(F.col("rn") <= size, "valid").otherwise("train")
    )


def sample_with_replacement(df: DataFrame, id_col: str, cap: int, seed: int = 42) -> DataFrame:
    """min(cap, rows) draws with replacement; a row drawn twice appears twice.

    Draw numbers are hashed to row positions, so the result has the exact size.
    """
    rows = df.count()
    draws = min(cap, rows)
    spark = df.sparkSession
    drawn = spark.range(draws).select(
        F.col("id").alias("draw"),
        (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 15), 16, 10).cast("bigint") % max(rows, 1) + 1).alias("rn"),
    )
    return drawn.join(global_row_number(df, id_col), "rn").drop("rn")


def mismatched_pairs(
    df: DataFrame, key: str, completion: str, batch_size: int, out: str
) -> DataFrame:
    """Give each row of a consecutive batch its predecessor's completion.

    The first row of a batch takes the last one's. Batches hold ``batch_size``
    rows, so no window grows with the data.
    """
    if batch_size <= 1:
        raise ValueError("batch size must be greater than 1: a row cannot be mismatched with itself")
    numbered = global_row_number(df, key, out="_rn")
    numbered = numbered.withColumn(
        "_batch", F.floor((F.col("_rn") - 1) / F.lit(batch_size)).cast("bigint")
    )
    in_batch = Window.partitionBy("_batch")
    ordered = in_batch.orderBy("_rn")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    previous = F.lag(completion).over(ordered)
    first = F.row_number().over(ordered) == 1
    return numbered.withColumn(
        out, F.when(first, F.last(completion).over(whole)).otherwise(previous)
    ).drop("_rn", "_batch")
