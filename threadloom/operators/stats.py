"""Statistics: frequencies, summaries, histograms, audit counts, metric means."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.operators.ordering import bucket_of, numeric_bounds, running_total
from threadloom.session import scratch_path

QUARTILES = (0.25, 0.5, 0.75)


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def normalised_frequency(df: DataFrame, column: str) -> DataFrame:
    """Share of each value; the total comes from the small count table."""
    counts = frequency(df, column)
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def audit(df: DataFrame, **stages: Column) -> DataFrame:
    """Rows before and after each filter, and dropped, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in stages.items()],
    )
    entries = [
        F.struct(
            F.lit(name).alias("stage"),
            F.col("_all").alias("before"),
            F.col(name).alias("after"),
            (F.col("_all") - F.col(name)).alias("dropped"),
        )
        for name in stages
    ]
    return counted.select(F.inline(F.array(*entries)))


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Values that are not NULL and how often each occurs, written once: (by, v, n).

    Copies collapse before the shuffle, so a frequent value costs no more than
    another, and what reads the table several times evaluates its input once.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    path = scratch_path(df.sparkSession, "value-counts")
    counts.write.parquet(path)
    return df.sparkSession.read.schema(counts.schema).parquet(path)


def quantiles(
    df: DataFrame, value: str, fractions: Sequence[float] = QUARTILES, by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per fraction."""
    return quantiles_of_counts(value_counts(df, value, by), fractions, by)


def quantiles_of_counts(
    counts: DataFrame, fractions: Sequence[float] = QUARTILES, by: Sequence[str] = ()
) -> DataFrame:
    """The same from ``value_counts``; cumulative counts are taken over ordered buckets, not in one task."""
    upto = running_total(counts, "v", F.col("n"), partition=by, out="upto")
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("total"))
    if by:
        placed = upto.join(sizes, list(by))
    else:
        placed = upto.withColumn("total", sizes.select("total").scalar())
    picks = []
    for i, fraction in enumerate(fractions):
        rank = (F.col("total") - 1) * F.lit(float(fraction))
        low, high = F.floor(rank), F.ceil(rank)
        before = F.col("upto") - F.col("n")
        held = lambda r: F.max(F.when((before <= r) & (r < F.col("upto")), F.col("v")))
        picks += [
            held(low).alias(f"low{i}"),
            held(high).alias(f"high{i}"),
            F.max(rank - low).alias(f"part{i}"),
        ]
    found = placed.groupBy(*by).agg(*picks)
    return found.select(
        *by,
        *[
            (F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * F.col(f"part{i}")).alias(
                f"q{int(fraction * 100)}"
            )
            for i, fraction in enumerate(fractions)
        ],
    )


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum, all from one table of value counts.

    Groups without a value that is not NULL have a count of 0.
    """
    counts = value_counts(df, value, by)
    total = counts.groupBy(*by).agg(
        F.sum("n").alias("count"), (F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    # deviations from the mean, so a large common offset costs no digits
    if by:
        centred = counts.join(total.select(*by, "mean"), list(by))
    else:
        centred = counts.withColumn("mean", total.select("mean").scalar())
    spread = centred.groupBy(*by).agg(F.sum(F.col("n") * (F.col("v") - F.col("mean")) ** 2).alias("_m2"))
    parts = quantiles_of_counts(counts, by=by)
    if by:
        found = df.select(*by).distinct().join(total, list(by), "left").join(spread, list(by), "left").join(parts, list(by), "left")
    else:
        held = lambda rows: rows.select(F.struct(*rows.columns)).scalar()
        found = total.withColumns({"_s": held(spread), "_q": held(parts)}).select("*", "_s.*", "_q.*")
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("_m2") / (F.col("count") - 1))).alias("std")
    names = [f"q{int(f * 100)}" for f in QUARTILES]
    return found.select(*by, F.coalesce("count", F.lit(0)).alias("count"), "mean", deviation, "min", "max", *names)


# Sketch size; its rank error at 99 % confidence is ``rank_error`` of it.
SKETCH_K = 4096


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised rank error of a KLL sketch of size ``k``, as published for it."""
    return 2.296 / k**0.9723


def sketch(df: DataFrame, value: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Mergeable summary of a column in one pass: n, mean, m2, min, max and a KLL sketch of bounded size.

    To be stored per part of a growing table and merged; nothing is sorted and
    only one row per task and group is shuffled.
    """
    v = F.col(value).cast("double")
    return df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"),
    )


def merge_sketches(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One summary per group from those of its parts."""
    parts = parts.filter(F.col("n") > 0)
    total = parts.groupBy(*by).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    placed = parts.join(total, list(by)) if by else parts.withColumn("_mean", total.select("_mean").scalar())
    return placed.groupBy(*by).agg(
        F.sum("n").alias("n"), F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def describe_sketch(sketches: DataFrame, by: Sequence[str] = (), fractions: Sequence[float] = QUARTILES) -> DataFrame:
    """``describe`` from summaries; quantiles are stored values within ``rank_error`` of their rank."""
    picks = [F.kll_sketch_get_quantile_double("sketch", F.lit(f)).alias(f"q{int(f * 100)}") for f in fractions]
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std")
    return sketches.select(*by, F.col("n").alias("count"), "mean", deviation, "min", "max", *picks)


def histogram(df: DataFrame, value: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum falls into the last bin.

    Empty bins are returned with 0. A constant column gets the range value
    -0.5 .. +0.5, as plotting libraries do.
    """
    v = F.col(value).cast("double")
    edges = df.groupBy(*by).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edges = edges.filter(F.col("lo").isNotNull()).select(
        *by,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    # distinct values collapse before they meet their edges
    counts = df.filter(v.isNotNull()).groupBy(*by, v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    if by:
        placed = counts.join(edges, list(by))
    else:
        placed = counts.withColumns(
            {"lo": edges.select("lo").scalar(), "hi": edges.select("hi").scalar()}
        )
    bin_no = F.least(F.width_bucket("v", "lo", "hi", F.lit(bins)), F.lit(bins)).cast("bigint")
    filled = placed.groupBy(*by, bin_no.alias("bin")).agg(F.sum("n").alias("n"))
    grid = edges.select(
        *by,
        "lo",
        ((F.col("hi") - F.col("lo")) / bins).alias("width"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))).alias("bin"),
    )
    return grid.join(filled, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count(F.col(c)).alias(c) for c in columns])


def metric_means(metrics: DataFrame) -> DataFrame:
    """Mean of each logged (split, key)."""
    return metrics.groupBy("split", "key").agg(F.avg("value").alias("mean_value"))


def running_mean(batches: DataFrame, step: str) -> DataFrame:
    """Row-weighted mean of all batches up to each step.

    ``batches`` has one row per step with ``n`` and ``mean``.
    """
    weighted = running_total(batches, step, F.col("n") * F.col("mean"), out="_sum")
    counted = running_total(weighted, step, F.col("n"), out="_n")
    return counted.withColumn("running_mean", F.col("_sum") / F.col("_n")).drop("_sum", "_n")


def _merged(n: float, mean: float, m2: float, n_b: float, mean_b: float, m2_b: float) -> tuple[float, float, float]:
    """Moments of two sets together (pairwise update, no sums of squares)."""
    if not n_b:
        return n, mean, m2
    total = n + n_b
    apart = mean_b - mean
    return total, mean + apart * n_b / total, m2 + m2_b + apart * apart * n * n_b / total


def running_moments(batches: DataFrame, step: str) -> DataFrame:
    """n, mean and sample variance of everything up to each step, by merging moments.

    ``batches`` has one row per step with ``n``, ``mean`` and ``m2`` (sum of
    squared deviations from the mean). Steps are cut into ordered buckets; each
    bucket's moments are merged, the moments before a bucket follow from those
    (a row per bucket), and every bucket is scanned on from there.
    """
    spark = batches.sparkSession
    bucket = bucket_of(F.col(step), numeric_bounds(batches, step))
    rows = batches.select(F.col(step).cast("double").alias("step"), F.col("n").cast("double"), "mean", "m2", bucket.alias("bucket"))

    def scan(part: pd.DataFrame, state: tuple[float, float, float]) -> list[tuple[float, float, float]]:
        found = []
        for n, mean, m2 in part.sort_values("step")[["n", "mean", "m2"]].itertuples(index=False):
            state = _merged(*state, n, mean, m2)
            found.append(state)
        return found

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(part["bucket"].iloc[0], *scan(part, (0.0, 0.0, 0.0))[-1])], columns=["bucket", "n", "mean", "m2"])

    # a row for each million steps
    totals = rows.groupBy("bucket").applyInPandas(whole, "bucket int, n double, mean double, m2 double").toPandas().sort_values("bucket")
    state, before = (0.0, 0.0, 0.0), []
    for number, n, mean, m2 in totals.itertuples(index=False):
        before.append((int(number), *map(float, state)))
        state = _merged(*state, n, mean, m2)
    entries = spark.createDataFrame(before, "bucket int, n0 double, mean0 double, m0 double")

    def onward(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("step")
        first = part.iloc[0]
        found = scan(part, (first["n0"], first["mean0"], first["m0"]))
        return pd.DataFrame([(s, *x) for s, x in zip(part["step"], found)], columns=["step", "n", "mean", "m2"])

    moments = rows.join(entries, "bucket").groupBy("bucket").applyInPandas(onward, "step double, n double, mean double, m2 double")
    kind = batches.schema[step].dataType
    variance = F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1)).alias("running_var")
    return moments.select(F.col("step").cast(kind).alias(step), F.col("n").cast("bigint").alias("n"), F.col("mean").alias("running_mean"), variance)


def accuracy(df: DataFrame, predicted: str, label: str) -> DataFrame:
    return df.agg(F.avg((F.col(predicted) == F.col(label)).cast("double")).alias("accuracy"))


def scored_length(df: DataFrame, by: Sequence[str], text: str) -> DataFrame:
    """Characters of the retrieved texts per group."""
    return df.groupBy(*by).agg(F.sum(F.length(text)).alias("total_chars"))
