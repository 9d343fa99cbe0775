"""Catalog of the operators' queries, and tables cut from their lineage."""

from __future__ import annotations

import gc
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        CATALOG[name] = Entry(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, no lineage above it."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of jobs that are over.

    They go when the driver's JVM collects the plans that made them, which may
    take longer than a disk lasts; nothing that is still held is touched.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_row_key(frame: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and a ``row_key`` unique to each row; write it before it is used twice."""
    return frame.select(*columns, F.monotonically_increasing_id().alias("row_key"))


BITMAP_BITS = 1 << 26


def bitmap(keys: DataFrame, column: str) -> bytes:
    """Filter over 64-bit keys: bit ``key >> 38`` is set for every key.

    Its size is fixed (8 MB) whatever the number of keys: the keys are folded
    into at most 2^20 words by an aggregate before they reach the driver. It
    only spares work, an exact join follows wherever it is used.
    """
    import numpy as np

    slot = F.shiftrightunsigned(F.col(column), 38)
    folded = (
        keys.select(F.shiftrightunsigned(slot, 6).alias("word"), (slot.bitwiseAND(F.lit(63))).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    words[folded["word"].to_numpy()] = folded["bits"].to_numpy()
    return words.tobytes()


def in_bitmap(words, keys):
    """Which of the unsigned 64-bit ``keys`` have their bit set in ``words`` (int64 view)."""
    import numpy as np

    slot = keys >> np.uint64(38)
    return (words[(slot >> np.uint64(6)).astype(np.int64)].view(np.uint64) >> (slot & np.uint64(63))) & np.uint64(1) != 0
