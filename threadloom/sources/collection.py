"""Collection with last-write-wins upserts: a table partitioned by writer and batch.

A batch is one partition (writer, batch) of its own rows, written with dynamic
partition overwrite: nothing else is read or changed, and a replayed batch
replaces itself. Rows carry the time their batch was first written; a read keeps
the newest row of a key with one aggregate. Writers are ordered by their
drivers' clocks.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.sources.tables import path_exists, write_partitions

STAMP, WRITER, BATCH = "_written", "_writer", "_batch"


class Collection:
    def __init__(self, spark: SparkSession, path: str, key: str = "id"):
        self.spark, self.path, self.key = spark, path, key

    def _stored(self) -> DataFrame | None:
        if not path_exists(self.spark, self.path):
            return None
        return self.spark.read.parquet(self.path)

    def _stamp(self, source: str, batch: int) -> int:
        """When the batch was first written, now if it was not."""
        stored = self._stored()
        if stored is not None:
            # partition columns prune the scan to the batch's own files
            known = stored.where((F.col(WRITER) == f"w-{source}") & (F.col(BATCH) == batch)).select(STAMP).take(1)
            if known:
                return known[0][0]
        return time.time_ns()

    def upsert(self, rows: DataFrame, order: str, source: str | None = None, batch: int = 0) -> None:
        """Merge rows by key; the last write wins.

        Inside the batch the row with the largest ``order`` counts, NULL being
        the smallest; equal ones are told apart by a hash of the row. An order
        column other than the key is not stored. ``source`` and ``batch`` name a
        micro-batch: written again, it replaces itself and stays where it was in
        the order of writes.
        """
        source = source or uuid.uuid4().hex
        others = [c for c in rows.columns if c not in (order, self.key)]
        newest = F.struct(F.col(order).isNotNull(), F.col(order), F.xxhash64(*rows.columns))
        # max_by combines before the shuffle: a key with very many rows stays cheap
        fresh = rows.groupBy(self.key).agg(F.max_by(F.struct(*others), newest).alias("_row")).select(self.key, "_row.*")
        named = fresh.withColumns(
            {STAMP: F.lit(self._stamp(source, batch)), WRITER: F.lit(f"w-{source}"), BATCH: F.lit(batch).cast("bigint")}
        )
        write_partitions(named, self.path, WRITER, BATCH)

    def read(self) -> DataFrame:
        """The newest row of every key, whole, NULL fields included."""
        stored = self._stored()
        if stored is None:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        others = [c for c in stored.columns if c not in (self.key, STAMP, WRITER, BATCH)]
        newest = F.max_by(F.struct(*others), F.struct(STAMP, WRITER, BATCH))
        return stored.groupBy(self.key).agg(newest.alias("_row")).select(self.key, "_row.*")
