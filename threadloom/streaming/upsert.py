"""Incremental load: upsert part files as they arrive."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threadloom.sources.collection import Collection


def stream_parts(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 16
) -> DataFrame:
    """Part files of a folder as they arrive.

    A table that may be one file is given as a glob such as ``{name}``: Spark wants any other path to be a folder.
    """
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def upsert_stream(
    rows: DataFrame,
    collection: Collection,
    checkpoint: str,
    order: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Upsert every micro-batch under the stream's own id and batch number.

    The id is that of the checkpoint, so a replay after a failure replaces what it
    wrote, while a fresh checkpoint or a second stream writes its own batches.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        collection.upsert(prepare(batch), order, source=stream, batch=number)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
