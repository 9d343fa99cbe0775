"""Collections, result tables and text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from threadloom import schemas
from threadloom.functions import text as tx
from threadloom.operators.postings import build_index


def read_parts(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet parts of a folder as one table."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """A table for row work that costs more than moving the rows.

    Rows are dealt evenly over partitions of the advised size, whatever the
    splits of the files are.
    """
    return spark.read.parquet(path).hint("rebalance")


def write_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace just the partitions that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def check_vectors(points: DataFrame, dim: int) -> DataFrame:
    """Fail the job when a vector does not have the declared dimension."""
    wrong = F.col("dense").isNull() | (F.size("dense") != dim)
    checked = F.when(wrong, F.raise_error(F.lit(f"vector dimension is not {dim}"))).otherwise(F.col("dense"))
    return points.withColumn("dense", checked)


def replace_collection(points: DataFrame, path: str, dim: int) -> None:
    """Drop and rewrite a collection: the points and the inverted lists of their sparse vectors."""
    spark = points.sparkSession
    write_table(check_vectors(points, dim), f"{path}/points")
    build_index(spark.read.parquet(f"{path}/points"), f"{path}/postings")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', lineSep="\n", emptyValue='""', nullValue="\\N"
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(
        path, header=True, quote='"', escape='"', multiLine=True, nullValue="\\N"
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def sampled_ids(spark: SparkSession, path: str, wanted: int, make) -> DataFrame:
    """Stored id list when it has the wanted number of rows, otherwise a new one."""
    if path_exists(spark, path):
        stored = read_csv(spark, path, schemas.SAMPLED_IDS)
        if stored.count() == wanted:
            return stored
    write_csv(make(), path)
    return read_csv(spark, path, schemas.SAMPLED_IDS)


def save_splits(df: DataFrame, path: str) -> None:
    """Train and valid rows as one table partitioned by split."""
    write_table(df, path, partition_by="split")


def append_generations(df: DataFrame, path: str, step: int) -> None:
    """Generations of one evaluation step; a step that runs again replaces its own rows."""
    write_partitions(df.withColumn("step", F.lit(step)), path, "step")


def save_model_answers(df: DataFrame, path: str, model: str = "model") -> None:
    """CSV of model answers, one folder per model name made safe for paths."""
    safe = df.withColumn(model, tx.file_safe(F.col(model)))
    safe.write.mode("overwrite").partitionBy(model).csv(
        path, header=True, quote='"', escape='"', lineSep="\n", emptyValue='""', nullValue="\\N"
    )


def point_dump(points: DataFrame) -> DataFrame:
    """Readable block per point; ``doc_no`` counts from 0."""
    block = F.concat(
        F.lit("\nDOC "),
        F.col("doc_no").cast("string"),
        F.lit("\n\nRATING\n"),
        F.col("rating").cast("string"),
        F.lit("\n\nQUESTION\n"),
        F.col("question"),
        F.lit("\n\nANSWER\n"),
        F.col("answer"),
        F.lit("\n\nID\n"),
        F.col("id").cast("string"),
        F.lit("\n\n\n" + " " * 12),
    )
    return points.select("doc_no", block.alias("value"))


def write_text(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("overwrite").text(path)
