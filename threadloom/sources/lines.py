"""Line dumps: one thread per line, JSON or Python literal syntax."""

from __future__ import annotations

import ast
import json
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from threadloom import schemas
from threadloom.sources import zst

# Fixed value: rows per part file of the split dump.
ROWS_PER_FILE = 1_000_000


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Raw lines of a (possibly compressed) dump, spread over the cluster.

    A compressed frame is read by one task, so rows are redistributed at once,
    into partitions of the advised size unless a number is given.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return lines.repartition(partitions) if partitions else lines.hint("rebalance")


def _with_source(spark: SparkSession) -> None:
    """Registers the source; its code travels by value, as not every runner of a source sees shipped packages."""
    cloudpickle.register_pickle_by_value(zst)
    spark.dataSource.register(zst.ZstLines)


def read_zst_lines(spark: SparkSession, path: str, split_bytes: int = zst.SPLIT_BYTES) -> DataFrame:
    """Raw lines of a .zst dump (a file or a folder), a partition per byte range of frames."""
    _with_source(spark)
    return spark.read.format("zst_lines").option("splitBytes", split_bytes).load(path)


def stream_zst_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of .zst files as they grow and arrive; the position is the bytes of whole frames read."""
    _with_source(spark)
    return spark.readStream.format("zst_lines").load(path)


def write_zst_lines(lines: DataFrame, path: str, frame_bytes: int = zst.FRAME_TEXT) -> None:
    """The one string column as .zst part files of many frames, so that they can be split again."""
    _with_source(lines.sparkSession)
    text = lines.select(F.col(lines.columns[0]).alias("line"))
    text.write.format("zst_lines").mode("overwrite").option("frameBytes", frame_bytes).save(path)


def _to_json(line: str) -> str | None:
    try:
        value = ast.literal_eval(line.strip())
        return json.dumps(value, ensure_ascii=False) if isinstance(value, dict) else None
    except (ValueError, TypeError, SyntaxError, MemoryError, RecursionError):
        return None


#: text up to a word outside quotes: no quote, or a whole quoted string
_BEFORE = r"""\G((?:[^'"{first}]++|'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|{first}(?!{rest}\b))*+){first}{rest}\b"""
#: Python's words for JSON's
_WORDS = {"None": "null", "True": "true", "False": "false"}
#: escapes that mean the same in both notations
_SAME_ESCAPES = r"""(?s)(?:[^\\]++|\\[\\'"nrtbf])*+"""


def as_json(line: Column) -> Column:
    """A Python literal in JSON's words; NULL where its escapes would read otherwise."""
    text = line
    for word, meant in _WORDS.items():
        text = F.regexp_replace(text, _BEFORE.format(first=word[0], rest=word[1:]), "$1" + meant)
    return F.when(F.regexp(line, F.lit("^" + _SAME_ESCAPES + "$")), text)


def parse_lines(lines: DataFrame, schema: T.StructType = schemas.THREAD) -> DataFrame:
    """line -> (line, record, rejected).

    Lines that are not JSON are Python literals as a rule: their three words are
    translated outside quotes, in the JVM, and parsed again. What is left (other
    escapes, tuples, other numbers) is tried as a literal in Python, which never
    runs code. What is neither, or does not fit the schema's types, is rejected.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    fits = lambda name: F.col(name).isNotNull() & F.col(f"{name}._bad").isNull()
    parsed = _once(lines, "_j", F.from_json("line", with_corrupt, options))
    # single quotes are read by the parser; an escaped one is not without the option
    again = F.from_json(as_json(F.col("line")), with_corrupt, {**options, "allowBackslashEscapingAnyCharacter": "true"})
    parsed = _once(parsed, "_p", F.when(fits("_j"), F.col("_j")).otherwise(again)).drop("_j")
    plain = fits("_p")

    @F.pandas_udf("string")
    def literal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: None if x is None else _to_json(x))

    # good lines pass NULL to Python, so only the others are parsed there
    rest = parsed.withColumn("_t", literal(F.when(~plain, F.col("line"))))
    # a field of another type than the schema's rejects the line here too
    rest = _once(rest, "_r", F.from_json("_t", with_corrupt, options))
    fields = lambda of: F.struct(*[F.col(f"{of}.{name}").alias(name) for name in schema.fieldNames()])
    literal_fits = F.col("_t").isNotNull() & F.col("_r").isNotNull() & F.col("_r._bad").isNull()
    rejected = ~plain & ~literal_fits
    return rest.select(
        "line",
        F.when(plain, fields("_p")).when(literal_fits, fields("_r")).alias("record"),
        rejected.alias("rejected"),
    )


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Append a costly column through a generator.

    Later filters are not pushed below it, so the value is computed once per
    row and not again inside every condition that reads it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def threads(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("rejected")).select("record.*")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter("rejected").select("line")


def write_parts(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    df.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path)
