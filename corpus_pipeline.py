"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), decides over every row it is given and
returns the rows that stay, with the columns of ``docs``; the last returns the
pieces and their places. ``run`` writes each stage's rows as Parquet in the
shared folder and reads them again.

Defined results: a document with a null or empty text is scored like an empty
one, has no line, near duplicate or benchmark word to lose, and is packed as its
end token. Null ids are ids like any other and come last where the smallest
counts; repeated rows are documents of their own to every stage but near
duplicates, where one of them stays. Empty tables give empty results; without
labels nothing is toxic, without a benchmark nothing is contaminated. Texts of
any length are used whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm import decontaminate, lines, packing, similar, toxicity
from threadloom.llm.base import table, tidy, written
from threadloom.session import bound_batches


def _without(docs: DataFrame, row_hashes: DataFrame, how: str = "left_anti") -> DataFrame:
    """Rows whose (doc_id, text) hash is not listed; a small list is broadcast by its size on disk."""
    listed = row_hashes.select(F.col("row_hash").alias("__listed_row_hash"))
    return docs.join(listed, F.xxhash64(docs["doc_id"], docs["text"]) == F.col("__listed_row_hash"), how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=tuple(docs.columns), output="__toxic_score")
    return scored.where(F.col("__toxic_score") < 0.5).drop("__toxic_score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words or more are cut out; documents that lose every word with them go."""
    tidy(spark)
    done = lines.dedup_lines(docs, output=("__kept_text", "__n_deleted", "__runs"))
    done = done.where((F.col("__n_deleted") == 0) | F.col("__kept_text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("__kept_text")}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed["n_chars"] = F.when(F.col("__n_deleted") > 0, F.length("__kept_text").cast(kind)).otherwise(F.col("n_chars"))
    return done.withColumns(changed).select(*[f"`{name}`" for name in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays (ids before null, ties by text hash)."""
    tidy(spark)
    found = written(similar.similar_documents(docs).where("component is not null").select("doc_id", "row_hash", "component"), "groups")
    first = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")).alias("first"), F.count("*").alias("rows")
    ).where("rows > 1")
    grouped = found.join(first, "component")
    dropped = written(grouped.where("row_hash <> first.row_hash").select("row_hash").distinct(), "dropped")
    # the row that stays may itself stand there more than once
    repeated = written(
        grouped.where("row_hash = first.row_hash").groupBy("row_hash").count().where("count > 1").select("row_hash"), "repeated"
    )
    single = _without(_without(docs, dropped), repeated)
    once = _without(docs, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten consecutive words (or a whole shorter item) with the benchmark go."""
    tidy(spark)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_hash"))
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), keep=("row_hash",))
    return _without(docs, written(found.where("n_hit > 0").select("row_hash").distinct(), "contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 2048 tokens."""
    tidy(spark)
    return packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _bounded(stage):
    """The stage with bounded Arrow batches, also where a caller runs it by itself."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _bounded(drop_toxic)),
    ("line_dedup", _bounded(drop_repeated_lines)),
    ("near_duplicates", _bounded(drop_near_duplicates)),
    ("decontamination", _bounded(drop_contaminated)),
    ("packing", _bounded(pack)),
]

#: a trained classifier and a packing plan are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
