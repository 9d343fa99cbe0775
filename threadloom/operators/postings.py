"""Sparse top-k over inverted lists, exact, in column expressions; very large query sides in ``blocks``.

A one-off search (``sparse_topk``) joins the entries of both sides on the term
and sums per pair. A stored index serves repeated searches: ``postings`` (term,
piece, id, weight) and ``terms`` (term, rows, top, low, pieces). The list of a
frequent term is cut into pieces of bounded length by a hash of the id, so no
task holds a whole hot list.

A search in the index first looks at the term table alone. Queries whose lists
are long against the neighbours they want get a first round that reads a bounded
number of postings each, of the terms that can contribute most; its k-th best
sum is a score every result has to reach. Terms whose greatest contributions
together stay below that score cannot bring in a point of their own: their lists
are not read, where they are longer than what is looked up instead, which is the
weight of those terms in the points that the other lists name. Points whose sum
and remaining bound stay below the score go before that. All other lists are
read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadloom.operators import blocks
from threadloom.operators.knn import ROUND_DIGITS, best_per_query
from threadloom.session import scratch_path

# Rows of one piece of an inverted list.
PIECE_ROWS = 1_000_000
# The first round reads up to this many postings for each wanted neighbour.
PROBE = 8
# A query gets a first round if its lists are this many times as long.
WORTH = 64
# Beyond this many postings read, or entries of the query side of a one-off search, sides meet in blocks.
MANY_POSTINGS = 100_000_000
MANY_ENTRIES = 200_000
# Covers the rounding of sums; scores are compared at ROUND_DIGITS.
SLACK = 1e-5


@dataclass(frozen=True)
class SparseIndex:
    postings: DataFrame
    terms: DataFrame


def build_index(
    points: DataFrame, path: str, vector: str = "text_sparse", pid: str = "id", piece_rows: int = PIECE_ROWS
) -> SparseIndex:
    """Writes the inverted lists of ``points`` below ``path``.

    Nothing is shuffled for it: every file holds the lists of its own points, in order of term.
    """
    spark = points.sparkSession
    given = entries(points, pid, vector, ("id", "term", "weight"))
    given.sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/lists")
    lists = spark.read.parquet(f"{path}/lists")
    terms = lists.groupBy("term").agg(
        F.count(F.lit(1)).alias("rows"), F.max("weight").alias("top"), F.min("weight").alias("low")
    )
    pieces = F.ceil(F.col("rows") / piece_rows).cast("int").alias("pieces")
    terms.select("*", pieces).write.mode("overwrite").parquet(f"{path}/terms")
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> SparseIndex:
    """A stored index. Pieces follow from id and term table; without cut lists nothing is joined for them."""
    lists, terms = spark.read.parquet(f"{path}/lists"), spark.read.parquet(f"{path}/terms")
    cut = terms.where("pieces > 1").select("term", "pieces")
    if cut.isEmpty():
        return SparseIndex(lists.withColumn("piece", F.lit(0)), terms)
    # a hot term's rows are on one side and its single row on the other: the skew join may split it
    piece = F.pmod(F.xxhash64("id"), F.coalesce("pieces", F.lit(1))).cast("int")
    return SparseIndex(lists.join(cut, "term", "left").withColumn("piece", piece).drop("pieces"), terms)


def _hits(asked: DataFrame, index: SparseIndex) -> DataFrame:
    """Contribution of every posting of the asked terms."""
    dealt = asked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    return dealt.join(index.postings, ["term", "piece"]).withColumn("part", F.col("asked") * F.col("weight"))


def _floors(asked: DataFrame, index: SparseIndex, k: int) -> DataFrame:
    """(qid, floor): a score that at least k points reach, for queries whose first round names k points."""
    short = asked.where(F.col("rows") <= PROBE * k)
    best_first = Window.partitionBy("qid").orderBy(F.desc("up"), "term").rowsBetween(Window.unboundedPreceding, -1)
    probe = short.withColumn("read", F.coalesce(F.sum("rows").over(best_first), F.lit(0))).where(F.col("read") < PROBE * k)
    sums = _hits(probe, index).groupBy("qid", "id").agg(F.sum("part").alias("score"))
    reached = best_per_query(sums, k).groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor"))
    # terms outside the probe can only lower a sum by their negative bounds
    others = asked.groupBy("qid").agg(F.sum("down").alias("all_down"))
    kept = reached.where(F.col("n") >= k).join(others, "qid")
    return kept.select("qid", (F.col("floor") + F.col("all_down") - SLACK * (1 + F.abs("floor"))).alias("floor"))


def entries(vectors: DataFrame, key: str, vector: str, names: tuple[str, str, str]) -> DataFrame:
    """Rows of a table of term weights, under the given names of key, term and weight.

    The outer form, as the inner one adds filters that compute a derived vector twice more.
    """
    return vectors.select(F.col(key).alias(names[0]), F.explode_outer(vector).alias(*names[1:])).where(F.col(names[1]).isNotNull())


def known_terms(asked: DataFrame, index: SparseIndex) -> DataFrame:
    """Asked terms with their list's length, bounds of their contribution, and their query's whole work."""
    ends = [F.col("asked") * F.col("top"), F.col("asked") * F.col("low"), F.lit(0.0)]
    bounded = asked.join(index.terms, "term").withColumns({"up": F.greatest(*ends), "down": F.least(*ends)})
    return bounded.withColumn("work", F.sum("rows").over(Window.partitionBy("qid")))


def planned_terms(asked: DataFrame, index: SparseIndex, k: int) -> DataFrame:
    """``known_terms`` with the floor of their query and whether their list is skipped."""
    bounded = asked.join(_floors(asked, index, k), "qid", "left")
    # long lists that can contribute little come first
    cheap_first = Window.partitionBy("qid").orderBy(F.col("up") / F.col("rows"), "term")
    below = F.sum("up").over(cheap_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)) < F.col("floor")
    whole = Window.partitionBy("qid")
    marked = bounded.withColumn("low_bound", F.coalesce(below, F.lit(False)))
    skipped = F.sum(F.when(F.col("low_bound"), F.col("rows")).otherwise(0)).over(whole)
    read = F.sum(F.when(F.col("low_bound"), 0).otherwise(F.col("rows"))).over(whole)
    looked_up = read * F.count_if("low_bound").over(whole)
    marked = marked.withColumn("skipped", F.col("low_bound") & (skipped > looked_up))
    return marked.withColumn("rest", F.sum(F.when(F.col("skipped"), F.col("up")).otherwise(0.0)).over(whole))


TOTAL = "round(sum(part), {}) + 0.0D".format(ROUND_DIGITS)


def _pruned(plan: DataFrame, index: SparseIndex) -> DataFrame:
    """(qid, id, part) of the points that may be among the best: read lists, then weights looked up."""
    sums = _hits(plan.where(~F.col("skipped")), index).groupBy("qid", "id").agg(
        F.sum("part").alias("part"), F.max("rest").alias("rest"), F.max("floor").alias("floor")
    )
    named = sums.where(F.col("floor").isNull() | (F.col("part") + F.col("rest") >= F.col("floor")))
    later = plan.where("skipped").select("qid", "term", "asked")
    added = named.where("rest > 0").select("qid", "id").join(later, "qid").join(index.postings.drop("piece"), ["id", "term"])
    return named.select("qid", "id", "part").unionByName(added.select("qid", "id", (F.col("asked") * F.col("weight")).alias("part")))


def search(
    queries: DataFrame, index: SparseIndex, k: int = 100, vector: str = "text_sparse", qid: str = "qid", worth: int = WORTH
) -> DataFrame:
    """Top-k by dot product of term weights as (qid, id, score, rank); no shared term, no result.

    If all queries together would read very many postings, which the counts of their
    terms tell, neither their terms nor sums are shuffled: the lists meet the queries
    block by block. Otherwise the query terms are written once with what the term
    table knows of them.
    """
    spark = queries.sparkSession
    given = entries(queries, qid, vector, ("qid", "term", "asked"))
    read = given.groupBy("term").agg(F.count(F.lit(1)).alias("asking")).join(index.terms, "term")
    if read.agg(F.coalesce(F.sum(F.col("asking") * F.col("rows")), F.lit(0))).first()[0] > MANY_POSTINGS:
        asked = blocks.as_lists(queries.select(F.col(qid).alias("qid"), F.col(vector).alias("v")), "qid", "v")
        stored = blocks.gathered(index.postings, "id", "weight")
        return blocks.ranked_rows(blocks.sparse_topk_of_blocks(blocks.kept(asked, "query-vectors"), stored, k))
    path = scratch_path(spark, "asked")
    known_terms(given, index).write.parquet(f"{path}/terms")
    asked = spark.read.parquet(f"{path}/terms")
    costly = F.col("work") > worth * PROBE * k
    parts = _hits(asked.where(~costly), index).select("qid", "id", "part")
    if not asked.where(costly).isEmpty():
        planned_terms(asked.where(costly), index, k).write.parquet(f"{path}/plan")
        parts = parts.unionByName(_pruned(spark.read.parquet(f"{path}/plan"), index))
    return best_per_query(parts.groupBy("qid", "id").agg(F.expr(TOTAL).alias("score")), k)


def dealt(points: DataFrame, pid: str = "id") -> DataFrame:
    """Points hashed by id over the configured number of shuffle partitions.

    Everything a point adds to a score then lies in its task: with a query side
    that is small enough to be broadcast, sums need no shuffle of their own, only
    the best of each task move. The number is fixed, since the work of a row is
    not in proportion to its bytes.
    """
    return points.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), pid)


def join_topk(asked: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """The same from entries (qid, term, asked) and (id, term, weight) of ``dealt`` points, each list read once."""
    parts = asked.join(lists, "term").select("qid", "id", (F.col("asked") * F.col("weight")).alias("part"))
    return best_per_query(parts.groupBy("qid", "id").agg(F.expr(TOTAL).alias("score")), k)


def sparse_topk(
    queries: DataFrame, points: DataFrame, k: int = 100, vector: str = "text_sparse", qid: str = "qid", pid: str = "id", nested: bool = False
) -> DataFrame:
    """One-off search of points that have no index, as rows or as lists (qid, ids, scores) if ``nested``.

    A query side of many entries meets the points block by block.
    """
    asked = blocks.kept(blocks.as_lists(queries.select(F.col(qid).alias("qid"), F.col(vector).alias("v")), "qid", "v"), "query-vectors")
    if asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0] > MANY_ENTRIES:
        stored = blocks.as_lists(points.select(F.col(pid).alias("id"), F.col(vector).alias("v")), "id", "v")
        found = blocks.sparse_topk_of_blocks(asked, stored, k)
        return found if nested else blocks.ranked_rows(found)
    lists = entries(dealt(points.select(pid, vector), pid), pid, vector, ("id", "term", "weight"))
    found = join_topk(entries(queries, qid, vector, ("qid", "term", "asked")), lists, k)
    return blocks.nested(found) if nested else found
