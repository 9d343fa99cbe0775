"""Reference-shaped inputs derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.functions.models import lexical_weights, word_ids
from threadloom.operators.threads import AUTHOR_STATUS
from threadloom.sources.tables import read_spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table for costly row work, see ``read_spread``."""
    return read_spread(spark, f"{sf_dir}/{name}.parquet")


def with_(*parts: str) -> str:
    """WITH clause of several common table expressions."""
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n"


# --- threads: orders ask, line items answer ------------------------------------


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("title "), "o_orderpriority").alias("title"),
        F.concat(F.lit("question "), F.col("o_orderkey").cast("string")).alias("description"),
    )


def answer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return spread(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("thread_id"),
        F.struct(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"
        ).alias("position"),
        F.concat(F.lit("user "), F.col("l_suppkey").cast("string")).alias("user_name"),
        F.when(asked, AUTHOR_STATUS).otherwise("Юрист").alias("status"),
        F.round(F.col("l_discount") * 100).alias("rating"),
        F.concat(
            F.lit("answer "), F.col("l_partkey").cast("string"), F.lit("/"), F.col("l_suppkey").cast("string")
        ).alias("text"),
    )


THREADS = """
threads AS (
  SELECT o_orderkey AS id, 'title ' || o_orderpriority AS title,
         'question ' || o_orderkey AS description, o_orderstatus AS order_status
  FROM orders)"""

ANSWERS = """
answers AS (
  SELECT l_orderkey AS thread_id, 'user ' || l_suppkey AS user_name,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Автор вопроса' ELSE 'Юрист' END AS status,
         round(l_discount * 100) AS rating, 'answer ' || l_partkey || '/' || l_suppkey AS text,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount) AS pos
  FROM lineitem)"""

STATS = """
stats AS (
  SELECT t.id, t.title, t.description, t.order_status, count(a.pos) AS n,
         coalesce(bool_or(a.status = 'Автор вопроса'), false) AS author_in_chat
  FROM threads t LEFT JOIN answers a ON a.thread_id = t.id GROUP BY ALL)"""

SHORT = """
short AS (SELECT * FROM stats WHERE NOT author_in_chat AND n < 6)"""

BEST = """
best AS (
  SELECT thread_id, user_name, status, rating, text, greatest(rating, 0) AS max_rating
  FROM answers
  QUALIFY row_number() OVER (PARTITION BY thread_id ORDER BY greatest(rating, 0) DESC, pos) = 1)"""

THREAD_CTES = (THREADS, ANSWERS, STATS, SHORT, BEST)

# short threads with their best answer
PREPARED = """
prepared AS (
  SELECT s.*, b.user_name, b.status, b.rating, b.text, coalesce(b.max_rating, 0) AS max_rating
  FROM short s LEFT JOIN best b ON b.thread_id = s.id)"""


# --- points: documents with stored vectors --------------------------------------


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return (
        docs.filter(F.length("text") < 3000)
        .join(vectors, docs.doc_id == vectors.vec_id)
        .select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("question"),
            F.concat(F.lit("answer "), F.col("doc_id").cast("string")).alias("answer"),
            (F.col("doc_id") % 11).cast("double").alias("rating"),
            F.col("embedding").alias("dense"),
        )
    )


def hybrid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).withColumn("text_sparse", lexical_weights(F.col("question")))


POINTS = """
points AS (
  SELECT d.doc_id AS id, d.text AS question, 'answer ' || d.doc_id AS answer,
         CAST(d.doc_id % 11 AS DOUBLE) AS rating, CAST(e.embedding AS DOUBLE[]) AS dense
  FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id WHERE length(d.text) < 3000)"""

TERMS = """
terms AS (
  SELECT id, term, CAST(count(*) AS DOUBLE) AS w
  FROM (SELECT id, unnest(string_split(lower(question), ' ')) AS term FROM points)
  WHERE term <> '' GROUP BY ALL)"""

DENSE = """
dense AS (
  SELECT q.id AS qid, p.id AS id, round(list_cosine_similarity(q.dense, p.dense), 6) + 0.0 AS score
  FROM points q, points p)"""

SPARSE = """
sparse AS (
  SELECT a.id AS qid, b.id AS id, round(sum(a.w * b.w), 6) AS score
  FROM terms a JOIN terms b USING (term) GROUP BY 1, 2)"""


def ranked(name: str, source: str, k: int) -> str:
    return f"""
{name} AS (
  SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank
  FROM {source} QUALIFY rank <= {k})"""


def restricted(name: str, candidates: str, scored: str) -> str:
    return f"""
{name} AS (SELECT s.* FROM {scored} s JOIN {candidates} c ON c.qid = s.qid AND c.id = s.id)"""


def fused(name: str, sources: list[str], limit: int, k: int = 60) -> str:
    union = " UNION ALL ".join(f"SELECT qid, id, rank FROM {s}" for s in sources)
    return f"""
{name} AS (
  SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank
  FROM (SELECT qid, id, round(sum(1.0::DOUBLE / ({k} + rank)), 12) AS score FROM ({union}) GROUP BY 1, 2)
  QUALIFY rank <= {limit})"""


# --- token rows: one array of ids per document ----------------------------------

# id of one frequent word serves as the end token
END_WORD = "the"


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang and token ids: the length of each word."""
    words = F.split("text", " ", -1)
    return spread(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.transform(words, lambda w: F.length(w).cast("bigint")).alias("ids")
    )


def hashed_tokens(column: str):
    return word_ids(F.col(column))


TOKENS = """
tokens AS (
  SELECT doc_id, lang, list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS BIGINT)) AS ids
  FROM documents)"""


def word_ids_sql(column: str) -> str:
    return (
        f"list_transform(list_filter(string_split({column}, ' '), lambda w: w <> ''), "
        "lambda w: CAST('0x' || substr(md5(w), 1, 15) AS BIGINT))"
    )


# --- preference pairs: a user turn and the two turns after it ------------------------


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    first = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("prompt")
    )
    second = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("chosen"))
    third = turns.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("text").alias("rejected"))
    return (
        first.join(second, ["conv_id", "turn"])
        .join(third, ["conv_id", "turn"])
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), "prompt", "chosen", "rejected")
    )


PAIRS = """
pairs AS (
  SELECT a.conv_id * 1000 + a.turn AS pair_id, a.text AS prompt, b.text AS chosen, c.text AS rejected
  FROM conversations a
  JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
  JOIN conversations c ON c.conv_id = a.conv_id AND c.turn = a.turn + 2
  WHERE a.role = 'user')"""


# --- rollouts: an order is a prompt, its lines are completions -----------------------

REWARD_COLUMNS = {
    "quantity": "l_quantity",
    "price": "l_extendedprice / 1000",
    "discount": "l_discount * 100",
}


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = [
        F.struct(F.lit(n).alias("reward_name"), F.expr(e).alias("reward"))
        for n, e in REWARD_COLUMNS.items()
    ]
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("group_id"),
        F.col("l_linenumber").cast("bigint").alias("gen_no"),
        F.inline(F.array(*entries)),
    )


ROLLOUTS = "rollouts AS (" + " UNION ALL ".join(
    f"SELECT l_orderkey AS group_id, CAST(l_linenumber AS BIGINT) AS gen_no, "
    f"'{n}' AS reward_name, {e} AS reward FROM lineitem"
    for n, e in REWARD_COLUMNS.items()
) + ")"
