"""Sources and sinks: each query writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions import text as tx
from threadloom.operators import ordering, prompts as pr, threads as th
from threadloom.operators.postings import load_index
from threadloom.plans import inputs
from threadloom.plans.inputs import POINTS, THREAD_CTES, hybrid_points, points, with_
from threadloom.plans.prompt_queries import variants_sql
from threadloom.plans.registry import query
from threadloom.plans.retrieval_queries import MODES, compare_rows
from threadloom.session import scratch_path
from threadloom.sources import lines as ln, tables as tb
from threadloom.sources.collection import Collection
from threadloom.streaming.upsert import stream_parts, upsert_stream

CTES = with_(*THREAD_CTES)


def dump_lines(spark, sf_dir):
    """Short threads as dump lines in three shapes.

    Finished orders are Python literals, pending ones are cut short, the rest is JSON.
    """
    short = th.gather_short_threads(inputs.threads(spark, sf_dir), inputs.answer_rows(spark, sf_dir))
    status = inputs.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    rows = short.join(status, "id")
    json_line = F.to_json(F.struct("id", "title", "description", "answers"))
    literal = F.concat(
        F.lit("{'id': "), F.col("id").cast("string"), F.lit(", 'title': None, 'description': '"), "description",
        F.lit("', 'answers': "), F.replace(F.to_json("answers"), F.lit('"'), F.lit("'")), F.lit("}"),
    )
    line = (
        F.when(F.col("o_orderstatus") == "F", literal)
        .when(F.col("o_orderstatus") == "P", F.substring(json_line, F.lit(1), F.length(json_line) - 2))
        .otherwise(json_line)
    )
    return rows.select(line.alias("value"))


def parsed_dump(spark, sf_dir):
    path = scratch_path(spark, "dump")
    dump_lines(spark, sf_dir).write.option("compression", "gzip").text(path)
    return ln.parse_lines(ln.read_lines(spark, path))


@query(
    "a1_read_line_dump",
    CTES
    + """SELECT s.id, CASE WHEN s.order_status <> 'F' THEN s.title END AS title, s.description, s.n AS n_answers, b.text, coalesce(b.max_rating, 0) AS max_rating
FROM short s LEFT JOIN best b ON b.thread_id = s.id WHERE s.order_status <> 'P'""",
)
def a1(spark, sf_dir):
    threads = ln.threads(parsed_dump(spark, sf_dir))
    prepared = th.prepare(threads)
    return prepared.select(
        "id", "title", "description", F.col("counter_len_chat").alias("n_answers"), "answers_max.text", "max_rating"
    )


@query(
    "a1_read_zst_dump",
    CTES
    + """SELECT s.id, CASE WHEN s.order_status <> 'F' THEN s.title END AS title, s.description, s.n AS n_answers, b.text, coalesce(b.max_rating, 0) AS max_rating
FROM short s LEFT JOIN best b ON b.thread_id = s.id WHERE s.order_status <> 'P'""",
)
def a1_zst(spark, sf_dir):
    """The same dump as .zst files of many frames, read in byte ranges."""
    path = scratch_path(spark, "dump-zst")
    ln.write_zst_lines(dump_lines(spark, sf_dir), path, frame_bytes=64 << 10)
    threads = ln.threads(ln.parse_lines(ln.read_zst_lines(spark, path, split_bytes=256 << 10)))
    return th.prepare(threads).select(
        "id", "title", "description", F.col("counter_len_chat").alias("n_answers"), "answers_max.text", "max_rating"
    )


@query("a2_rejected_lines", CTES + "SELECT count(*) AS lines, CAST(count_if(order_status = 'P') AS BIGINT) AS rejected FROM short")
def a2(spark, sf_dir):
    return parsed_dump(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("rejected").alias("rejected")
    )


@query("a3_split_part_files", "SELECT doc_id, lang, n_chars FROM documents")
def a3(spark, sf_dir):
    path = scratch_path(spark, "parts")
    ln.write_parts(inputs.table(spark, sf_dir, "documents"), path, rows_per_file=ln.ROWS_PER_FILE)
    return tb.read_parts(spark, path).select("doc_id", "lang", "n_chars")


@query("a4_read_part_folder", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def a4(spark, sf_dir):
    path = scratch_path(spark, "folder")
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    for _ in range(2):
        tb.write_table(orders, path, mode="append")
    return tb.read_parts(spark, path, orders.schema)


@query("a5_qa_records", CTES + "SELECT s.id, s.description, b.text, b.rating FROM short s LEFT JOIN best b ON b.thread_id = s.id")
def a5(spark, sf_dir):
    path = scratch_path(spark, "qa")
    prepared = th.prepare_rows(inputs.threads(spark, sf_dir), inputs.answer_rows(spark, sf_dir))
    tb.write_table(th.qa_records(prepared), path)
    stored = tb.read_parts(spark, path, schemas.QA_RECORD)
    return stored.select("id", "description", "answers_max.text", "answers_max.rating")


@query(
    "a6_replace_collection",
    with_(POINTS, inputs.TERMS) + "SELECT t.id, p.answer, t.term, t.w AS weight FROM terms t JOIN points p USING (id)",
)
def a6(spark, sf_dir):
    path = scratch_path(spark, "collection")
    pts = hybrid_points(spark, sf_dir)
    for _ in range(2):
        tb.replace_collection(pts, path, dim=64)
    stored = tb.read_parts(spark, f"{path}/points").select("id", "answer")
    lists = load_index(spark, f"{path}/postings").postings
    return lists.select("id", "term", "weight").join(stored, "id")


@query(
    "a7_upsert_last_write_wins",
    """SELECT d.doc_id AS id, CASE WHEN l.doc_id IS NULL THEN d.lang ELSE 'labelled ' || l.quality END AS question FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def a7(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("question"))
    labels = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    collection = Collection(spark, scratch_path(spark, "points"))
    collection.upsert(docs, order="id")
    # two writes of every labelled id in one batch: the later one counts
    update = labels.select(
        "id",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("seq"), F.lit("early").alias("question")),
                F.struct(F.lit(1).alias("seq"), F.concat(F.lit("labelled "), F.col("quality").cast("string")).alias("question")),
            )
        ),
    )
    collection.upsert(update, order="seq")
    return collection.read()


@query(
    "a7_upsert_null_order",
    """SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'ordered' ELSE lang END AS question FROM documents""",
)
def a7_null_order(spark, sf_dir):
    """A NULL order never beats another; a newer batch wins even with NULL values."""
    docs = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("question"), F.lit(1).alias("seq"))
    collection = Collection(spark, scratch_path(spark, "null_order"))
    collection.upsert(docs, order="seq")
    both = F.array(
        F.struct(F.lit(None).cast("int").alias("seq"), F.lit("unordered").alias("question")),
        F.struct(F.lit(0).alias("seq"), F.lit("ordered").alias("question")),
    )
    collection.upsert(docs.where("id % 3 = 1").select("id", F.inline(both)), order="seq")
    collection.upsert(docs.where("id % 3 = 0").withColumns({"question": F.lit(None).cast("string"), "seq": F.lit(None).cast("int")}), order="seq")
    return collection.read()


@query("a11_sampled_ids", with_(POINTS, "k AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || id), id) AS rn FROM points ORDER BY rn LIMIT 100), n AS (SELECT count(*) AS n FROM k)")
+ """SELECT id AS points, CASE WHEN rn > n - floor(n / 100.0::DOUBLE * 20) THEN 'valid' ELSE 'train' END AS cat FROM k, n""")
def a11(spark, sf_dir):
    path = scratch_path(spark, "ids")

    def make():
        ids = ordering.random_sample(points(spark, sf_dir).select(F.col("id").alias("points")), "points", 100)
        return ordering.split_tail_valid(ids, "points", 20).select("points", "cat")

    first = tb.sampled_ids(spark, path, 100, make)
    return tb.sampled_ids(spark, path, first.count(), make)


@query(
    "a12_nested_checkpoint",
    CTES + "SELECT s.id, a.pos AS answer_no, a.text FROM short s JOIN answers a ON a.thread_id = s.id",
)
def a12(spark, sf_dir):
    path = scratch_path(spark, "checkpoint")
    tb.write_table(th.gather_short_threads(inputs.threads(spark, sf_dir), inputs.answer_rows(spark, sf_dir)), path)
    rows = tb.read_parts(spark, path).select("id", F.posexplode("answers").alias("p", "a"))
    return rows.select("id", (F.col("p") + 1).cast("bigint").alias("answer_no"), "a.text")


@query(
    "a13_text_dump",
    with_(POINTS, "kept AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || id), id) - 1 AS doc_no FROM points WHERE rating > 5)")
    + r"""SELECT doc_no, E'\nDOC ' || doc_no || E'\n\nRATING\n' || rating || E'\n\nQUESTION\n' || question || E'\n\nANSWER\n' || answer || E'\n\nID\n' || id || E'\n\n\n            ' AS value FROM kept""",
)
def a13(spark, sf_dir):
    kept = points(spark, sf_dir).filter("rating > 5").drop("dense")
    numbered = ordering.shuffled_position(kept, "id").withColumn("doc_no", F.col("rn") - 1)
    path = scratch_path(spark, "dump.txt")
    tb.write_text(tb.point_dump(numbered), path)
    end = "\n\n\n" + " " * 12
    blocks = spark.read.option("lineSep", f"{end}\n").text(path)
    return blocks.select(
        F.regexp_extract("value", "DOC ([0-9]+)", 1).cast("bigint").alias("doc_no"), F.concat("value", F.lit(end)).alias("value")
    )


@query("a14_comparison_csv", MODES + "SELECT mode, qid, id, rank, question FROM shown")
def a14(spark, sf_dir):
    path = scratch_path(spark, "rag_results")
    rows = compare_rows(spark, sf_dir)
    tb.write_csv(rows, path)
    return tb.read_csv(spark, path, rows.schema)


@query(
    "a15_train_valid_table",
    f"""SELECT rn, pair_id, {variants_sql(pr.DATASET_SYSTEM_PROMPT)}, CASE WHEN rn <= floor(n / 100.0::DOUBLE * 15) THEN 'valid' ELSE 'train' END AS split
FROM (SELECT a.conv_id * 1000 + a.turn AS pair_id, a.text AS question, b.text AS answer, CAST(NULL AS VARCHAR) AS context,
    row_number() OVER (ORDER BY md5('0:' || (a.conv_id * 1000 + a.turn)), a.conv_id * 1000 + a.turn) AS rn, count(*) OVER () AS n
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)""",
)
def a15(spark, sf_dir):
    path = scratch_path(spark, "dataset")
    turns = inputs.table(spark, sf_dir, "conversations")
    answers = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    rows = turns.join(answers, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"),
        F.col("text").alias("question"),
        "answer",
        F.lit(None).cast("string").alias("context"),
    )
    tb.save_splits(ordering.split_head_valid(pr.prompt_variants(rows), "pair_id"), path)
    return tb.read_parts(spark, path)


@query(
    "a16_generations_per_step",
    """WITH s AS (SELECT * FROM benchmark ORDER BY item_id LIMIT 3)
SELECT step, trim('<|im_start|>user' || chr(10) || text || '<|im_end|>', E' \\t\\n\\r\\x0b\\x0c') AS prompt, 'echo: ' || text AS generated, trim(text, E' \\t\\n\\r\\x0b\\x0c') AS target
FROM s, (VALUES (10), (20)) v(step)""",
)
def a16(spark, sf_dir):
    path = scratch_path(spark, "generations")
    items = inputs.table(spark, sf_dir, "benchmark")
    chat = tx.chat_markup(F.array(tx.message("user", F.col("text")), tx.message("assistant", F.col("text"))))
    rows = items.select("item_id", chat.alias("chat"), F.concat(F.lit("echo: "), "text").alias("generated"))
    for step in (10, 20, 10):  # a step that is run again keeps its rows once
        tb.append_generations(pr.sample_generations(rows, "chat", "generated", "item_id", 3), path, step)
    return tb.read_parts(spark, path)


@query("a17_judge_set", "SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'high' ELSE 'low' END AS cat FROM labels")
def a17(spark, sf_dir):
    path = scratch_path(spark, "judge_set")
    labels = inputs.table(spark, sf_dir, "labels")
    rows = labels.select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "high").otherwise("low").alias("cat"))
    tb.write_csv(rows, path)
    return tb.read_csv(spark, path, rows.schema)


@query(
    "a18_answers_per_model",
    """SELECT item_id, 'echo: ' || text AS model_answer, replace(m, '/', '_') AS model FROM benchmark, (VALUES ('lab/base-7b'), ('lab/tuned-7b')) v(m)""",
)
def a18(spark, sf_dir):
    path = scratch_path(spark, "answers")
    items = inputs.table(spark, sf_dir, "benchmark")
    rows = items.select(
        "item_id",
        F.concat(F.lit("echo: "), "text").alias("model_answer"),
        F.explode(F.array(F.lit("lab/base-7b"), F.lit("lab/tuned-7b"))).alias("model"),
    )
    tb.save_model_answers(rows, path)
    return tb.read_csv(spark, path, rows.schema)


@query(
    "i1_stream_upsert",
    "SELECT doc_id AS id, text AS question, 'answer ' || doc_id AS answer, CAST(doc_id % 11 AS DOUBLE) AS rating FROM documents",
)
def i1(spark, sf_dir):
    collection = Collection(spark, scratch_path(spark, "stream_points"))
    schema = inputs.table(spark, sf_dir, "documents").schema
    arriving = stream_parts(spark, f"{sf_dir}/{{documents.parquet}}", schema, "*")
    as_payload = lambda df: df.select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("question"),
        F.concat(F.lit("answer "), F.col("doc_id").cast("string")).alias("answer"),
        (F.col("doc_id") % 11).cast("double").alias("rating"),
    )
    upsert_stream(arriving, collection, scratch_path(spark, "stream_state"), "id", as_payload).awaitTermination()
    return collection.read()


@query(
    "i1_two_streams",
    "SELECT doc_id AS id, 'second' AS question FROM documents UNION ALL SELECT -1 AS id, 'stored' AS question",
)
def i1_two_streams(spark, sf_dir):
    """Two streams, one after the other, into a collection that holds rows already."""
    collection = Collection(spark, scratch_path(spark, "two_streams"))
    collection.upsert(spark.sql("SELECT -1L AS id, 'stored' AS question"), order="id")
    schema = inputs.table(spark, sf_dir, "documents").schema
    for word in ("first", "second"):
        rows = lambda df, word=word: df.select(F.col("doc_id").alias("id"), F.lit(word).alias("question"))
        arriving = stream_parts(spark, f"{sf_dir}/{{documents.parquet}}", schema, "*")
        upsert_stream(arriving, collection, scratch_path(spark, f"state_{word}"), "id", rows).awaitTermination()
    return collection.read()


@query(
    "i2_stream_line_file",
    CTES + "SELECT s.id, s.description, s.n AS n_answers FROM short s WHERE s.order_status <> 'P'",
)
def i2(spark, sf_dir):
    source = scratch_path(spark, "arriving_lines")
    ln.write_zst_lines(dump_lines(spark, sf_dir), source, frame_bytes=64 << 10)
    collection = Collection(spark, scratch_path(spark, "stream_threads"))
    arriving = ln.stream_zst_lines(spark, source)
    parse = lambda df: ln.threads(ln.parse_lines(df)).select("id", "description", F.size("answers").cast("bigint").alias("n_answers"))
    upsert_stream(arriving, collection, scratch_path(spark, "line_state"), "id", parse).awaitTermination()
    return collection.read()
