"""Thread preparation and thread statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import ordering, stats, threads as th
from threadloom.plans import inputs
from threadloom.plans.inputs import ANSWERS, PREPARED, THREAD_CTES, THREADS, answer_rows, with_
from threadloom.plans.registry import query

CTES = with_(*THREAD_CTES, PREPARED)


def _annotated(spark, sf_dir):
    return th.annotate_rows(inputs.threads(spark, sf_dir), answer_rows(spark, sf_dir))


def _prepared(spark, sf_dir):
    return th.prepare_rows(inputs.threads(spark, sf_dir), answer_rows(spark, sf_dir))


@query(
    "b1_append_corrected_record",
    with_(THREADS)
    + f"""SELECT id, title, description FROM threads
UNION ALL SELECT {th.CORRECTED_RECORD["id"]}, '{th.CORRECTED_RECORD["title"]}', '{th.CORRECTED_RECORD["description"]}'""",
)
def b1(spark, sf_dir):
    whole = inputs.threads(spark, sf_dir).withColumn(
        "answers", F.array().cast("array<struct<user_name:string,status:string,rating:double,text:string>>")
    )
    return th.append_corrected_record(whole).select("id", "title", "description")


@query("b2_author_in_chat", CTES + "SELECT id, author_in_chat FROM stats")
def b2(spark, sf_dir):
    return _annotated(spark, sf_dir).select("id", "author_in_chat")


@query("b3_answer_count", CTES + "SELECT id, n AS counter_len_chat FROM stats")
def b3(spark, sf_dir):
    return _annotated(spark, sf_dir).select("id", "counter_len_chat")


@query(
    "b4_answer_count_bin",
    CTES
    + """SELECT id, CAST(CASE WHEN n BETWEEN 1 AND 5 THEN n ELSE -1 END AS BIGINT) AS counter_len_chat_bins
FROM stats""",
)
def b4(spark, sf_dir):
    return _annotated(spark, sf_dir).select("id", "counter_len_chat_bins")


@query("b5_short_without_author", CTES + "SELECT id, description, n AS counter_len_chat FROM short")
def b5(spark, sf_dir):
    return _prepared(spark, sf_dir).select("id", "description", "counter_len_chat")


BEST_COLUMNS = """SELECT id, description, user_name, status, rating, text, max_rating FROM prepared"""


@query("b6_best_answer", CTES + BEST_COLUMNS)
def b6(spark, sf_dir):
    return _prepared(spark, sf_dir).select("id", "description", "answers_max.*", "max_rating")


@query("b6_best_answer_of_array", CTES + BEST_COLUMNS)
def b6_array(spark, sf_dir):
    short = th.gather_short_threads(inputs.threads(spark, sf_dir), answer_rows(spark, sf_dir))
    return th.prepare(short).select("id", "description", "answers_max.*", "max_rating")


@query(
    "b7_first_answer_features",
    CTES
    + """SELECT s.id, CASE WHEN a.text IS NOT NULL THEN s.n END AS len_answers, a.rating, a.text,
  CASE WHEN a.text IS NOT NULL THEN length(s.description) END AS len_description, length(a.text) AS len_text
FROM stats s LEFT JOIN answers a ON a.thread_id = s.id AND a.pos = 1""",
)
def b7(spark, sf_dir):
    rows = _annotated(spark, sf_dir)
    usable = F.col("first_answer.text").isNotNull() & F.col("description").isNotNull()
    features = F.when(
        usable,
        F.struct(
            F.col("counter_len_chat").alias("len_answers"),
            "first_answer.rating",
            "first_answer.text",
            F.length("description").cast("bigint").alias("len_description"),
            F.length("first_answer.text").cast("bigint").alias("len_text"),
        ),
    )
    return rows.select("id", features.alias("f")).select("id", "f.*")


@query("b8_projection", CTES + "SELECT description, text, id FROM prepared")
def b8(spark, sf_dir):
    return th.qa_records(_prepared(spark, sf_dir)).select("description", "answers_max.text", "id")


@query(
    "b9_minimum_rating",
    CTES + "SELECT description, text, rating, id FROM prepared WHERE rating > 5",
)
def b9(spark, sf_dir):
    kept = th.above_rating(th.qa_records(_prepared(spark, sf_dir)), 5.0)
    return kept.select("description", "answers_max.text", "answers_max.rating", "id")


@query(
    "b10_payload",
    CTES
    + """SELECT id, description AS question, text AS answer, rating FROM prepared
WHERE length(description) < 3000 AND length(text) < 3000""",
)
def b10(spark, sf_dir):
    return th.payload(th.qa_records(_prepared(spark, sf_dir)))


@query("b20_positive_rating", CTES + "SELECT id, max_rating FROM prepared WHERE max_rating > 0")
def b20(spark, sf_dir):
    return _prepared(spark, sf_dir).filter("max_rating > 0").select("id", "max_rating")


@query("d1_status_frequency", with_(ANSWERS) + "SELECT status, count(*) AS n FROM answers GROUP BY 1")
def d1(spark, sf_dir):
    return stats.frequency(answer_rows(spark, sf_dir), "status")


@query("d2_rating_distribution", with_(ANSWERS) + "SELECT rating, count(*) AS n FROM answers GROUP BY 1")
def d2(spark, sf_dir):
    return stats.frequency(answer_rows(spark, sf_dir), "rating")


@query(
    "d3_count_bin_share",
    CTES
    + """SELECT CAST(CASE WHEN n BETWEEN 1 AND 5 THEN n ELSE -1 END AS BIGINT) AS counter_len_chat_bins,
  count(*) AS n, round(count(*) / (SELECT count(*) FROM stats), 9) AS share FROM stats GROUP BY 1""",
)
def d3(spark, sf_dir):
    return stats.normalised_frequency(_annotated(spark, sf_dir), "counter_len_chat_bins").withColumn(
        "share", F.round("share", 9)
    )


@query(
    "d4_dialog_share",
    CTES
    + """SELECT author_in_chat, count(*) AS n, round(count(*) / (SELECT count(*) FROM stats), 9) AS share
FROM stats GROUP BY 1""",
)
def d4(spark, sf_dir):
    return stats.normalised_frequency(_annotated(spark, sf_dir), "author_in_chat").withColumn(
        "share", F.round("share", 9)
    )


@query(
    "d5_row_counts",
    CTES
    + """SELECT count(*) AS total, CAST(count_if(author_in_chat) AS BIGINT) AS dialog, CAST(count_if(NOT author_in_chat) AS BIGINT) AS non_dialog,
  CAST(count_if(NOT author_in_chat AND coalesce(b.max_rating, 0) > 0) AS BIGINT) AS scored
FROM stats s LEFT JOIN best b ON b.thread_id = s.id""",
)
def d5(spark, sf_dir):
    author = F.col("author_in_chat")
    return _annotated(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(author).alias("dialog"),
        F.count_if(~author).alias("non_dialog"),
        F.count_if(~author & (F.col("max_rating") > 0)).alias("scored"),
    )


DESCRIBE = """count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min,
  max(x) AS max, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
  round(quantile_cont(x, 0.75), 6) AS q75"""


def rounded_describe(df):
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "d6_rating_summary",
    CTES + f"SELECT {DESCRIBE} FROM (SELECT CAST(max_rating AS DOUBLE) AS x FROM prepared)",
)
def d6(spark, sf_dir):
    return rounded_describe(stats.describe(_prepared(spark, sf_dir), "max_rating"))


@query(
    "d6_price_summary",
    f"SELECT {DESCRIBE} FROM (SELECT l_extendedprice AS x FROM lineitem)",
)
def d6_price(spark, sf_dir):
    return rounded_describe(stats.describe(inputs.table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query(
    "d6_price_sketch",
    f"""SELECT {DESCRIBE.split("round(quantile")[0].rstrip(", ")}, true AS q25_within, true AS q50_within, true AS q75_within
FROM (SELECT l_extendedprice AS x FROM lineitem)""",
)
def d6_sketch(spark, sf_dir):
    """Summaries per part, merged; each quartile's true rank is within four times the stated error."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    merged = stats.merge_sketches(stats.sketch(lines, "l_extendedprice", ["l_returnflag"]))
    told = stats.describe_sketch(merged)
    quartile = {f: told.select(f"q{int(f * 100)}").scalar() for f in stats.QUARTILES}
    x, slack = F.col("l_extendedprice"), 4 * stats.rank_error()
    ranks = lines.agg(
        *[
            ((F.count_if(x < q) / F.count(x) <= f + slack) & (F.count_if(x <= q) / F.count(x) >= f - slack)).alias(f"q{int(f * 100)}_within")
            for f, q in quartile.items()
        ]
    )
    basic = told.select("count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")
    held = ranks.select(F.struct(*ranks.columns)).scalar()
    return basic.withColumn("_r", held).select(*basic.columns, "_r.*")


HISTOGRAM = """
edges AS (SELECT min(x) AS lo, max(x) AS hi FROM source),
bins AS (SELECT unnest(range(1, 11)) AS bin),
filled AS (
  SELECT least(CAST(floor((x - lo) / ((hi - lo) / 10)) AS BIGINT) + 1, 10) AS bin, count(*) AS n
  FROM source, edges GROUP BY 1)
SELECT bin, round(lo + (bin - 1) * ((hi - lo) / 10), 6) AS bin_start, coalesce(n, 0) AS n
FROM bins CROSS JOIN edges LEFT JOIN filled USING (bin)"""


@query(
    "d7_rating_histogram",
    CTES.rstrip()
    + ",\nsource AS (SELECT CAST(max_rating AS DOUBLE) AS x FROM prepared WHERE max_rating > 0),"
    + HISTOGRAM,
)
def d7(spark, sf_dir):
    kept = _prepared(spark, sf_dir).filter("max_rating > 0")
    return stats.histogram(kept, "max_rating").withColumn("bin_start", F.round("bin_start", 6))


@query(
    "d8_category_frequency",
    "SELECT o_orderpriority AS cat, count(*) AS n FROM orders GROUP BY 1",
)
def d8(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("cat"))
    return stats.frequency(orders, "cat").orderBy(F.desc("n"), "cat")


@query(
    "d10_filter_audit",
    CTES
    + """, counted AS (SELECT count(*) AS b, CAST(count_if(rating > 5) AS BIGINT) AS r,
  CAST(count_if(length(description) < 3000 AND length(text) < 3000) AS BIGINT) AS t FROM prepared)
SELECT 'min_rating' AS stage, b AS before, r AS after, b - r AS dropped FROM counted
UNION ALL SELECT 'text_length', b, t, b - t FROM counted""",
)
def d10(spark, sf_dir):
    short = (F.length("description") < th.MAX_TEXT) & (F.length("answers_max.text") < th.MAX_TEXT)
    return stats.audit(
        _prepared(spark, sf_dir), min_rating=F.col("answers_max.rating") > 5, text_length=short
    )


@query("g1_union_all", with_(THREADS) + "SELECT id, description FROM threads UNION ALL SELECT id, title FROM threads")
def g1(spark, sf_dir):
    base = inputs.threads(spark, sf_dir)
    titles = base.select("id", F.col("title").alias("description"))
    return base.select("id", "description").unionByName(titles)


@query(
    "g5_explode_answers",
    CTES
    + """SELECT a.thread_id AS id, a.pos AS answer_no, a.text FROM answers a JOIN short s ON s.id = a.thread_id""",
)
def g5(spark, sf_dir):
    short = th.gather_short_threads(inputs.threads(spark, sf_dir), answer_rows(spark, sf_dir))
    return short.select("id", F.posexplode("answers").alias("p", "a")).select(
        "id", (F.col("p") + 1).cast("bigint").alias("answer_no"), "a.text"
    )


@query("g6_struct_columns", CTES + "SELECT id, text AS best_text, max_rating FROM prepared")
def g6(spark, sf_dir):
    short = th.gather_short_threads(inputs.threads(spark, sf_dir), answer_rows(spark, sf_dir))
    found = short.select("id", th.best_answer(F.col("answers")).alias("b")).select("id", "b.*")
    return found.select("id", F.col("answers_max.text").alias("best_text"), "max_rating")


@query("h1_text_length", "SELECT doc_id, length(text) AS n FROM documents")
def h1(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.length("text").cast("bigint").alias("n"))


@query(
    "h2_list_length",
    """SELECT doc_id, len(list_filter(string_split(text, ' '), lambda w: w <> '')) AS n FROM documents""",
)
def h2(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.size(tx.words(F.col("text"))).cast("bigint").alias("n"))


@query(
    "h6_prefix_suffix",
    """SELECT item_id, regexp_replace(text, '^The ', '') AS without_prefix,
  regexp_replace(text, '\\.$', '') AS without_suffix, starts_with(text, 'The') AS starts, text LIKE '%.' AS ends
FROM benchmark""",
)
def h6(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "benchmark")
    return items.select(
        "item_id",
        F.regexp_replace("text", "^The ", "").alias("without_prefix"),
        F.regexp_replace("text", r"\.\z", "").alias("without_suffix"),
        F.startswith(F.col("text"), F.lit("The")).alias("starts"),
        F.endswith(F.col("text"), F.lit(".")).alias("ends"),
    )


@query(
    "h7_strip",
    r"""SELECT page_id, trim(html, E' \t\n\r\x0b\x0c') AS body FROM pages""",
)
def h7(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", tx.strip_text(F.col("html")).alias("body"))


@query(
    "h13_thousands",
    "SELECT o_orderkey AS id, format('{:,}', CAST(round(o_totalprice) AS BIGINT)) AS total FROM orders",
)
def h13(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("id"), tx.thousands(F.round("o_totalprice").cast("bigint")).alias("total")
    )


@query("h21_nested_field", CTES + "SELECT id, rating AS best_rating, status AS best_status FROM prepared")
def h21(spark, sf_dir):
    return _prepared(spark, sf_dir).select(
        "id",
        F.col("answers_max.rating").alias("best_rating"),
        F.col("answers_max.status").alias("best_status"),
    )


SPLIT_CTE = """
keyed AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5('{seed}:' || doc_id), doc_id) AS rn, count(*) OVER () AS n
  FROM documents)"""


@query(
    "e1_tail_split",
    with_(SPLIT_CTE.format(seed=42))
    + """SELECT doc_id AS points, rn, CASE WHEN rn > n - floor(n / 100.0::DOUBLE * 20) THEN 'valid' ELSE 'train' END AS cat
FROM keyed""",
)
def e1(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("points"))
    return ordering.split_tail_valid(docs, "points", 20)


@query(
    "e2_head_split",
    with_(SPLIT_CTE.format(seed=0))
    + """SELECT doc_id AS points, rn, CASE WHEN rn <= floor(n / 100.0::DOUBLE * 15) THEN 'valid' ELSE 'train' END AS split
FROM keyed""",
)
def e2(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("points"))
    return ordering.split_head_valid(docs, "points", 15)


@query("e4_seeded_shuffle", with_(SPLIT_CTE.format(seed=7)) + "SELECT doc_id, rn FROM keyed")
def e4(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id")
    return ordering.shuffled_position(docs, "doc_id", seed=7)


@query(
    "e5_mismatched_pairs",
    """WITH numbered AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 4 AS batch FROM documents),
bounds AS (SELECT batch, max(doc_id) AS last_id FROM numbered GROUP BY 1)
SELECT n.doc_id, coalesce(p.doc_id, b.last_id) AS other_id FROM numbered n JOIN bounds b USING (batch)
LEFT JOIN LATERAL (SELECT max(m.doc_id) AS doc_id FROM numbered m WHERE m.batch = n.batch AND m.doc_id < n.doc_id) p ON true""",
)
def e5(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id")
    return ordering.mismatched_pairs(docs, "doc_id", "doc_id", 4, "other_id")


@query("f1_filtered_limit", "SELECT doc_id, n_chars FROM documents WHERE n_chars >= 500 ORDER BY doc_id LIMIT 100")
def f1(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.filter("n_chars >= 500").orderBy("doc_id").limit(100).select("doc_id", "n_chars")


@query("f4_first_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 3")
def f4(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").orderBy("doc_id").limit(3).select("doc_id", "lang")


@query("f5_random_rows", "SELECT doc_id FROM documents ORDER BY md5('11:' || doc_id), doc_id LIMIT 8")
def f5(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id")
    return ordering.random_sample(docs, "doc_id", 8, seed=11)


@query(
    "f6_sample_with_replacement",
    """WITH r AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents),
d AS (SELECT i AS draw, CAST('0x' || substr(md5('42:' || i), 1, 15) AS BIGINT) % (SELECT max(n) FROM r) + 1 AS rn FROM range(512) t(i) WHERE i < (SELECT max(n) FROM r))
SELECT d.draw, r.doc_id, r.lang FROM d JOIN r USING (rn)""",
)
def f6(spark, sf_dir):
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ordering.sample_with_replacement(docs, "doc_id", 512)


@query("g4_repeat_prompts", "SELECT item_id, unnest(range(1, 5)) AS gen_no FROM benchmark")
def g4(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "benchmark").select("item_id")
    return items.withColumn("gen_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(4).cast("bigint"))))


@query(
    "d17_metric_means",
    """SELECT CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'eval' END AS split, event_type AS key,
  round(avg(value), 6) AS mean_value FROM events GROUP BY 1, 2""",
)
def d17(spark, sf_dir):
    logged = inputs.table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, "train").otherwise("eval").alias("split"),
        F.col("event_type").alias("key"),
        "value",
    )
    return stats.metric_means(logged).withColumn("mean_value", F.round("mean_value", 6))


@query(
    "d20_running_mean",
    """WITH batches AS (SELECT event_id // 7 AS step, count(*) AS n, avg(value) AS mean FROM events GROUP BY 1)
SELECT step, round(sum(n * mean) OVER w / sum(n) OVER w, 9) AS running_mean
FROM batches WINDOW w AS (ORDER BY step)""",
)
def d20(spark, sf_dir):
    batches = (
        inputs.table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / 7).cast("bigint").alias("step"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))
    )
    return stats.running_mean(batches, "step").select("step", F.round("running_mean", 9).alias("running_mean"))


@query(
    "d20_running_moments",
    """WITH batches AS (SELECT event_id // 7 AS step, count(*) AS n, avg(value) AS mean, var_pop(value) * count(*) AS m2 FROM events GROUP BY 1),
run AS (SELECT step, sum(n) OVER w AS n, sum(n * mean) OVER w / sum(n) OVER w AS mean, sum(m2 + n * mean * mean) OVER w AS square FROM batches WINDOW w AS (ORDER BY step))
SELECT step, CAST(n AS BIGINT) AS n, round(mean, 6) AS running_mean, round((square - n * mean * mean) / (n - 1), 6) AS running_var, true AS same_far_away FROM run""",
)
def d20_moments(spark, sf_dir):
    """Running mean and variance; the same values a thousand million away from 0 must have the same variance."""
    far = 1e9

    def run(value):
        batches = (
            inputs.table(spark, sf_dir, "events")
            .groupBy(F.floor(F.col("event_id") / 7).cast("bigint").alias("step"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(F.lit(1))).alias("m2"))
        )
        return stats.running_moments(batches, "step")

    near = run(F.col("value"))
    away = run(F.col("value") + far).select("step", F.col("running_mean").alias("mean_b"), F.col("running_var").alias("var_b"))
    same = (F.abs(F.col("mean_b") - far - F.col("running_mean")) < 1e-5) & (F.abs(F.col("var_b") / F.col("running_var") - 1) < 1e-6)
    return near.join(away, "step").select(
        "step", "n", F.round("running_mean", 6).alias("running_mean"), F.round("running_var", 6).alias("running_var"), same.alias("same_far_away")
    )


@query(
    "d19_accuracy",
    """SELECT round(avg(CASE WHEN (d.n_chars > 1000) = (l.quality = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM labels l JOIN documents d USING (doc_id)""",
)
def d19(spark, sf_dir):
    labelled = inputs.table(spark, sf_dir, "labels").join(inputs.table(spark, sf_dir, "documents"), "doc_id")
    marked = labelled.select(
        (F.col("n_chars") > 1000).cast("int").alias("predicted"), F.col("quality").alias("label")
    )
    return stats.accuracy(marked, "predicted", "label").withColumn("accuracy", F.round("accuracy", 6))
