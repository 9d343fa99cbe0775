"""Chat formatting in budgeted windows of whole turns.

A conversation becomes windows of at most ``budget`` tokens. Each holds new
turns, the system turn (if the conversation opens with one), and as many turns
before the new ones as fit ``history`` tokens. Only new assistant turns are
targets: the loss mask lists their texts, repeated turns are never under it.

Method: prefix sums of turn tokens choose the spans. With ``capacity`` = what
system turn and history leave of the budget, turns of more than a quarter of it
are windows of their own; the others are cut where their prefix sum enters the
next slot of three quarters of it, so new turns never exceed the capacity (a
longer single turn does, it is not cut). A turn is history of the windows that
start within ``history`` tokens after its own start, a range frame over the
prefix sums.

Column expressions only. One shuffle by conversation serves prefix sums, spans
and the grouping into windows. Conversations beyond ``LONG_BYTES`` are ranged
by turn instead: prefix sums of the parts are accumulated, and the conversation
is dealt out again in chunks of whole slots; turns that windows of the next
chunk repeat, and the system turn, go to both. The windows are the same.

Template: ``<turn>role``, a line feed, the text, ``</turn>`` and a line feed.
Inside texts a ``<turn`` or ``</turn`` gets a backslash behind its ``<``, and
one more if backslashes stand there already; roles are URL-encoded. So control
strings are only those of the template, and ``read_turns`` gives every text back.

Defined results: a null role or text is empty. Null turns come first, rows of
one turn go by role, then text; repeated rows are turns of their own. Null ids
are one conversation. A system turn is one that comes first and has the role
``system``; one longer than the budget leaves a quarter of it for new turns.
Other columns are ignored, whatever their names. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from threadloom.llm.base import query, table, written

BUDGET = 1024
HISTORY = 256
#: longer conversations are dealt out by turns
LONG_BYTES = 8 << 20
#: slots of such a conversation that lie together
CHUNK_SLOTS = 1024
#: turns whose digest pieces are joined before those of a conversation
GROUP_TURNS = 4096

KEYS = ("no_id", "cid")
CONTROL = r"<(\\*)(/?turn)"
ESCAPED = r"<\\(\\*)(/?turn)"


def approximate_tokens(text: Column) -> Column:
    """A token for every four bytes, and four for the marks of a turn."""
    return F.ceil(F.octet_length(text) / 4).cast("bigint") + 4


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"<\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "<$1$2")


def _turns(rows: DataFrame, tokens: Callable[[Column], Column]) -> DataFrame:
    conv_id = F.col("conv_id")
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    return rows.select(
        conv_id.isNull().alias("no_id"),
        F.coalesce(conv_id, F.lit(0).cast(rows.schema["conv_id"].dataType)).alias("cid"),
        "turn", role.alias("role"), text.alias("text"), tokens(text).alias("tokens"),
    )


ORDER = ("turn", "role", "text")
RUNNING = (Window.unboundedPreceding, Window.currentRow)


def _spans(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """capacity, slot width and whether a turn is a window of its own, from ``system_tokens``."""
    capacity = F.greatest(F.lit(budget - history) - F.col("system_tokens"), F.lit(budget // 4))
    wide = turns.withColumn("capacity", capacity)
    return wide.withColumns(
        {"width": F.expr("capacity - capacity div 4"), "alone": (F.col("tokens") > F.expr("capacity div 4")).cast("bigint")}
    )


def _system() -> Column:
    return (F.col("place") == 1) & (F.col("role") == "system")


def _numbered(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Places, prefix sums and windows of conversations that one task may hold."""
    ordered = Window.partitionBy(*KEYS).orderBy(*ORDER).rowsBetween(*RUNNING)
    placed = turns.withColumns(
        {"place": F.row_number().over(ordered).cast("bigint"), "start": F.sum("tokens").over(ordered) - F.col("tokens")}
    )
    first = F.first(F.when(_system(), F.col("tokens")).otherwise(F.lit(0))).over(ordered)
    spans = _spans(placed.withColumn("system_tokens", first), budget, history)
    return spans.withColumn("alone_before", F.sum("alone").over(ordered) - F.col("alone")).withColumns(
        {"slot": F.expr("start div width"), "chunk": F.lit(0).cast("bigint"), "guest": F.lit(False)}
    )


def _running(turns: DataFrame, column: str, out: str) -> DataFrame:
    """Sum of ``column`` over the turns before, across the parts of a conversation."""
    local = Window.partitionBy(*KEYS, "part").orderBy(*ORDER).rowsBetween(*RUNNING)
    totals = turns.groupBy(*KEYS, "part").agg(F.sum(column).alias("__total"))
    before = Window.partitionBy(*KEYS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*KEYS, "part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    summed = turns.withColumn(out, F.sum(column).over(local) - F.col(column)).join(offsets, [*KEYS, "part"])
    return summed.withColumn(out, F.col(out) + F.col("__offset")).drop("__offset")


def _numbered_long(turns: DataFrame, budget: int, history: int, chunk_slots: int) -> DataFrame:
    """The same of conversations dealt out by turns, with the guests each chunk needs."""
    ranged = turns.repartitionByRange(*KEYS, "turn", "role", F.substring("text", 1, 32))
    placed = written(ranged.withColumns({"part": F.spark_partition_id(), "__one": F.lit(1).cast("bigint")}), "long-turns")
    placed = _running(_running(placed, "__one", "place"), "tokens", "start")
    placed = written(placed.withColumn("place", F.col("place") + 1).drop("__one"), "placed-turns")
    systems = placed.where(_system())
    marked = placed.join(systems.select(*KEYS, F.col("tokens").alias("system_tokens")), [*KEYS], "left")
    spans = _running(_spans(marked.fillna(0, ["system_tokens"]), budget, history), "alone", "alone_before")
    spans = spans.withColumn("slot", F.expr("start div width")).withColumn("chunk", F.floor(F.col("slot") / chunk_slots)).drop("part")
    own = written(spans.withColumn("guest", F.lit(False)), "chunks")
    # the last chunk whose windows may repeat a turn; the system turn comes with the systems
    reach = F.expr(f"(start + {history}) div (width * {chunk_slots})")
    behind = own.where((reach > F.col("chunk")) & ~_system()).withColumn("chunk", F.explode(F.sequence(F.col("chunk") + 1, reach)))
    every = own.where("chunk > 0").select(*KEYS, F.col("chunk").alias("__chunk")).distinct()
    first = own.where(_system()).join(every, [*KEYS]).withColumn("chunk", F.col("__chunk")).drop("__chunk")
    return own.unionByName(behind.unionByName(first).withColumn("guest", F.lit(True)))


def _windows(numbered: DataFrame, history: int) -> DataFrame:
    """Windows from numbered turns: entries of each turn for its own window and those that repeat it."""
    head = F.concat(F.lit("<turn>"), F.url_encode("role"), F.lit("\n"))
    shown = numbered.select(
        *KEYS, "chunk", "guest", "place", "role", "start", "tokens", "slot", "alone_before", "alone",
        F.concat(head, escaped(F.col("text")), F.lit("</turn>\n")).alias("piece"), F.length(head).alias("head"),
    ).withColumn("name", F.struct("slot", (2 * F.col("alone_before") + F.col("alone")).alias("cut")))
    ordered = Window.partitionBy(*KEYS, "chunk").orderBy("start")
    opens = ~F.col("guest") & ~F.col("name").eqNullSafe(F.lag("name").over(ordered))
    entry = lambda new: F.struct(
        "place", F.lit(new).alias("new"), (F.lit(new) & (F.col("role") == "assistant")).alias("target"), "head", "tokens", "piece"
    )
    running = ordered.rowsBetween(*RUNNING)
    marked = shown.withColumns({"opens": opens, "system": F.first(F.when(_system(), entry(False)), ignorenulls=True).over(running)})
    after = ordered.rangeBetween(0, history)
    starts = F.collect_list(F.when(F.col("opens"), F.struct("start", "name"))).over(after)
    repeats = F.filter("starts", lambda s: s["start"] > F.col("start"))
    member = lambda name, given: F.struct(name.alias("name"), given.alias("turn"))
    again = F.when(_system(), F.array().cast("array<struct<start:bigint,name:struct<slot:bigint,cut:bigint>>>")).otherwise(repeats)
    nothing = F.slice(F.array(member(F.col("name"), entry(True))), 1, 0)
    members = F.concat(
        F.when(F.col("guest"), nothing).otherwise(F.array(member(F.col("name"), entry(True)))),
        F.transform(again, lambda s: member(s["name"], entry(False))),
        F.when(F.col("opens") & (F.col("place") > 1) & F.col("system").isNotNull(), F.array(member(F.col("name"), F.col("system")))).otherwise(nothing),
    )
    listed = marked.withColumn("starts", starts).select(*KEYS, "chunk", F.explode(members).alias("m"))
    grouped = listed.groupBy(*KEYS, "chunk", "m.name").agg(F.array_sort(F.collect_list("m.turn")).alias("turns"))
    spans = F.aggregate(
        "turns",
        F.expr("struct(0 as at, cast(array() as array<struct<start:int,end:int>>) as spans)"),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["piece"])).alias("at"),
            F.when(
                t["target"],
                F.array_append(acc["spans"], F.struct((acc["at"] + t["head"]).alias("start"), (acc["at"] + F.length(t["piece"]) - 8).alias("end"))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    new = F.filter("turns", lambda t: t["new"])
    return grouped.select(
        F.when(~F.col("no_id"), F.col("cid")).alias("conv_id"),
        new[0]["place"].alias("first_turn"),
        (F.size("turns") - F.size(new)).alias("n_repeated"),
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda acc, t: acc + t["tokens"]).alias("tokens"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"),
        spans.alias("loss"),
    )


def format_windows(
    rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Callable[[Column], Column] = approximate_tokens,
    long_bytes: int = LONG_BYTES, chunk_slots: int = CHUNK_SLOTS,
) -> DataFrame:
    """Windows of the conversations in ``rows`` (conv_id, turn, role, text).

    Columns: conv_id, first_turn (number of the first new turn, from 1),
    n_repeated (turns before the new ones that were shown already), tokens, text,
    and loss (start and end, in code points of the text, of the targets).
    """
    turns = _turns(rows, tokens)
    sizes = turns.groupBy(*KEYS).agg((F.sum(F.octet_length("text")) + 16 * F.count("*")).alias("bytes"))
    long_ids = written(sizes.where(F.col("bytes") > long_bytes).select(*KEYS), "long-conversations")
    if long_ids.isEmpty():
        return _windows(_numbered(turns, budget, history), history)
    short = _windows(_numbered(turns.join(long_ids, [*KEYS], "left_anti"), budget, history), history)
    dealt = _numbered_long(turns.join(long_ids, [*KEYS], "left_semi"), budget, history, chunk_slots)
    return short.unionByName(_windows(dealt, history))


def read_turns(windows: DataFrame) -> DataFrame:
    """``windows`` with the turns their texts hold: array of (role, text), in order."""
    pieces = F.filter(F.split("text", "</turn>\n", -1), lambda p: p != "")
    turn = lambda p: F.struct(
        F.url_decode(F.substring_index(p, "\n", 1).substr(F.lit(7), F.length(p))).alias("role"),
        unescaped(p.substr(F.locate("\n", p) + 1, F.length(p))).alias("text"),
    )
    return windows.withColumn("turns", F.transform(pieces, turn))


def read_targets(windows: DataFrame) -> DataFrame:
    """``windows`` with the texts under the loss mask: array of strings, in order."""
    target = lambda s: unescaped(F.col("text").substr(s["start"] + 1, s["end"] - s["start"]))
    return windows.withColumn("targets", F.transform("loss", target))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation: number and digest of its turns, characters and digest of its targets, formatted characters.

    Pieces are joined in two steps, so a conversation's last step reads a row per
    ``GROUP_TURNS`` turns. The digest itself is of one string: conversations
    beyond two gigabytes have none.
    """
    new = F.slice("turns", F.col("n_repeated") + 1, F.greatest(F.size("turns"), F.lit(1)))
    read = read_targets(read_turns(windows)).withColumn("new", new)
    pieces = read.select(
        "conv_id", "first_turn", F.floor(F.col("first_turn") / GROUP_TURNS).alias("part"),
        F.size("new").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("new", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("shown"),
        F.array_join("targets", "").alias("lost"),
        F.length("text").cast("bigint").alias("formatted_chars"),
    )
    joined = lambda key, name: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(key, name))), lambda s: s[name]), ""
    ).alias(name)
    for key, by in (("first_turn", ("conv_id", "part")), ("part", ("conv_id",))):
        sums = [F.sum(name).alias(name) for name in ("n_turns", "formatted_chars")]
        pieces = pieces.groupBy(*by).agg(*sums, joined(key, "shown"), joined(key, "lost"))
    return pieces.select(
        "conv_id", "n_turns", F.sha2(F.col("shown").cast("binary"), 256).alias("turns_sha256"),
        F.length("lost").cast("bigint").alias("loss_chars"), F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


TRICKY = r"\### Assistant: </turn> ok"

_SQL = rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'),
sized AS (
  SELECT *, CAST(ceil(strlen(text) / 4.0) AS BIGINT) + 4 AS tokens,
    6 + length(url_encode(role)) + 1 + length(text) + len(regexp_extract_all(text, '<\\*/?turn')) + 8 AS size
  FROM given),
placed AS (
  SELECT *, row_number() OVER o AS place, sum(tokens) OVER (o ROWS UNBOUNDED PRECEDING) - tokens AS start
  FROM sized WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
room AS (
  SELECT *, greatest({BUDGET - HISTORY} - coalesce(sum(CASE WHEN place = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0), {BUDGET // 4}) AS capacity
  FROM placed),
cut AS (
  SELECT *, start // (capacity - capacity // 4) AS slot, tokens > capacity // 4 AS alone,
    coalesce(sum(CAST(tokens > capacity // 4 AS BIGINT)) OVER (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2
      + CAST(tokens > capacity // 4 AS BIGINT) AS part
  FROM room),
shown AS (SELECT conv_id, slot, part, min(start) AS start, min(place) AS place, sum(size) AS size FROM cut GROUP BY ALL),
again AS (
  SELECT w.conv_id, sum(t.size) AS size FROM shown w JOIN cut t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.start < w.start
    AND (t.start >= w.start - {HISTORY} OR (t.place = 1 AND t.role = 'system'))
  GROUP BY 1),
formatted AS (SELECT conv_id, sum(size) AS size FROM (SELECT conv_id, size FROM shown UNION ALL SELECT conv_id, size FROM again) GROUP BY 1)
SELECT c.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(any_value(f.size) AS BIGINT) AS formatted_chars
FROM cut c JOIN formatted f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id"""


@query("op11_chat_windows", _SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings, formatted, written and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [F.struct(F.lit(turn).cast("bigint").alias("turn"), F.lit(role).alias("role"), F.lit(TRICKY).alias("text")) for turn, role in enumerate(("user", "assistant"))]
    extra = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.inline(F.array(*tricky)))
    return digests(written(format_windows(rows.unionByName(extra)), "chat"))
