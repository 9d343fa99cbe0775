"""Repair of conversation structure: the cheapest edits that make turns alternate.

A repaired conversation has role initials ``(s?(ua)+)?``. Each row is kept (0),
given the role user or assistant (1) or deleted (2, a must for blank rows and
for rows whose role and text came before); empty user or assistant rows are put
in anywhere (5); a row that stays truncated costs 5 more. Of the cheapest edit
lists the one with the ASCII-least letters (D, I, K, R) counts.

Method, run-length dynamic programming: a row is a symbol (role initial and
fault). Equal neighbouring symbols are one run; a symbol's transition is a 4x4
min-plus matrix over (nothing yet, after system, after user, after assistant),
and a run goes through its cached binary powers. Costs come from the end to the
start; the edits are unrolled from the start, halving the powers, so a run takes
memory in proportion to the logarithm of its length.

Spark's part: rows are ranged by (conversation, turn, role, start of the text)
and sorted inside their task, so a conversation of any size lies in neighbouring
tasks. A task cuts its rows into pieces of bounded size. A conversation that is
one piece inside a task is repaired there. The pieces of the others are linked
by small rows only: digests of the texts they hold (which rows repeat an earlier
piece), one matrix a piece (costs from the end), and the state each piece hands
to the next. The chain of a conversation is worked off by one task, with a few
numbers per piece of up to 4 096 rows.

Defined results: a null role or text is one space. Turns may be null (they come
first); rows of one turn go by role, then text. Null ids are one conversation.
Faults are blank (nothing but ASCII spaces), duplicate (role and text of an
earlier row) or truncated (the last character that is no space is none of
``.!?``); the first that holds counts. A role that starts with none of s, u, a
can only be changed or deleted. Other columns are ignored. A conversation
without rows has no piece; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm.base import query, table, written

PIECE_ROWS = 4096
PIECE_CHARS = 1 << 18
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
INF = 1 << 60

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: where an inserted row, or one with a new role, leads
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: cost of each state when the conversation ends: only nothing and assistant may end it
END = (0, 2 * INSERT, INSERT, 0)

Symbol = tuple[str, bool]
#: a blank or repeated row
DEAD: Symbol = ("d", False)
ALTERNATING = {("s", "u"), ("u", "a"), ("a", "u")}


def _choices(symbol: Symbol, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of one row, letters in ASCII order; insertions come before a row."""
    found = [("D", DELETE, state)]
    if symbol != DEAD:
        initial, cut = symbol
        after = {"s": SYSTEM if state == NOTHING else None, "u": USER if NEXT[state] == USER else None, "a": ASSISTANT if state == USER else None}.get(initial)
        if after is not None:
            found.append(("K", KEEP + TRUNCATED * cut, after))
        found.append(("R", REROLE + TRUNCATED * cut, NEXT[state]))
    return found


Matrix = tuple[tuple[int, ...], ...]


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product: cheapest way through both."""
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in STATES), INF) for j in STATES) for i in STATES)


def before(matrix: Matrix, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a step, from those behind it."""
    return tuple(min(min(matrix[i][k] + costs[k] for k in STATES), INF) for i in STATES)


IDENTITY: Matrix = tuple(tuple(0 if i == j else INF for j in STATES) for i in STATES)


@lru_cache(maxsize=None)  # nine symbols, as many powers as a piece has binary digits
def power(symbol: Symbol, exponent: int) -> Matrix:
    """Transition of ``2 ** exponent`` equal rows, with insertions before each."""
    if exponent:
        half = power(symbol, exponent - 1)
        return product(half, half)
    step = [[INF] * 4 for _ in STATES]
    for state in STATES:
        at, paid = state, 0
        for _ in range(3):  # two insertions bring any state to any other that can be reached
            for _, cost, after in _choices(symbol, at):
                step[state][after] = min(step[state][after], paid + cost)
            at, paid = NEXT[at], paid + INSERT
    return tuple(map(tuple, step))


def _digits(count: int) -> list[int]:
    return [j for j in range(count.bit_length() - 1, -1, -1) if count >> j & 1]


def run_lengths(symbols: list[Symbol]) -> list[tuple[Symbol, int]]:
    runs: list[list] = []
    for symbol in symbols:
        if runs and runs[-1][0] == symbol:
            runs[-1][1] += 1
        else:
            runs.append([symbol, 1])
    return [(symbol, count) for symbol, count in runs]


def costs_before(runs: list[tuple[Symbol, int]], costs: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs to go before the first run, between the runs, and behind the last."""
    out = [costs]
    for symbol, count in reversed(runs):
        for j in _digits(count):
            costs = before(power(symbol, j), costs)
        out.append(costs)
    return out[::-1]


def _row(symbol: Symbol, state: int, costs: tuple[int, ...], out: list[tuple[str, int]]) -> int:
    """Edits of one row (insertions before it too) whose letters are least among the cheapest."""
    here = before(power(symbol, 0), costs)
    while True:
        letters = [(letter, cost + costs[after], after) for letter, cost, after in _choices(symbol, state)]
        letters.append(("I", INSERT + here[NEXT[state]], NEXT[state]))
        letter, _, after = min(x for x in letters if x[1] == here[state])
        out.append((letter, after))
        state = after
        if letter != "I":
            return state


def _power(symbol: Symbol, exponent: int, state: int, costs: tuple[int, ...], out: list[tuple[str, int]]) -> int:
    if not exponent:
        return _row(symbol, state, costs, out)
    middle = before(power(symbol, exponent - 1), costs)
    state = _power(symbol, exponent - 1, state, middle, out)
    return _power(symbol, exponent - 1, state, costs, out)


def unroll(runs: list[tuple[Symbol, int]], state: int, costs: tuple[int, ...], last: bool) -> tuple[list[tuple[str, int]], int]:
    """(letter, state behind it) of all edits from ``state``, and the state they end in."""
    out: list[tuple[str, int]] = []
    behind = costs_before(runs, costs)[1:]
    for (symbol, count), tail in zip(runs, behind):
        digits = _digits(count)
        tails = [tail]
        for j in reversed(digits[1:]):
            tails.append(before(power(symbol, j), tails[-1]))
        for j, rest in zip(digits, reversed(tails)):
            state = _power(symbol, j, state, rest, out)
    while last and END[state]:
        state = NEXT[state]
        out.append(("I", state))
    return out, state


def digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def diagnose(rows: list[dict], seen: set[bytes]) -> tuple[list[Symbol], dict[str, int]]:
    """Symbols of a piece's rows and how often each fault is found; ``seen``: digests of earlier pieces."""
    symbols, counts, own = [], dict(blank=0, duplicate=0, truncated=0), set()
    for row in rows:
        role, text = row["role"], row["text"]
        bare = text.strip(SPACES)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not bare:
            counts["blank"] += 1
            symbols.append(DEAD)
        elif (role, text) in own or (seen and digest(role, text) in seen):
            counts["duplicate"] += 1
            symbols.append(DEAD)
        else:
            cut = bare[-1] not in ENDS
            counts["truncated"] += cut
            symbols.append((initial, cut))
        own.add((role, text))
    return symbols, counts


def repaired(
    rows: list[dict], seen: set[bytes], state: int = NOTHING, costs: tuple[int, ...] = END, last: bool = True,
    role_before: str | None = None, turn_before: int | None = None,
) -> dict:
    """Edits and counts of one piece, given the state before and the costs behind it."""
    symbols, counts = diagnose(rows, seen)
    letters, _ = unroll(run_lengths(symbols), state, costs, last)
    edits, cost, at = [], 0, 0
    for letter, after in letters:
        if letter == "I":
            edits.append({"edit": "I", "turn": None, "role": ROLE[after], "text": ""})
            cost += INSERT
            continue
        row, symbol = rows[at], symbols[at]
        at += 1
        edits.append({**row, "edit": letter, "role": ROLE[after] if letter == "R" else row["role"]})
        cost += {"D": DELETE, "K": KEEP, "R": REROLE}[letter] + (TRUNCATED if letter != "D" and symbol[1] else 0)
    illegal = gaps = 0
    for row in rows:
        initial = row["role"][:1]
        illegal += role_before is not None and (role_before, initial) not in ALTERNATING
        role_before = initial
        if row["turn"] is not None:
            if turn_before is not None and row["turn"] > turn_before:
                gaps += row["turn"] - turn_before - 1
            turn_before = row["turn"]
    return {"edits": edits, "gaps": gaps, **counts, "illegal": illegal, "cost": cost}


EDITS = "edits array<struct<edit:string,turn:bigint,role:string,text:string>>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_EDITS = pa.list_(pa.struct([("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
_COUNTS = [(name, pa.int64()) for name in COUNTS]


def _flushed(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of about four pieces' text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(e["text"]) + 40 for e in row["edits"] or ())
        if size >= 4 * PIECE_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _cut(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Pieces in order of (part, seq); those that are a whole conversation are repaired at once."""
    text = F.coalesce(F.col("text"), F.lit(" ")).alias("text")
    role = F.coalesce(F.col("role"), F.lit(" ")).alias("role")
    given = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role, text)
    id_type = given.schema["conv_id"].dataType
    placed = given.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    placed = placed.sortWithinPartitions("conv_id", "turn", "role", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def grouped() -> Iterator[tuple[object, list[dict], bool, bool]]:
            """(id, rows, begins here, ends here) of pieces."""
            held: list[dict] = []
            current, size, begins, any_row = None, 0, False, False
            for batch in batches:
                for row in batch.to_pylist():
                    conv_id = row.pop("conv_id")
                    changed = any_row and conv_id != current
                    if changed or len(held) >= piece_rows or size >= PIECE_CHARS:
                        yield current, held, begins, changed
                        # the first conversation of a task may have begun in an earlier one
                        held, size, begins = [], 0, changed
                    current, any_row = conv_id, True
                    held.append({"edit": None, **row})
                    size += len(row["text"])
            if held:
                yield current, held, begins, False

        def pieces() -> Iterator[dict]:
            for seq, (conv_id, held, begins, ends) in enumerate(grouped()):
                place = {"conv_id": conv_id, "part": part, "seq": seq, "whole": begins and ends}
                yield {**place, **repaired(held, set())} if begins and ends else {**place, "edits": held}

        yield from _flushed(pieces(), schema)

    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("conv_id", to_arrow_type(id_type)), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), ("edits", _EDITS), *_COUNTS])
    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    return placed.mapInArrow(cut, f"conv_id {id_type.simpleString()}, part int, seq int, whole boolean, {EDITS}, {counts}")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _with_seen(pieces: DataFrame) -> DataFrame:
    """``seen``: digests of rows of earlier pieces of the conversation that a piece holds again."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            found = sorted({digest(e["role"], e["text"]) for e in piece["edits"]})
            yield pa.RecordBatch.from_pydict({"part": pa.array([piece["part"]] * len(found), pa.int32()), "seq": pa.array([piece["seq"]] * len(found), pa.int32()), "digest": pa.array(found, pa.binary())})

    keys = pieces.select("part", "seq", "edits").mapInArrow(digests, "part int, seq int, digest binary")
    keys = keys.join(pieces.select("part", "seq", "conv_id"), ["part", "seq"])
    keys = written(keys.select("conv_id", "digest", F.struct("part", "seq").alias("place")), "digests")
    # a digest is there once a piece, so the groups are as large as a conversation has pieces
    first = keys.groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = keys.alias("k").join(
        first.alias("f"), F.col("k.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("k.digest") == F.col("f.digest")) & (F.col("place") > F.col("first"))
    )
    seen = again.groupBy("place.part", "place.seq").agg(F.collect_list("k.digest").alias("seen"))
    return written(pieces.select("conv_id", "part", "seq", "edits").join(seen, ["part", "seq"], "left"), "open")


def _seen(piece: dict) -> set[bytes]:
    return set(map(bytes, piece["seen"] or ()))


def _linked(pieces: DataFrame) -> DataFrame:
    """Repairs pieces whose conversations have more of them."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            rows = piece["edits"]
            matrix = IDENTITY
            for symbol, count in run_lengths(diagnose(rows, _seen(piece))[0]):
                for j in _digits(count):
                    matrix = product(matrix, power(symbol, j))
            turns = [row["turn"] for row in rows if row["turn"] is not None]
            yield pa.RecordBatch.from_pylist(
                [{"part": piece["part"], "seq": piece["seq"], "matrix": [x for line in matrix for x in line], "role": rows[-1]["role"][:1], "turn": turns[-1] if turns else None}],
                pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("matrix", pa.list_(pa.int64())), ("role", pa.string()), ("turn", pa.int64())]),
            )

    sums = pieces.select("part", "seq", "edits", "seen").mapInArrow(summarise, "part int, seq int, matrix array<bigint>, role string, turn bigint")
    sums = written(sums.join(pieces.select("part", "seq", "conv_id"), ["part", "seq"]), "matrices")

    def tails(group):
        """Costs behind each piece, from the end of its conversation."""
        group = group.sort_values(["part", "seq"], ascending=False)
        costs, found, roles, turns = END, [], [], []
        for flat in group["matrix"]:
            found.append(list(costs))
            costs = before(tuple(tuple(int(x) for x in flat[4 * i : 4 * i + 4]) for i in STATES), costs)
        roles = [*group["role"].iloc[1:], None]
        last_turn = None
        for value in group["turn"].iloc[:0:-1]:
            last_turn = value if value == value and value is not None else last_turn
            turns.append(last_turn)
        group = group.assign(costs=found, last=[k == 0 for k in range(len(found))], role_before=roles, turn_before=[*turns[::-1], None])
        group["turn_before"] = group["turn_before"].astype("Int64")
        return group[["part", "seq", "costs", "last", "role_before", "turn_before"]]

    ends = sums.groupBy("conv_id").applyInPandas(tails, "part int, seq int, costs array<bigint>, last boolean, role_before string, turn_before bigint")
    ends = written(ends, "tails")

    def hand_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            runs = run_lengths(diagnose(piece["edits"], _seen(piece))[0])
            costs = tuple(piece["costs"])
            left = costs_before(runs, costs)[0]
            out = [unroll(runs, state, costs, False)[1] if left[state] < INF else state for state in STATES]
            yield pa.RecordBatch.from_pydict({"part": pa.array([piece["part"]], pa.int32()), "seq": pa.array([piece["seq"]], pa.int32()), "leads": pa.array([out], pa.list_(pa.int32()))})

    known = pieces.join(ends, ["part", "seq"])
    leads = known.select("part", "seq", "edits", "seen", "costs").mapInArrow(hand_on, "part int, seq int, leads array<int>")
    leads = leads.join(sums.select("part", "seq", "conv_id"), ["part", "seq"])

    def enter(group):
        """State before each piece, from the start of its conversation."""
        group = group.sort_values(["part", "seq"])
        state, found = NOTHING, []
        for after in group["leads"]:
            found.append(state)
            state = int(after[state])
        return group.assign(state=found)[["part", "seq", "state"]]

    entries = written(leads.groupBy("conv_id").applyInPandas(enter, "part int, seq int, state int"), "entries")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> Iterator[dict]:
            for p in _pieces(batches):
                found = repaired(p["edits"], _seen(p), p["state"], tuple(p["costs"]), p["last"], p["role_before"], p["turn_before"])
                yield {"part": p["part"], "seq": p["seq"], **found}

        yield from _flushed(done(), pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("edits", _EDITS), *_COUNTS]))

    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    ready = known.join(entries, ["part", "seq"]).drop("conv_id")
    done = ready.mapInArrow(finish, f"part int, seq int, {EDITS}, {counts}")
    return done.join(sums.select("part", "seq", "conv_id"), ["part", "seq"])


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Pieces of repaired conversations, in order of (part, seq) within a conversation.

    Columns: conv_id, part, seq, whole (the piece is its whole conversation),
    edits (edit, turn, role, text of each row and insertion in order, deleted
    rows as they were) and the piece's share of gaps (missing turn numbers),
    blank, duplicate, truncated, illegal (neighbouring roles that do not
    alternate) and cost.
    """
    cut = written(_cut(rows, piece_rows), "pieces")
    columns = ("conv_id", "part", "seq", "whole", "edits", *COUNTS)
    linked = _linked(_with_seen(cut.where("not whole"))).withColumn("whole", F.lit(False))
    return cut.where("whole").select(*columns).unionByName(linked.select(*columns))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults by the checksum of ``conv_id:turn``; nulls are one space."""
    name = lambda column: F.coalesce(F.col(column).cast("string"), F.lit(" "))  # noqa: E731
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    given = rows.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("__kind"))
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("__kind") == 4, "user").otherwise(F.col("role"))
    left = given.where("__kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), "__kind")
    copies = F.explode(F.expr("if(__kind = 3, array(0, 1), array(0))"))
    return left.withColumn("__copy", copies).drop("__kind", "__copy")


def _streamed_digest(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the lines of each conversation, piece by piece.

    A digest is a chain, so one task reads a conversation's pieces in order; it
    holds one batch of them.
    """
    id_type = pieces.schema["conv_id"].dataType

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, started, any_row = None, hashlib.sha256(), False, False

        def result():
            return pa.RecordBatch.from_arrays([pa.array([current], batch.schema.field(0).type), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

        for batch in batches:
            for at in range(batch.num_rows):
                conv_id, lines = batch[0][at].as_py(), batch[1][at]
                if any_row and conv_id != current:
                    yield result()
                    state, started = hashlib.sha256(), False
                current, any_row = conv_id, True
                if lines.is_valid:
                    if started:
                        state.update(b"\n")
                    state.update(lines.as_buffer())
                    started = True
        if any_row:
            yield result()

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return ordered.select("conv_id", F.col("lines").cast("binary").alias("lines")).mapInArrow(chain, f"conv_id {id_type.simpleString()}, repaired_sha256 string")


def report(pieces: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per id in ``conversations``: counts, audit letters and the digest of the repaired lines."""
    kept = F.filter("edits", lambda e: e["edit"] != "D")
    lines = F.when(F.size(kept) > 0, F.array_join(F.transform(kept, lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n"))
    audit = F.array_join(F.transform("edits", lambda e: e["edit"]), "")
    flat = pieces.select("conv_id", "part", "seq", "whole", *COUNTS, audit.alias("audit"), lines.alias("lines"))
    sha = F.sha2(F.coalesce("lines", F.lit("")).cast("binary"), 256)
    single = flat.where("whole").select("conv_id", *COUNTS, "audit", sha.alias("repaired_sha256"))
    several = flat.where("not whole")
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))), lambda p: p["audit"]), "")
    sums = several.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in COUNTS], letters.alias("audit"))
    digests = _streamed_digest(several).withColumnRenamed("conv_id", "__id")
    chained = sums.join(digests, F.col("conv_id").eqNullSafe(F.col("__id"))).drop("__id")
    found = single.unionByName(chained).withColumnRenamed("conv_id", "__id")
    ids = conversations.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in COUNTS]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("__id")), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


def _nibble(n: int) -> int:
    """Checksum step of four bits (reversed CRC-32 polynomial)."""
    for _ in range(4):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


#: plain dynamic programming over rows and states; the checksum goes by half bytes
_SQL = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    flatten(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: [CAST(ascii(c) AS BIGINT) & 15, CAST(ascii(c) AS BIGINT) >> 4])) AS bits
  FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bits),
    lambda c, b: xor({[_nibble(n) for n in range(16)]}[(xor(c, b) & 15) + 1], c >> 4)), 4294967295) % 20 AS kind
  FROM given),
left_rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, (VALUES (0), (1)) v(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM left_rows),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM ordered),
inserts(a, b, paid, letters, put) AS (VALUES
  (0, 0, 0, '', CAST([] AS VARCHAR[])), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
  (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:'])),
moves(a, b, letter, initial, price, named) AS (VALUES
  (0, 0, 'D', NULL, 2, NULL), (1, 1, 'D', NULL, 2, NULL), (2, 2, 'D', NULL, 2, NULL), (3, 3, 'D', NULL, 2, NULL),
  (0, 1, 'K', 's', 0, NULL), (0, 2, 'K', 'u', 0, NULL), (1, 2, 'K', 'u', 0, NULL), (3, 2, 'K', 'u', 0, NULL), (2, 3, 'K', 'a', 0, NULL),
  (0, 2, 'R', NULL, 1, 'user'), (1, 2, 'R', NULL, 1, 'user'), (3, 2, 'R', NULL, 1, 'user'), (2, 3, 'R', NULL, 1, 'assistant')),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM (SELECT DISTINCT conv_id FROM faults)
  UNION ALL
  SELECT conv_id, n, state, cost, audit, lines FROM (
    SELECT f.conv_id, f.n, m.b AS state, p.cost + i.paid + m.price + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 5 ELSE 0 END AS cost,
      p.audit || i.letters || m.letter AS audit,
      list_concat(p.lines, i.put, CASE WHEN letter = 'D' THEN [] ELSE [coalesce(named, role) || ':' || text] END) AS lines
    FROM best p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.n + 1 JOIN inserts i ON i.a = p.state JOIN moves m ON m.a = i.b
    WHERE (letter = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (initial IS NULL OR initial = role[1]))
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
ended AS (
  SELECT conv_id, p.cost + i.paid AS cost, p.audit || i.letters AS audit, list_concat(p.lines, i.put) AS lines
  FROM best p JOIN inserts i ON i.a = p.state JOIN (SELECT conv_id AS c, max(n) AS last FROM faults GROUP BY 1) ON c IS NOT DISTINCT FROM conv_id AND last = n
  WHERE i.b IN (0, 3) QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY p.cost + i.paid, p.audit || i.letters) = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
    count_if(fault = 'truncated') AS truncated, count_if(before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY 1)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id"""


@query("op12_conversation_repair", _SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by checksum and repaired."""
    rows = table(spark, sf_dir, "conversations")
    pieces = written(repair(damaged(rows)), "repaired")
    return report(pieces, rows)
