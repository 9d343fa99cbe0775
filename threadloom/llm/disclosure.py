"""Personal data: fixed patterns, and terms that disclose who is meant.

E-mail and IP addresses, card and telephone numbers are found by pattern; their
values are the protected entities. The corpus then tells which words give an
entity away. A word's disclosure of an entity is its pointwise mutual
information with the entity over the entity's own information content,
PMI(e; t) / IC(e): 1 when the word is only ever met beside the entity, 0 when
the two are independent. Entities, words and words beside an entity (among the
``NEAR`` words on either side of a mention) are all counted in distinct texts,
so copies of a text are no evidence, while equal wording in different texts is.
A word that ``SUPPORT`` texts have beside an entity and whose disclosure reaches
``GENERALISE`` is masked wherever it occurs, from ``REMOVE`` on it is taken out.

Mentions are few and their words small. Word frequencies are needed for words
beside mentions only: a filter of fixed size over them spares the rest of the
corpus from leaving the scan, an exact join follows. A second scan finds where
the disclosing words occur. Results depend on the text alone
and are joined back by its hash and length.

Offsets are code points, ends exclusive. Defined results: null and empty texts
have no spans. Repeated rows get equal results. Words overlapping a pattern's
span are left to it. With an empty table the result is empty. Other columns are
not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from threadloom.llm import words as W
from threadloom.llm.base import bitmap, in_bitmap, query, table, written

KINDS = ("email", "ip", "card", "phone")
NEAR, SUPPORT = 8, 3
GENERALISE, REMOVE = 0.8, 0.95

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_LETTERS = W.byte_class((97, 122), (128, 255))
_WORD = re.compile("[a-z\x80-\U0010ffff]+")
_ASCII_LOWER = {code: code + 32 for code in range(65, 91)}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """One search per @: the longest local part before it, the domain after it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at + 1)  # no local part reaches over this @
        at = text.find("@", done if domain else at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, by start, then kind."""
    found = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 3 or (len(p) == 3 and p <= "255") for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _NOT_DIGIT.sub('', value)}"


class _Words:
    """The words of a text that lie in no span, ASCII lower-cased, by their places."""

    def __init__(self, text: str, spans):
        low = text.translate(_ASCII_LOWER)
        blocked = sorted((start, end) for _, start, end in spans)
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.words: list[str] = []
        at, reach = 0, 0
        for m in _WORD.finditer(low):
            # spans that begin before the word's end, and how far they reach
            while at < len(blocked) and blocked[at][0] < m.end():
                reach = max(reach, blocked[at][1])
                at += 1
            if reach <= m.start():
                self.starts.append(m.start())
                self.ends.append(m.end())
                self.words.append(m[0])

    def near(self, start: int, end: int) -> list[str]:
        """``NEAR`` words before and after a mention, however long they are."""
        before, after = bisect_right(self.ends, start), bisect_left(self.starts, end)
        return self.words[max(0, before - NEAR) : before] + self.words[after : after + NEAR]


def _hashes(words: list[str]) -> list[int]:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return W.span_hashes(data, ends - [len(r) for r in raw], ends).view(np.int64).tolist() if raw else []


_FOUND = (
    "doc_id {kind}, text_hash bigint, text_length int, spans array<struct<kind:string, start:int, end:int>>, "
    "mentions array<struct<entity:string, terms:array<struct<term:bigint, word:string>>>>"
)


def find_base(rows: DataFrame) -> DataFrame:
    """Pattern spans of every row (doc_id, text_hash, text_length, text), and the words beside each of its entities, once."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    term = pa.struct([("term", pa.int64()), ("word", pa.string())])
    mention = pa.struct([("entity", pa.string()), ("terms", pa.list_(term))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_of: list = [[] for _ in range(batch.num_rows)]
            mentions_of: list = [[] for _ in range(batch.num_rows)]
            for row, data, offsets in W.slices(batch[3]):
                telling = np.flatnonzero(((data >= 48) & (data <= 57)) | (data == 64))
                for k in np.unique(np.searchsorted(offsets, telling, side="right") - 1).tolist():
                    text = data[offsets[k] : offsets[k + 1]].tobytes().decode()
                    spans = base_spans(text)
                    spans_of[row + k] = [{"kind": kind, "start": s, "end": e} for kind, s, e in spans]
                    beside: dict[str, dict[str, None]] = {}
                    words_of = _Words(text, spans) if spans else None
                    for kind, s, e in spans:
                        beside.setdefault(_entity(kind, text[s:e]), {}).update(dict.fromkeys(words_of.near(s, e)))
                    mentions_of[row + k] = [
                        {"entity": entity, "terms": [{"term": h, "word": w} for h, w in zip(_hashes(list(words)), words)]}
                        for entity, words in beside.items()
                    ]
            yield pa.RecordBatch.from_arrays(
                [batch[0], batch[1], batch[2], pa.array(spans_of, pa.list_(span)), pa.array(mentions_of, pa.list_(mention))],
                names=["doc_id", "text_hash", "text_length", "spans", "mentions"],
            )

    return rows.select("doc_id", "text_hash", "text_length", "text").mapInArrow(scan, _FOUND.format(kind=dict(rows.dtypes)["doc_id"]))


def _frequency(rows: DataFrame, found: DataFrame, terms: DataFrame) -> DataFrame:
    """term and its distinct texts, of the words that may be among ``terms``.

    Texts that stand there once are summed up where they are read; only those a
    filter takes for copies are sent with their words.
    """
    copied = found.groupBy("text_hash", "text_length").count().where("count > 1")
    shared = rows.sparkSession.sparkContext.broadcast((bitmap(terms, "term"), bitmap(copied, "text_hash")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, copies = (np.frombuffer(b, dtype=np.int64) for b in shared.value)
        for batch in batches:
            copy = in_bitmap(copies, batch[0].to_numpy().view(np.uint64))
            for row, data, offsets in W.slices(batch[2]):
                low = W.lower_ascii(data)
                starts, ends, owner = W.spans(low, offsets, _LETTERS)
                if not len(starts):
                    continue
                hashes = W.span_hashes(low, starts, ends)
                hit = in_bitmap(wanted, hashes)
                own, term = owner[hit] + row, hashes[hit]
                order = np.lexsort((term, own))
                own, term = own[order], term[order]
                new = np.ones(len(own), dtype=bool)
                new[1:] = (own[1:] != own[:-1]) | (term[1:] != term[:-1])
                own, term = own[new], term[new]
                among = copy[own]
                single, n = np.unique(term[~among], return_counts=True)
                sent = pa.array(own[among])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.nulls(len(single), pa.int64()), batch[0].take(sent)]),
                        pa.concat_arrays([pa.nulls(len(single), pa.int32()), batch[1].take(sent)]),
                        pa.array(np.concatenate([single, term[among]]).view(np.int64)),
                        pa.array(np.concatenate([n, np.ones(len(sent), dtype=np.int64)])),
                    ],
                    names=["text_hash", "text_length", "term", "n"],
                )

    counts = rows.select("text_hash", "text_length", "text").mapInArrow(scan, "text_hash bigint, text_length int, term bigint, n bigint")
    return (
        counts.groupBy("text_hash", "text_length", "term").agg(F.sum("n").alias("n"))
        .groupBy("term").agg(F.sum(F.when(F.col("text_hash").isNull(), F.col("n")).otherwise(1)).alias("texts"))
    )


def _occurrences(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """text_hash, text_length, term, start, end of the words that may be among ``terms``."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(terms, "term"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.int64)
        for batch in batches:
            for row, data, offsets in W.slices(batch[2]):
                low = W.lower_ascii(data)
                starts, ends, owner = W.spans(low, offsets, _LETTERS)
                hashes = W.span_hashes(low, starts, ends)
                hit = np.flatnonzero(in_bitmap(bits, hashes)) if len(hashes) else np.zeros(0, dtype=np.int64)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = points[offsets[owner[hit]]]
                own = pa.array(row + owner[hit])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch[0].take(own), batch[1].take(own), pa.array(hashes[hit].view(np.int64)),
                        pa.array((points[starts[hit]] - base).astype(np.int32)), pa.array((points[ends[hit]] - base).astype(np.int32)),
                    ],
                    names=["text_hash", "text_length", "term", "start", "end"],
                )

    return rows.select("text_hash", "text_length", "text").mapInArrow(
        scan, "text_hash bigint, text_length int, term bigint, start int, end int"
    ).join(terms.select("term").distinct(), "term", "left_semi")


def disclosing_terms(found: DataFrame, frequency: DataFrame, pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """term, word, disclosure (the largest over entities) of the terms that reach the threshold."""
    texts = found.select("text_hash", "text_length").distinct().count()
    joint = F.least(F.col("together"), F.col("texts"))
    pmi = F.log2(joint * F.lit(float(texts)) / (F.col("entity_texts") * F.col("texts")))
    content = F.log2(F.lit(float(texts)) / F.col("entity_texts"))
    return (
        pairs.join(entities, "entity").join(frequency, "term")
        .where(F.col("entity_texts") < texts)
        .withColumn("disclosure", pmi / content)
        .groupBy("term").agg(F.max("disclosure").alias("disclosure"), F.min("word").alias("word"))
        .where(F.col("disclosure") >= GENERALISE)
    )


def find_all(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", support: int = SUPPORT) -> DataFrame:
    """doc_id, text_hash, text_length, spans (patterns) and terms (start, end, removed) of every row."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"text_hash": F.xxhash64("text"), "text_length": F.length("text")})
    found = written(find_base(rows), "pattern-spans")
    # a text has each of its entities, and each word beside one, once
    distinct = found.where(F.size("mentions") > 0).select("text_hash", "text_length", "mentions").dropDuplicates(["text_hash", "text_length"])
    mentions = distinct.select(F.explode("mentions").alias("m")).select("m.*")
    entities = mentions.groupBy("entity").agg(F.count("*").alias("entity_texts")).where(F.col("entity_texts") >= support)
    pairs = written(
        mentions.select("entity", F.explode("terms").alias("t")).groupBy("entity", F.col("t.term").alias("term"))
        .agg(F.count("*").alias("together"), F.min("t.word").alias("word"))
        .where(F.col("together") >= support),
        "pairs",
    )
    frequency = _frequency(rows, found, pairs.select("term").distinct())
    telling = written(disclosing_terms(found, frequency, pairs, entities), "disclosing-terms")
    occurrences = _occurrences(rows, telling)
    terms = (
        occurrences.join(telling, "term")
        .select("text_hash", "text_length", F.struct("start", "end", (F.col("disclosure") >= REMOVE).alias("removed")).alias("span"))
        .groupBy("text_hash", "text_length").agg(F.array_sort(F.collect_set("span")).alias("terms"))
    )
    none = F.array().cast("array<struct<start:int, end:int, removed:boolean>>")
    free = F.filter(
        F.coalesce("terms", none),
        lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    return found.drop("mentions").join(terms, ["text_hash", "text_length"], "left").withColumn("terms", free)



def _sortable(kind: int, name: str, span):
    return F.struct(span["start"].alias("start"), F.lit(kind).alias("rank"), span["end"].alias("end"), F.lit(name).alias("kind"))


def span_text(patterns, terms=None):
    """kind:start:end of all spans, by start, then kind, comma-joined."""
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).cast("int")
    listed = F.transform(patterns, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    if terms is not None:
        more = F.transform(terms, lambda t: _sortable(len(KINDS) + 1, "term", t))
        listed = F.concat(listed, more)
    return F.array_join(F.transform(F.array_sort(listed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@F.udf(T.StringType())
def _masked(text, spans, terms):
    if text is None:
        return None
    marks = [(s["start"], s["end"], f"[{s['kind']}]") for s in spans] + [(t["start"], t["end"], "" if t["removed"] else "[term]") for t in terms]
    # spans that overlap are one, marked as the widest of them
    merged: list[list] = []
    for start, end, mark in sorted(marks):
        if merged and start < merged[-1][1]:
            last = merged[-1]
            if end - start > last[3]:
                last[2], last[3] = mark, end - start
            last[1] = max(last[1], end)
        else:
            merged.append([start, end, mark, end - start])
    out, at = [], 0
    for start, end, mark, _ in merged:
        out.extend((text[at:start], mark))
        at = end
    return "".join(out) + text[at:]


def sanitise(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``documents`` with clean_text: patterns and generalised terms masked, disclosing terms removed."""
    found = find_all(documents, doc_id, text).select("text_hash", "text_length", "spans", "terms").where(
        (F.size("spans") > 0) | (F.size("terms") > 0)
    ).dropDuplicates(["text_hash", "text_length"]).withColumnsRenamed({"text_hash": "found_hash", "text_length": "found_length", "spans": "found_spans", "terms": "found_terms"})
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    joined = documents.join(found, (F.xxhash64(own) == F.col("found_hash")) & (F.length(own) == F.col("found_length")), "left")
    clean = F.when(F.col("found_hash").isNull(), F.col(text)).otherwise(_masked(F.when(F.col("found_hash").isNotNull(), F.col(text)), "found_spans", "found_terms"))
    return joined.withColumn("clean_text", clean).drop("found_hash", "found_length", "found_spans", "found_terms")


@query("op3_disclosure")
def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_all(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in KINDS],
        F.sha2(span_text(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans"), F.col("terms")).alias("spans"),
        F.size("terms").cast("bigint").alias("n_term"),
    )
