"""Near duplicates: an exact Jaccard join of word shingles with PartEnum signatures.

Sizes are cut into bands. Within the instance of a band the shingle domain is
dealt into groups, each of two halves; a signature is the content of one half.
Two sets of the same instance with a Jaccard similarity of at least 0.8 differ
in at most ``k`` shingles, so fewer than ``k / 2 + 1`` groups hold two or more
of them, and any other group has a half on which both sets agree. A set goes
through the groups in order until it has seen that many groups with both halves
filled, and gives a signature for each filled half on its way: two similar sets
then share one. A set with too few such groups also gives each of its shingles
as a signature. A set near the lower edge of its band takes part in the
instance below, so pairs across an edge meet there. Sets of up to three
shingles can only be similar when they are equal.

Sets that are equal form a class. Signatures join classes; what remains after
two exact bounds (sizes, and the parity sketch: the bits in which two sketches
differ are at most the shingles in which the sets differ) is verified on the
sets themselves, which are written once for the classes that share one. Groups
of copies are never expanded into pairs: in rounds, every bucket of a signature
has an anchor, each class is compared with the closest (by the parity sketches) of
the anchors it meets, and links give components. Of buckets that hold the same
classes one is kept. Buckets of one component are done. When the
pairs across components are few for each member of the others, they are
compared one by one. No link between components is lost.

Words are lower-cased (A-Z) runs without ASCII white space, a shingle is five
of them, a text of fewer words has one shingle of all of them.
Defined results: null and empty texts have no shingles and link with nothing.
Repeated rows are copies. A null id is in a component like any other; a
component's id is its smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.llm import words as W
from threadloom.llm.base import bitmap, in_bitmap, query, table, tidy, written
from threadloom.llm.components import components

SHINGLE = 5
SKETCH_WORDS = 16
WIDE_FROM = 1024  # larger sets crowd the small sketch
FOLDED_WORDS = 64  # of a wide sketch that goes with every signature
FIRST_BAND = 4  # sets below this size are similar only when equal
ROUNDS = 16  # of anchors; whatever they leave is compared pair by pair
_GROUPS = 0.32  # groups of an instance for each shingle at the lower edge of its band
_U = np.uint64


def _shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, counts, shingles) of runs of texts: distinct shingle hashes, sorted within each text."""
    for row, data, offsets in W.slices(column):
        low = W.lower_ascii(data)
        starts, ends, owner = W.spans(low, offsets, W.NON_SPACE)
        hashes = W.span_hashes(low, starts, ends)
        grams, whole = W.gram_hashes(hashes, owner, SHINGLE)
        own = owner[: len(grams)][whole]
        grams = grams[whole]
        rows = len(offsets) - 1
        words = np.bincount(owner, minlength=rows)
        short = np.flatnonzero((words > 0) & (words < SHINGLE))
        if len(short):
            base = np.cumsum(words) - words
            whole_texts = np.zeros(len(short), dtype=np.uint64)
            for j in range(SHINGLE - 1):
                more = words[short] > j
                whole_texts[more] = W.mix(whole_texts[more] * _U(31) + hashes[base[short][more] + j] + _U(j + 1))
            grams, own = np.concatenate([grams, whole_texts]), np.concatenate([own, short])
        order = np.lexsort((grams, own))
        grams, own = grams[order], own[order]
        first = np.ones(len(grams), dtype=bool)
        first[1:] = (grams[1:] != grams[:-1]) | (own[1:] != own[:-1])
        grams, own = grams[first], own[first]
        yield row, np.bincount(own, minlength=rows), grams


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, dtype=np.uint64)


def _bands(size: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(size, FIRST_BAND) / FIRST_BAND)).astype(np.int64)


def _instance(counts: np.ndarray, grams: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set numbers, signatures) of sets in the instance of the given band each."""
    own = np.repeat(np.arange(len(counts)), counts)
    low = FIRST_BAND * (_U(1) << band.astype(np.uint64)).astype(np.int64)
    groups = np.maximum(1, np.ceil(low * _GROUPS)).astype(np.int64)
    salt = band.astype(np.uint64)[own] * _U(0x2545F4914F6CDD1D)
    dealt = W.mix(grams + salt)
    half = (dealt % (2 * groups.astype(np.uint64))[own]).astype(np.int64)
    order = np.lexsort((half, own))
    own, half, content = own[order], half[order], W.mix(dealt[order] ^ _U(0x9FB21C651E98DF25))
    edge = np.ones(len(own), dtype=bool)
    edge[1:] = (own[1:] != own[:-1]) | (half[1:] != half[:-1])
    at = np.flatnonzero(edge)
    sums, own_of, half_of = _sums(content, at), own[at], half[at]
    signature = W.mix(sums + band.astype(np.uint64)[own_of] * _U(0xD1342543DE82EF95) + half_of.astype(np.uint64) * _U(0xAF251AF3B0F025B5))
    # a group is rich when both of its halves are filled
    group_of = half_of >> 1
    rich = np.zeros(len(at), dtype=np.int64)
    rich[1:] = (own_of[1:] == own_of[:-1]) & (group_of[1:] == group_of[:-1])
    seen = np.cumsum(rich)
    sets_at = np.searchsorted(own_of, np.arange(len(counts)))
    base = np.where(sets_at > 0, seen[np.maximum(sets_at - 1, 0)], 0)
    before = seen - rich - base[own_of]  # rich groups finished before this half
    differ = (counts + (counts * 5) // 4) // 9
    wanted = differ // 2 + 1
    kept = before < wanted[own_of]
    total = np.zeros(len(counts), dtype=np.int64)
    np.maximum.at(total, own_of, seen - base[own_of])
    poor = total < wanted
    out_own, out = own_of[kept], signature[kept]
    lone = np.flatnonzero(poor[own])
    if len(lone):
        single = W.mix(content[lone] + band.astype(np.uint64)[own[lone]] * _U(0x8CB92BA72F3D8DD7) + _U(1))
        out_own, out = np.concatenate([out_own, own[lone]]), np.concatenate([out, single])
    return out_own, out


def signatures(counts: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set numbers, signatures), sorted by set."""
    begin = np.cumsum(counts) - counts
    big = np.flatnonzero(counts >= FIRST_BAND)
    band = _bands(counts)
    low = FIRST_BAND * 2**band
    below = big[(band[big] > 0) & (counts[big] * 4 < low[big] * 5)]
    owns, found = [], []
    for sets, bands in ((big, band[big]), (below, band[below] - 1)):
        if not len(sets):
            continue
        size = counts[sets]
        source = np.repeat(begin[sets] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        own, sig = _instance(size, grams[source], bands)
        owns.append(sets[own])
        found.append(sig)
    if not owns:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    own, sig = np.concatenate(owns), np.concatenate(found)
    order = np.argsort(own, kind="stable")
    return own[order], sig[order]


def _sketches(counts: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each of 1024 bits, as 16 words a set."""
    out = np.zeros((len(counts), SKETCH_WORDS * 64), dtype=np.uint8)
    own = np.repeat(np.arange(len(counts)), counts)
    slot = own * (SKETCH_WORDS * 64) + (W.mix(grams) >> _U(54)).astype(np.int64)
    odd = np.bincount(slot, minlength=out.size).astype(np.uint8) & 1
    return np.packbits(odd.reshape(out.shape), axis=1).view(np.int64)


def _wide_sketches(counts: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, words of each set): a parity sketch with a bit or more for each shingle of a large set."""
    sizes = np.zeros(len(counts), dtype=np.int64)
    begin = np.cumsum(counts) - counts
    found = []
    for k in np.flatnonzero(counts >= WIDE_FROM).tolist():
        bits = 1 << int(counts[k] - 1).bit_length()
        slot = (W.mix(grams[begin[k] : begin[k] + counts[k]]) & _U(bits - 1)).astype(np.int64)
        odd = np.bincount(slot, minlength=bits).astype(np.uint8) & 1
        found.append(np.packbits(odd).view(np.int64))
        sizes[k] = bits // 64
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64), sizes


def _class_hashes(counts: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Hash of the whole set; 0 for an empty one."""
    full = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint64)
    out[full] = W.mix(_sums(W.mix(grams ^ _U(0x1F83D9ABFB41BD6B)), (np.cumsum(counts) - counts)[full]))
    return out.view(np.int64)


_SET_SCHEMA = (
    "doc_id {kind}, row_hash bigint, n_shingles bigint, class bigint, "
    "sketch array<bigint>, wide array<bigint>, signatures array<bigint>"
)


def _list(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.view(np.int64)))


def set_table(rows: DataFrame) -> DataFrame:
    """Class, sketch and signatures of every row (doc_id, row_hash, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, counts, grams in _shingle_sets(batch[2]):
                n = len(counts)
                own, sig = signatures(counts, grams)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch[0].slice(row, n), batch[1].slice(row, n), pa.array(counts), pa.array(_class_hashes(counts, grams)),
                        _list(_sketches(counts, grams).ravel(), np.full(n, SKETCH_WORDS)), _list(*_wide_sketches(counts, grams)),
                        _list(sig, np.bincount(own, minlength=n)),
                    ],
                    names=["doc_id", "row_hash", "n_shingles", "class", "sketch", "wide", "signatures"],
                )

    return rows.mapInArrow(scan, _SET_SCHEMA.format(kind=dict(rows.dtypes)["doc_id"]))


def _differing(a: Column, b: Column) -> Column:
    differing = F.bit_count(a[0].bitwiseXOR(b[0]))
    for i in range(1, SKETCH_WORDS):
        differing = differing + F.bit_count(a[i].bitwiseXOR(b[i]))
    return differing


def _close(na: Column, a: Column, nb: Column, b: Column) -> Column:
    """Necessary for similarity 0.8; exact counts for the sizes, a bound for the content."""
    return (F.least(na, nb) * 5 >= F.greatest(na, nb) * 4) & (_differing(a, b) * 9 <= na + nb)


def _wide_close(na: Column, a: Column, nb: Column, b: Column) -> Column:
    """The same bound from the wide sketches, where both sets have one; the longer is folded first."""

    def folded(x: Column, other: Column) -> Column:
        half = F.size(other)
        both = F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > half, both).otherwise(x)

    apart = F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differing = F.aggregate(apart, F.lit(0), lambda total, x: total + x)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(True)).otherwise(differing * 9 <= na + nb)


def _folded(wide: Column) -> Column:
    """A wide sketch of at most ``FOLDED_WORDS`` words, by the parity of those that fall together."""
    parts = F.sequence(F.lit(0), F.floor(F.size(wide) / FOLDED_WORDS).cast("int") - 1)
    word = lambda i: F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, k: total.bitwiseXOR(F.get(wide, i + k * FOLDED_WORDS)))
    return F.when(F.size(wide) > FOLDED_WORDS, F.transform(F.sequence(F.lit(0), F.lit(FOLDED_WORDS - 1)), word)).otherwise(wide)


def _written_sets(rows: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """(class, shingles) of every class that shares a signature, made again from one text each and written once.

    A filter of fixed size over those texts' hashes spares the other texts. A few
    more pass it, and a class may be there twice: both do no harm where the sets
    are joined with pairs of classes, and no set is shuffled to prevent it.
    """
    asked = classes.join(members.select("class").distinct(), "class", "left_semi").select("rep")
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(asked, "rep"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.int64)
        seen: set[int] = set()  # a repeated row gives its set once in a task
        for batch in batches:
            hashes = batch[0].to_numpy(zero_copy_only=False)
            wanted = []
            for at in np.flatnonzero(in_bitmap(bits, hashes.view(np.uint64))).tolist():
                if hashes[at] not in seen:
                    seen.add(int(hashes[at]))
                    wanted.append(at)
            taken = batch.take(pa.array(wanted, pa.int32()))
            for row, counts, grams in _shingle_sets(taken[1]):
                yield pa.RecordBatch.from_arrays(
                    [taken[0].slice(row, len(counts)), pa.array(_class_hashes(counts, grams)), _list(grams, counts)], names=["rep", "class", "shingles"]
                )

    made = rows.select("row_hash", "text").mapInArrow(scan, "rep bigint, class bigint, shingles array<bigint>")
    found = written(made.where("class <> 0").select("class", "shingles"), "shingle-sets")
    shared.unpersist()
    return found


def _verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The written pairs (a, b) of classes whose sets are similar."""
    pairs = pairs.select("a", "b")
    firsts = sets.join(pairs.select(F.col("a").alias("class")).distinct(), "class", "left_semi")
    both = F.size(F.array_intersect("x", "y"))
    # a set that is there twice gives the same link twice
    return written(
        sets.select(F.col("class").alias("b"), F.col("shingles").alias("y")).join(pairs, "b")
        .join(firsts.select(F.col("class").alias("a"), F.col("shingles").alias("x")), "a")
        .where(both * 100 >= (F.size("x") + F.size("y") - both) * 80)
        .select("a", "b").distinct(),
        "links",
    )


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("class"))
    found = members.join(labels.withColumnRenamed("node", "class"), "class", "left")
    return found.withColumn("component", F.coalesce("component", "class"))


def similar_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row_hash (of id and text), n_shingles, component (null without shingles) and component_id of every row."""
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("row_hash"), F.col(text).cast("string").alias("text")
    )
    sets = written(set_table(rows.select("doc_id", "row_hash", "text")), "sets")
    full = sets.where("n_shingles > 0")
    classes = written(
        full.groupBy("class").agg(
            F.min("doc_id").alias("low_id"), F.min("row_hash").alias("rep"), F.count("*").alias("copies"),
            F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide"),
        ).withColumn("folded", _folded(F.col("wide"))),
        "classes",
    )
    total = sets.count()
    # classes with a ten-thousandth of the rows or more are at most ten thousand
    heavy = classes.where(F.col("copies") * 10_000 > total).where("copies > 1").select("class", F.col("rep").alias("heavy_rep"))
    signed = (
        full.where(F.size("signatures") > 0)
        .join(F.broadcast(heavy), "class", "left")
        .where("heavy_rep is null or heavy_rep = row_hash")
        .select(F.explode("signatures").alias("signature"), "class")
        .repartition("signature")
    )
    shared = (
        signed.groupBy("signature").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
        .select("signature")
    )
    members = written(signed.join(shared.hint("shuffle_hash"), "signature").distinct(), "members")
    # similar sets share many signatures: of buckets with the same classes one is enough
    alike = members.groupBy("signature").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("class")).alias("h"), F.bit_xor(F.xxhash64("class", F.lit("second"))).alias("second")
    )
    members = written(members.join(alike.groupBy("n", "h", "second").agg(F.min("signature").alias("signature")), "signature", "left_semi"), "buckets")
    tidy(documents.sparkSession)  # the signatures of all sets
    facts = classes.select("class", "n", "sketch", "folded")
    large = classes.where(F.size("wide") > 0).select("class", "n", "wide")

    def bounded(pairs: DataFrame) -> DataFrame:
        """The pairs that the small and folded sketches leave, and by how many bits their sketches differ."""
        side = lambda k: facts.select(F.col("class").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}"), F.col("folded").alias(f"f_{k}"))
        left = pairs.join(side("a"), "a").join(side("b"), "b").where(_close(F.col("n_a"), F.col("s_a"), F.col("n_b"), F.col("s_b")))
        return left.where(_wide_close(F.col("n_a"), F.col("f_a"), F.col("n_b"), F.col("f_b"))).select("a", "b", _differing(F.col("s_a"), F.col("s_b")).alias("bits"))

    def narrowed(pairs: DataFrame) -> DataFrame:
        """Of written pairs those that the wide sketches leave; only large sets have one."""
        side = lambda k: large.select(F.col("class").alias(k), F.col("n").alias(f"n_{k}"), F.col("wide").alias(f"w_{k}"))
        apart = (
            pairs.join(side("a"), "a").join(side("b"), "b")
            .where(~_wide_close(F.col("n_a"), F.col("w_a"), F.col("n_b"), F.col("w_b"))).select("a", "b")
        )
        return pairs.join(written(apart, "apart"), ["a", "b"], "left_anti")

    shingle_sets = _written_sets(rows, classes, members)
    links, labels, tested = None, None, None
    placed = members.withColumn("component", F.col("class"))  # every bucket has several components yet
    turn = 0
    while True:
        # another member is the anchor in every round, the same one in all buckets of a group
        rank = F.struct(F.xxhash64("class", F.lit(turn)).alias("turn"), "component", "class")
        anchor = placed.groupBy("signature").agg(F.min(rank).alias("anchor"))
        offered = (
            placed.join(anchor, "signature").where("component <> anchor.component")
            .select(F.col("anchor.class").alias("a"), F.col("class").alias("b")).distinct()
        )
        if tested is not None:
            offered = offered.join(tested, ["a", "b"], "left_anti")
        # of the anchors a class meets and may be similar to, the one whose sketch differs least
        offers = written(bounded(offered).groupBy("b").agg(F.min_by("a", F.struct("bits", "a")).alias("a")).select("a", "b"), "offers")
        found = _verified(shingle_sets, narrowed(offers))
        tested = offers if tested is None else tested.unionByName(offers)
        won = found.count()
        tidy(documents.sparkSession)
        turn += 1
        if not won:
            break
        links = found if links is None else links.unionByName(found)
        labels = written(components(links), "labels")
        relabelled = _labelled(placed.select("signature", "class"), labels)
        parts = relabelled.groupBy("signature", "component").agg(F.count("*").alias("n"))
        # buckets whose members are all of one component have nothing left to compare
        mixed = written(
            parts.groupBy("signature").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("square"), F.count("*").alias("parts"))
            .where("parts > 1"),
            "mixed",
        )
        placed = written(relabelled.join(mixed, "signature", "left_semi"), "placed")
        left = mixed.agg(F.sum("n").alias("members"), F.sum((F.col("n") * F.col("n") - F.col("square")) / 2).alias("pairs")).first()
        tidy(documents.sparkSession)
        # the pairs left are few for each member, or few classes meet an anchor that may be similar, or anchors join little more
        met = offers.count()
        if not left["members"] or left["pairs"] <= 4 * left["members"] or met * 2000 <= left["members"] or won * 50 <= met or turn == ROUNDS:
            break
    # what no anchor has joined: pairs across components within a bucket
    open_rows = written(placed.join(facts, "class"), "open-members")

    def crossing(x: DataFrame, y: DataFrame, also: Column) -> DataFrame:
        """Pairs of classes of different components that the sketches leave."""
        return (
            x.alias("x").join(
                y.alias("y"),
                (F.col("x.signature") == F.col("y.signature"))
                & (F.col("x.class") < F.col("y.class"))
                & (F.col("x.component") != F.col("y.component"))
                & _close(F.col("x.n"), F.col("x.sketch"), F.col("y.n"), F.col("y.sketch"))
                & also,
            )
            .select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
            .distinct()
        )

    plain, wide = open_rows.drop("folded"), open_rows.where(F.col("n") >= WIDE_FROM)
    # the small sketches of two large sets tell little
    pairs = crossing(plain, plain, (F.col("x.n") < WIDE_FROM) | (F.col("y.n") < WIDE_FROM)).unionByName(
        crossing(wide, wide, _wide_close(F.col("x.n"), F.col("x.folded"), F.col("y.n"), F.col("y.folded")))
    )
    pairs = pairs.join(tested, ["a", "b"], "left_anti").join(tested.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
    found = _verified(shingle_sets, written(narrowed(written(pairs, "near")), "crossing"))
    if not found.isEmpty():
        links = found if links is None else links.unionByName(found)
        labels = written(components(links), "labels")
    placed = _labelled(classes.select("class", "low_id"), labels)
    ids = placed.groupBy("component").agg(F.min("low_id").alias("component_id"))
    named = placed.select("class", "component").join(ids, "component").select("class", "component", "component_id")
    return sets.select("doc_id", "row_hash", "n_shingles", "class").join(named, "class", "left").select(
        "doc_id", "row_hash", "n_shingles", "component", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS k,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT k, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT k, count(*) AS n FROM s GROUP BY k
), p AS (
  SELECT a.k AS ka, b.k AS kb, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY 1, 2
), l AS (
  SELECT ka, kb FROM p JOIN n na ON na.k = ka JOIN n nb ON nb.k = kb WHERE 100 * c >= 80 * (na.n + nb.n - c)
), e AS (SELECT ka, kb FROM l UNION ALL SELECT kb, ka FROM l
), r(k, m) AS (
  SELECT k, k FROM n UNION SELECT e.kb, r.m FROM r JOIN e ON e.ka = r.k
), c AS (SELECT r.k, min(doc_id) AS component_id FROM r JOIN d ON d.k = r.m GROUP BY r.k)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, doc_id) AS component_id
FROM d LEFT JOIN n USING (k) LEFT JOIN c USING (k)
"""


@query("op6_ngram_jaccard", _SQL)
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
