"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from threadloom.llm import codes, decontaminate, disclosure, lines, neighbours, packing, similar, toxicity, url_rules, warc
from threadloom.llm.base import written
from threadloom.llm.components import components
from threadloom.session import scratch_path

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, component string, score string, "
    "rank string, hash string, kept_text string, spans string, words string, `a.b` string"
)


def frame(spark, rows):
    filled = [(doc_id, text, "en", "s", len(text or ""), *["x"] * 9) for doc_id, text in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    base = [sentence(rng, 120) for _ in range(4)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k in range(8):  # copies with a few words changed
        w = base[0].split()
        w[rng.randrange(len(w))] = f"new{k}"
        rows.append((100 + k, " ".join(w)))
    rows += [(20, base[1]), (20, base[1]), (21, base[1].upper()), (22, None), (23, ""), (24, "one two"), (25, "one  TWO"), (None, base[2])]
    rows += [(26, " \t\n"), (27, sentence(rng, 20_000)), (28, "a b c d e f"), (29, "a b c d e f g"), (30, "é " * 40)]
    return rows


def _shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _components(rows):
    sets = [_shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids and sets[i] else doc_id))
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) if not isinstance(v, str) else (True, 0, v) for v in r[:3]))


def test_similar_documents(spark, corpus):
    got = similar.similar_documents(frame(spark, corpus)).select("doc_id", "n_shingles", "component_id").collect()
    assert _sorted([tuple(r) for r in got]) == _sorted(_components(corpus))


def test_similar_documents_of_nothing(spark):
    assert similar.similar_documents(frame(spark, [])).count() == 0
    assert [tuple(r)[0::2] for r in similar.similar_documents(frame(spark, [(1, None)])).select("doc_id", "n_shingles", "component_id").collect()] == [(1, 1)]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, j) for j in range(101, 120)] + [(5, 5), (3, 2)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{j: 100 for j in range(100, 120)}}


def test_few_links_make_few_files(spark, tmp_path, monkeypatch):
    paths = []
    monkeypatch.setattr("threadloom.llm.base.scratch_path", lambda _, name: paths.append(tmp_path / f"{len(paths)}-{name}") or str(paths[-1]))
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint").repartition(16)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        labels = components(links)
        assert {r["component"] for r in labels.collect()} == {0} and labels.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(paths) > 2 and all(len(list(path.glob("part-*"))) <= 1 for path in paths)


def _line_runs(rows, min_words=50):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    split = {k: (rows[k][1].split("\n") if rows[k][1] is not None else []) for k in order}
    size = {k: [len([w for w in line.split() if w]) for line in split[k]] for k in order}
    gone = {k: set() for k in order}
    for n, k in enumerate(order):
        for m in order[: n + 1]:
            for i in range(len(split[k])):
                for j in range(len(split[m])):
                    if (m == k and j >= i) or split[k][i] != split[m][j]:
                        continue
                    end = 0
                    while i + end < len(split[k]) and j + end < len(split[m]) and split[k][i + end] == split[m][j + end]:
                        end += 1
                    if sum(size[k][i : i + end]) >= min_words:
                        gone[k].update(range(i, i + end))
    return {k: "\n".join(x for i, x in enumerate(split[k]) if i not in gone[k]) if rows[k][1] is not None else None for k in order}


def test_dedup_lines(spark):
    rng = random.Random(4)
    pool = [sentence(rng, n) for n in (3, 10, 20, 30, 55, 1)] + ["", "same"]
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randint(1, 9)))) for k in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (None, rows[3][1]), (60, "\n".join(["r " * 20] * 6))]
    got = lines.dedup_lines(frame(spark, rows), output=("clean", "n", "runs"))
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and "kept_text" in got.columns
    wanted = _line_runs(rows)
    found = {(r["doc_id"], r["text"]): r["clean"] for r in got.collect()}
    assert found == {(rows[k][0], rows[k][1]): t for k, t in wanted.items()}


def test_dedup_lines_of_nothing_and_of_copies(spark):
    assert lines.dedup_lines(frame(spark, [])).select("doc_id").count() == 0
    text = sentence(random.Random(1), 60)
    got = sorted(r["text"] == r["clean"] for r in lines.dedup_lines(frame(spark, [(1, text)] * 3), output=("clean", "n", "runs")).select("text", "clean").collect())
    assert got == [False, False, True]


def thue_morse(n):
    return [bin(k).count("1") & 1 for k in range(n)]


def test_lines_of_one_polynomial_hash_are_two_lines(spark):
    """Thue-Morse words and their complement agree modulo 2^64; neither text may lose a line."""
    pair = [" ".join("ab"[b ^ flip] for b in thue_morse(512)) for flip in (0, 1)]
    got = {r["doc_id"]: (r["clean"], r["n"]) for r in lines.dedup_lines(frame(spark, [(1, pair[0]), (2, pair[1])]), output=("clean", "n", "runs")).collect()}
    assert got == {1: (pair[0], 0), 2: (pair[1], 0)}


def test_span_hashes():
    from threadloom.llm import words

    rng = np.random.default_rng(7)
    parts = [bytes(rng.integers(97, 99, rng.integers(1, 90)).astype(np.uint8)) for _ in range(3000)]
    parts += [bytes(97 + (b ^ flip) for b in thue_morse(n)) for n in (32, 64, 2048) for flip in (0, 1)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    hashes = words.span_hashes(data, ends - [len(p) for p in parts], ends).tolist()
    assert len(set(zip(parts, hashes))) == len(set(hashes)) == len(set(parts))


def test_ids_of_texts_with_special_tokens():
    from threadloom.llm.tokens import Encoder

    texts = ["<|endoftext|> hi", "a b<|endoftext|>c. d", "<|ENDOFTEXT|> x", "<|startoftext|>", "two  <|endoftext|>\n y", "plain words, here", None, ""]
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        plain = Tokenizer.from_file(public_tokenizers.path(name))
        got = Encoder(public_tokenizers.path(name), spaced).encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_contamination(spark):
    rng = random.Random(8)
    item = sentence(rng, 30)
    w = item.split()
    documents = [
        (1, f"{sentence(rng, 40)} {' '.join(w[3:14]).upper()}. {sentence(rng, 9)}"), (2, " ".join(w[:9])), (3, None), (4, ""),
        (5, "zz Short-item here"), (6, "short item"), (6, "short item"), (None, item), (7, item + " " + item), (8, sentence(rng, 20_000) + " " + item),
    ]
    bench = spark.createDataFrame([(1, item), (1, item), (2, "short ITEM"), (3, None), (4, ""), (None, "short item"), (None, "solo nameless"), (5, sentence(rng, 12))], "item_id bigint, text string")
    documents.append((9, "a solo nameless b"))
    found = decontaminate.contamination(frame(spark, documents), bench).collect()
    got = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["items"]) for r in found}
    assert {r["doc_id"] for r in found if r["unnamed"]} == {5, 6, 9}
    assert got == {
        (1, 60): (11, ["1"]), (2, 9): (0, []), (3, 0): (0, []), (4, 0): (0, []), (5, 4): (2, ["2"]), (6, 2): (2, ["2"]),
        (None, 30): (30, ["1"]), (7, 60): (60, ["1"]), (8, 20_030): (30, ["1"]), (9, 4): (2, []),
    }
    empty = bench.where("false")
    assert decontaminate.contamination(frame(spark, documents), empty).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(frame(spark, []), bench).count() == 0


def test_token_codes(spark, corpus):
    path = public_tokenizers.path("word_bpe_49k.json")
    files = codes.write_codes(frame(spark, corpus), scratch_path(spark, "codes"), path, end_id=1, spaced=False, file_tokens=500)
    got = codes.summaries(written(files, "files")).orderBy("start").collect()
    plain = Tokenizer.from_file(path)
    ordered = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r["doc_id"] for r in got] == [d for d, _ in ordered]
    start = 0
    for r, (_, text) in zip(got, ordered):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    none = codes.write_codes(frame(spark, []), scratch_path(spark, "codes"), path, end_id=1, spaced=False)
    assert codes.summaries(none).count() == 0


def test_packing(spark, corpus):
    got = packing.pack_documents(frame(spark, corpus), capacity=128).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {(d, t): plain.encode(t or "", add_special_tokens=False).ids + [0] for d, t in corpus}
    assert sum(r["length"] for r in got) == sum(len(ids[row]) for row in corpus)
    places: dict = {}
    for r in got:
        assert any(zlib.crc32(np.array(ids[row][r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for row in corpus if row[0] == r["doc_id"])
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 128
    assert packing.pack_documents(frame(spark, [])).count() == 0


def test_multi_index(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 6))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(400 + i, points[5].tolist()) for i in range(60)] + [(20, points[20].tolist())]
    bad = [(700, None), (720, [0.0] * 6), (740, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (760, [float("nan")] * 6), (780, [float("inf")] * 6), (None, [1.0] * 6), (800, [1.0] * 5), (820, [])]
    table = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x"))
    got = neighbours.search(table, "vec_id % 20 = 0", 20, vector="embedding").toPandas()
    whole = {}
    for i, p in rows:
        whole[i] = np.array(p)
    assert set(got["query_id"]) == {i for i in whole if i % 20 == 0}
    hit = total = 0
    for q, part in got.groupby("query_id"):
        true = sorted(((-(whole[q] * v).sum(), i) for i, v in whole.items() if i != q))[:20]
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21)) and q not in set(part["vec_id"])
        assert np.allclose(part["score"], [(whole[q] * whole[i]).sum() for i in part["vec_id"]], rtol=0, atol=1e-14)
        hit += len({i for _, i in true} & set(part["vec_id"]))
        total += 20
    assert hit / total >= 0.9
    few = neighbours.search(table.where("vec_id in (0, 1, 2)"), "vec_id % 20 = 0", 20, vector="embedding").collect()
    assert [r["rank"] for r in few] == [1, 2]
    assert neighbours.search(table.where("vec_id > 690"), "vec_id % 20 = 0", 20, vector="embedding").where("query_id < 700").count() == 0
    assert neighbours.search(table.where("false"), "vec_id % 20 = 0", 20, vector="embedding").count() == 0


def test_multi_index_of_repeated_rows(spark):
    """The other ids of a shared vector stay, however often one of them is repeated."""
    near, far = [1.0, 0.5, 0.0, 2.0], [0.1, 0.0, 0.0, 0.1]
    rows = [(1, near)] * 40 + [(i, near) for i in range(2, 41) for _ in range(2)] + [(100 + i, [x + i / 1000 for x in far]) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = neighbours.search(table, "vec_id in (1, 20, 40)", 20, vector="embedding").collect()
    for q in (1, 20, 40):
        part = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert part == list(enumerate([i for i in range(1, 41) if i != q][:20], 1))


def test_multi_index_of_ties(spark, monkeypatch):
    """Far more different vectors tie at the cut than there are places: of those met (here all) the smaller ids win."""
    fitted = neighbours.fit

    def everything(*given):
        index = fitted(*given)
        index.share = 1.0
        return index

    monkeypatch.setattr(neighbours, "fit", everything)
    rng = np.random.default_rng(12)
    rows = [(0, [1.0] * 8)] + [(1 + i, np.where(rng.permutation(8) < 4, 1.0, 0.0).tolist()) for i in range(400)]
    rows = [(0, rows[0][1])] + [(500 - i, v) for i, (_, v) in enumerate(rows[1:])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = neighbours.search(table, "vec_id = 0", 20, vector="embedding").orderBy("rank").collect()
    wanted = sorted(i for i, _ in rows[1:])[:20]
    assert [r["score"] for r in got] == [4.0] * 20
    assert [r["vec_id"] for r in got] == wanted


def test_words_beside_a_mention_of_any_length():
    spans = [("email", 1015, 1030)]
    text = " ".join("abcdefghij"[k] * 100 for k in range(10)) + "     " + "ann@mail.example" + "".join(" " + "klmnopqrst"[k] * 200 for k in range(10))
    spans = [("email", text.index("ann@"), text.index("ann@") + 16)]
    near = disclosure._Words(text, spans).near(*spans[0][1:])
    assert [w[0] for w in near] == list("cdefghij") + list("klmnopqr") and {len(w) for w in near} == {100, 200}


def test_masking_covers_overlapping_spans(spark):
    texts = ["4111111111111111john@mail.example x", "+14155550123@mail.example", "a@b.c d"]
    docs = frame(spark, list(enumerate(texts)))
    clean = {r["doc_id"]: r["clean_text"] for r in disclosure.sanitise(docs).collect()}
    assert clean == {0: "[email] x", 1: "[email]", 2: "[email] d"}


def test_a_very_long_url(spark):
    host, path = ".".join(["a"] * 3000 + ["example", "com"]), "/de" + "/x" * 4000
    pages = spark.createDataFrame([(1, f"http://{host}{path}"), (2, f"http://{host}/en{path}")], "page_id bigint, url string")
    rules = spark.createDataFrame([("example.com", "/de/", "block"), ("com", "/e", "block"), ("a.b.c.d", "/q/r/", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"], r["path"]) for r in url_rules.judge(pages, rules, ["page_id"]).collect()}
    assert got == {1: ("example.com/de/", "block", path), 2: ("com/e", "block", "/en" + path)}


def test_disclosure(spark):
    rng = random.Random(6)
    rows = [(k, f"{sentence(rng, 30)} zanzibel {'xyzzyq' if k % 2 else ''} wrote from ann@mail.example {sentence(rng, 30)}") for k in range(6)]
    rows += [(10 + k, sentence(rng, 50)) for k in range(60)] + [(100, "only Zanzibel here"), (101, None), (102, ""), (103, rows[0][1])]
    got = disclosure.find_all(frame(spark, rows))
    found = {r["doc_id"]: r for r in got.collect()}
    texts = dict(rows)
    assert len(found[0]["spans"]) == 1 and found[101]["spans"] == [] and found[102]["terms"] == []
    named = lambda d: {texts[d][t["start"] : t["end"]].lower() for t in found[d]["terms"]}
    assert "zanzibel" in named(100) and "zanzibel" in named(0) and named(103) == named(0)
    assert "only" not in named(100) and not named(15)
    clean = {r["doc_id"]: r["clean_text"] for r in disclosure.sanitise(frame(spark, rows)).collect()}
    assert "ann@" not in clean[0] and "[email]" in clean[0] and "zanzibel" not in clean[100].lower() and clean[101] is None and clean[15] == texts[15]
    assert disclosure.find_all(frame(spark, [])).count() == 0


def test_disclosure_beside_repeated_wording(spark):
    """One signature line under many different texts; copies of a whole text count once."""
    rng = random.Random(16)
    line = "\n-- \nregards quenzia your helpful friend at the desk quenzia@mail.example or write back here soon to all of us"
    rows = [(k, sentence(rng, 40) + line) for k in range(30)] + [(40 + k, sentence(rng, 40)) for k in range(400)]
    rows += [(500, "quenzia was seen"), (501, "the desk")] + [(600 + k, f"the helpful friend of all {sentence(rng, 9)}") for k in range(200)]
    copied = f"{sentence(rng, 20)} murkwold bob@mail.example"
    rows += [(900 + k, copied) for k in range(9)]
    texts = dict(rows)
    got = {r["doc_id"]: {texts[r["doc_id"]][t["start"] : t["end"]] for t in r["terms"]} for r in disclosure.find_all(frame(spark, rows)).collect()}
    assert got[500] == {"quenzia"} and "quenzia" in got[0]
    assert not got[600] and "friend" not in got[0] and not got[900]


def test_toxicity(spark):
    rng = random.Random(9)
    rows = [(k, sentence(rng, 60) + (" vilewretch " if k % 4 == 0 else " ") + sentence(rng, 60)) for k in range(400)]
    rows += [(500, None), (501, ""), (None, "x"), (502, "vilewretch " * 5), (502, "vilewretch " * 5)]
    documents = frame(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(300)] + [(None, 1), (5, None), (900, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit_on(documents, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents, model).collect()}
    fresh = range(300, 400)
    assert np.mean([(got[k] >= 0.5) == (k % 4 == 0) for k in fresh]) >= 0.95
    assert got[500] == got[501] and 0 <= got[500] < 0.5 and got[502] >= 0.5
    one = toxicity.fit_on(documents, labels.where("toxic = 1"))
    assert min(r["score"] for r in toxicity.score(documents, one).collect()) > 0.99
    none = toxicity.fit_on(documents, labels.where("false"))
    assert max(r["score"] for r in toxicity.score(documents, none).collect()) < 0.01
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_toxicity_of_rarer_wording(spark):
    """Rarer toxic n-grams count however many others rank before them."""
    rng = random.Random(19)
    block = "".join(chr(0x4E00 + rng.randrange(20_000)) for _ in range(12_000))  # some 36 000 n-grams
    rows = [(k, sentence(rng, 20) + (" vilewretch" if k % 3 == 0 else block)) for k in range(60)]
    rows += [(100 + k, sentence(rng, 20)) for k in range(60)] + [(200, "vilewretch"), (201, "")]
    labels = spark.createDataFrame([(k, int(k < 60)) for k, _ in rows[:120]], "doc_id bigint, toxic int")
    documents = frame(spark, rows)
    model = toxicity.fit_on(documents, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents, model).collect()}
    assert len(model.buckets) > 1 << 15 and got[200] > got[201]


def test_warc(spark):
    big = "".join(random.Random(3).choices("abcdé<>\r\n", k=40_000))
    rows = [(3, "http://a/", big), (1, "http://b/\r\nX: y", big), (2, None, None), (4, "u", ""), (5, "u", "s" * 99), (6, "u", "s" * 99), (None, "u", big), (7, "u", "t" * 100), (7, "u", "t" * 100), (8, "u", "t" * 100)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, digest string").repartition(3)
    files = written(warc.write_archives(warc.assign_types(pages), scratch_path(spark, "warc"), file_bytes=2_000), "files")
    chunks = warc.read_archives(warc.spread(files), chunk_bytes=1_000).collect()
    bodies: dict = {}
    for c in sorted(chunks, key=lambda c: c["chunk_no"]):
        if c["record_type"] == "response":
            bodies.setdefault(c["record_id"], []).append(c)
    whole = bodies["<urn:page:1>"]
    raw = b"".join(c["data"] for c in whole)
    assert raw.decode() == big and max(len(c["data"]) for c in whole) <= 1_000 and len(whole) > 40
    for k in (0, 7, len(whole) - 1):
        part = b"".join(c["data"] for c in whole[: k + 1])
        assert whole[k]["digest_so_far"] == hashlib.sha256(part).hexdigest() and whole[k]["bytes_so_far"] == len(part)
    last = sorted((c["record_id"], c["record_type"], c["refers_to"], c["payload_bytes"]) for c in chunks if c["last"])
    n = len(big.encode())
    assert last == sorted(
        [
            ("<urn:page:1>", "response", None, n), ("<urn:page:3>", "revisit", "<urn:page:1>", n), ("<urn:page:null>", "revisit", "<urn:page:1>", n),
            ("<urn:page:2>", "response", None, 0), ("<urn:page:4>", "response", None, 0), ("<urn:page:5>", "response", None, 99), ("<urn:page:6>", "response", None, 99),
            ("<urn:page:7>", "response", None, 100), ("<urn:page:7>", "response", None, 100), ("<urn:page:8>", "revisit", "<urn:page:7>", 100),
        ],
        key=lambda r: r,
    )
    none = written(warc.write_archives(warc.assign_types(pages.where("false")), scratch_path(spark, "warc")), "files")
    assert warc.read_archives(warc.spread(none)).count() == 0


def test_url_rules(spark):
    urls = [None, "", "nothing", "http://", "HTTP://Blog.Example.COM/de/x?y#z", "http://example.com/de", "https://net", "https://net/", "http://a.net/en/", "http://a.example.net/en/q", "http://b.org/fr/", "http://xorg/fr/", "x://h//en/../", "http://é.net/", "a://b://c.net/"]
    pages = spark.createDataFrame([(k, u, "x", "x") for k, u in enumerate(urls + urls[-2:])], "page_id bigint, url string, host string, rule string")
    rules = url_rules.RULES + [("net", "/exact", "block"), ("h", "//en/../", "block"), ("h", "//en/../", "allow"), (None, "/", "block"), ("net", None, "block")]
    got = {r["page_id"]: r for r in url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), ["page_id"]).collect()}
    assert len(got) == len(urls) + 2
    for k, url in enumerate(urls):
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [r for r in rules if r[0] and r[1] and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
        r = got[k]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best and best[0] + best[1], best[2] if best else "allow"), url
    assert url_rules.judge(pages.where("false"), spark.createDataFrame(rules, "host string, path string, verdict string"), ["page_id"]).count() == 0


def test_pipeline_stages(spark, corpus, tmp_path):
    rng = random.Random(21)
    item = sentence(rng, 20)
    clean = [(200 + k, sentence(rng, 80)) for k in range(40)]
    toxic = [(300 + k, sentence(rng, 30) + " vilewretch " + sentence(rng, 30)) for k in range(30)]
    leak = [(400, sentence(rng, 40) + " " + item)]
    copies = [(401, clean[0][1]), (402, clean[1][1].replace(" ", "  ", 3)), (403, clean[2][1] + "\n" + sentence(rng, 60)), (404, None), (405, ""), (405, "")]
    documents = frame(spark, clean + toxic + leak + copies)
    root = str(tmp_path)
    documents.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(d, 0) for d, _ in clean] + [(d, 1) for d, _ in toxic], "doc_id bigint, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    docs = spark.read.parquet(f"{root}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, root), name)
        assert docs.columns == documents.columns
        kept[name] = sorted(r["doc_id"] for r in docs.collect())
    assert not set(kept["toxicity"]) & {d for d, _ in toxic} and set(kept["toxicity"]) >= {d for d, _ in clean}
    assert 401 not in kept["line_dedup"] and {403, 404, 405} <= set(kept["line_dedup"])
    assert 402 not in kept["near_duplicates"] and kept["near_duplicates"].count(405) == 2 and {d for d, _ in clean} <= set(kept["near_duplicates"])
    assert 400 not in kept["decontamination"] and {d for d, _ in clean} <= set(kept["decontamination"])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, root)
    assert sorted({r["doc_id"] for r in packed.collect()}) == sorted(set(kept["decontamination"]))


def test_folded_sketches_tell_large_sets_apart(spark):
    """The small sketches of large unrelated sets are full; folded wide ones tell them apart, and keep every similar pair."""
    from threadloom.llm import similar

    random = np.random.default_rng(5)
    for n in (1100, 3000, 9000):
        first, other = (np.unique(random.integers(0, 1 << 63, n).astype(np.uint64)) for _ in range(2))
        close = np.unique(np.concatenate([first[: len(first) * 9 // 10], other[: len(first) // 20]]))
        counts = np.array([len(first), len(close), len(other)])
        grams = np.concatenate([first, close, other])
        words, sizes = similar._wide_sketches(counts, grams)
        lists = [part.tolist() for part in np.split(words, np.cumsum(sizes)[:-1])]
        rows = [(k, int(counts[k]), lists[k]) for k in range(3)]
        table = spark.createDataFrame(rows, "k int, n bigint, wide array<bigint>").withColumn("folded", similar._folded(F.col("wide")))
        x, y = table.where("k = 0").alias("x"), table.where("k > 0").alias("y")
        told = x.crossJoin(y).select("y.k", similar._wide_close(F.col("x.n"), F.col("x.folded"), F.col("y.n"), F.col("y.folded")).alias("near"), F.size("y.folded").alias("words"))
        found = {r.k: (r.near, r.words) for r in told.collect()}
        assert found[1][0] and not found[2][0] and found[1][1] <= similar.FOLDED_WORDS


def test_stages_bound_their_batches(spark):
    """Also where a caller runs a stage by itself in a session of its own settings."""
    from threadloom.session import BATCH_BYTES

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(key)
    try:
        spark.conf.set(key, str(1 << 30))
        docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
        dict(corpus_pipeline.STAGES)["packing"](spark, docs, "")
        assert int(spark.conf.get(key)) == BATCH_BYTES
    finally:
        spark.conf.set(key, given)
