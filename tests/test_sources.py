from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions import models
from threadloom.plans import table_queries
from threadloom.sources import lines as ln, tables as tb
from threadloom.sources.collection import Collection
from threadloom.streaming.upsert import stream_parts, upsert_stream

GOOD = {"id": 1, "title": "t", "description": "d", "answers": [{"user_name": "u", "status": "s", "rating": 1.5, "text": "x"}]}


@pytest.mark.parametrize("suffix", ["", ".gz"])
def test_dump_lines(spark, tmp_path, suffix):
    import gzip

    lines = [
        json.dumps(GOOD),
        repr({**GOOD, "id": 2, "title": None}),
        json.dumps(GOOD)[:-3],
        "__import__('os').system('true')",
        "[1, 2]",
    ]
    path = str(tmp_path / f"dump.json{suffix}")
    opener = gzip.open if suffix else open
    with opener(path, "wt") as out:
        out.write("\n".join(lines) + "\n")
    parsed = ln.parse_lines(ln.read_lines(spark, path, 3))
    rows = {r.id: r for r in ln.threads(parsed).collect()}
    assert sorted(rows) == [1, 2]
    assert rows[2].title is None and rows[2].answers[0].rating == 1.5
    assert sorted(r.line for r in ln.rejects(parsed).collect()) == sorted(lines[2:])


def test_part_size(spark, tmp_path):
    path = str(tmp_path / "parts")
    ln.write_parts(spark.range(10).coalesce(1), path, rows_per_file=4)
    assert len(list((tmp_path / "parts").glob("*.parquet"))) == 3


def test_vector_dimension_is_checked(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1.0], {"a": 1.0})], "id long, dense array<float>, text_sparse map<string,double>")
    with pytest.raises(Exception, match="vector dimension"):
        tb.replace_collection(rows, str(tmp_path / "c"), dim=2)


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b"\nc, d'), (2, ""), (3, None)], "id long, text string")
    tb.write_csv(rows, str(tmp_path / "csv"))
    back = tb.read_csv(spark, str(tmp_path / "csv"), rows.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_ids_are_reused_only_with_the_right_count(spark, tmp_path):
    path, made = str(tmp_path / "ids"), []

    def make(n):
        made.append(n)
        return spark.range(n).select(F.col("id").alias("points"), F.lit("train").alias("cat"))

    tb.sampled_ids(spark, path, 5, lambda: make(5))
    assert tb.sampled_ids(spark, path, 5, lambda: make(5)).count() == 5
    assert tb.sampled_ids(spark, path, 7, lambda: make(7)).count() == 7
    assert made == [5, 7]


def test_hostile_and_mistyped_lines_are_rejected(spark):
    bad = ["{[1]: 2}", "{'a': b'x'}", "{'a': {1, 2}}", "{'x': 1j}", '{"id": "abc", "title": "t"}', '{"id": 1, "answers": "x"}', "{'id': 'abc', 'title': None}", "__import__('os')"]
    good = ["{'id': 5, 'title': None, 'answers': []}", '{"id": 6, "title": "t"}']
    parsed = ln.parse_lines(spark.createDataFrame([(x,) for x in bad + good], "line string"))
    found = {r.line: r for r in parsed.collect()}
    assert all(found[x].rejected and found[x].record is None for x in bad)
    assert [(found[x].rejected, found[x].record.id) for x in good] == [(False, 5), (False, 6)]


def test_zst_dump(spark, tmp_path):
    zstandard = pytest.importorskip("zstandard")
    lines = [f'{{"id": {k}, "title": "é {k}"}}' for k in range(500)]
    frames = [zstandard.compress(("\n".join(part) + "\n").encode()) for part in (lines[:300], lines[300:])]
    (tmp_path / "dump.zst").write_bytes(b"".join(frames))
    got = ln.threads(ln.parse_lines(ln.read_zst_lines(spark, str(tmp_path / "dump.zst"))))
    assert sorted((r.id, r.title) for r in got.collect()) == [(k, f"é {k}") for k in range(500)]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    store = Collection(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.upsert(spark.range(50).withColumn("v", F.lit("old")), "id")
    change = spark.createDataFrame([(3, "x", 1), (3, "y", 2), (3, "z", None), (60, "new", 1)], "id long, v string, seq int")
    store.upsert(change, "seq", source="s", batch=0)
    store.upsert(spark.range(4).withColumn("v", F.lit("other")), "id", source="t", batch=0)
    wanted = {**{k: "old" for k in range(50)}, **{k: "other" for k in range(4)}, 60: "new"}
    assert {r.id: r.v for r in store.read().collect()} == wanted
    files = {f for f in spark.read.parquet(str(tmp_path / "store")).inputFiles() if "_writer=w-s/" not in f}
    # a replay is written in its old place: later writers still win, other batches keep their files
    store.upsert(change, "seq", source="s", batch=0)
    assert {r.id: r.v for r in store.read().collect()} == wanted
    assert files == {f for f in spark.read.parquet(str(tmp_path / "store")).inputFiles() if "_writer=w-s/" not in f}
    store.upsert(change.where("seq = 1"), "seq", source="s", batch=1)
    assert {r.id: r.v for r in store.read().collect()} == {**wanted, 3: "x"}


def test_payload_columns_of_any_name(spark, tmp_path):
    store = Collection(spark, str(tmp_path / "store"))
    store.upsert(spark.createDataFrame([(1, "a", 5)], "id long, source string, batch int"), "id", source="123", batch=7)
    assert store.read().collect() == [(1, "a", 5)]


def test_a_step_that_runs_again_keeps_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "steps")
    for step, n in ((1, 3), (2, 2), (1, 3)):
        tb.append_generations(spark.range(n), path, step)
    assert sorted((r.step, r.id) for r in spark.read.parquet(path).collect()) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]


def test_python_words_outside_quotes(spark):
    cases = {
        "{'a': None, 'b': True, 'c': [False, None]}": "{'a': null, 'b': true, 'c': [false, null]}",
        "{'a': 'None, True', \"b\": \"it's None\", 'c': 'x\\'None', 'd': None}": "{'a': 'None, True', \"b\": \"it's None\", 'c': 'x\\'None', 'd': null}",
        "{'a': Nones, 'b': xNone}": "{'a': Nones, 'b': xnull}",
        "{'a': '\\x41'}": None,
        "None": "null",
        "": "",
        "{'a': '" + "w None " * 20_000 + "\\n" * 5_000 + "', 'b': True}": "{'a': '" + "w None " * 20_000 + "\\n" * 5_000 + "', 'b': true}",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "line string").select("line", ln.as_json(F.col("line")).alias("t")).collect()
    assert {r.line: r.t for r in rows} == cases


def test_literals_are_read_without_python_where_they_can_be(spark):
    lines = ["{'id': 1, 'title': None, 'description': 'it\\'s \"None\"', 'answers': []}", "{'id': 2, 'title': '\\x41'}", "{'id': 0x3, 'title': ('t')}"]
    parsed = ln.parse_lines(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert [(r.record.id, r.record.title, r.record.description) for r in parsed] == [(1, None, 'it\'s "None"'), (2, "A", None), (3, "t", None)]


def test_null_order_loses_and_null_fields_are_kept(spark, tmp_path):
    store = Collection(spark, str(tmp_path / "store"))
    schema = "id long, v string, seq int"
    store.upsert(spark.createDataFrame([(1, "old", 1), (2, "old", 1)], schema), "seq")
    store.upsert(spark.createDataFrame([(1, "new", None), (2, "a", None), (2, None, 0)], schema), "seq")
    assert {r.id: r.v for r in store.read().collect()} == {1: "new", 2: None}


def test_streams_into_a_filled_collection(spark, tmp_path):
    source = str(tmp_path / "in")
    store = Collection(spark, str(tmp_path / "store"))
    for value in ("x", "y"):
        store.upsert(spark.range(3).withColumn("v", F.lit(value)), "id")
    schema = spark.createDataFrame([], "id long, v string").schema
    for value, ids in (("a", 2), ("b", 1)):
        spark.range(ids).withColumn("v", F.lit(value)).coalesce(1).write.mode("append").parquet(source)
        arriving = stream_parts(spark, source, schema)
        upsert_stream(arriving, store, str(tmp_path / "state"), "id").awaitTermination()
    assert {r.id: r.v for r in store.read().collect()} == {0: "b", 1: "a", 2: "y"}
    # a second stream with its own checkpoint starts at batch 0 again and loses nothing
    other = str(tmp_path / "other")
    spark.createDataFrame([(7, "c")], schema).coalesce(1).write.parquet(other)
    upsert_stream(stream_parts(spark, other, schema), store, str(tmp_path / "state2"), "id").awaitTermination()
    assert {r.id: r.v for r in store.read().collect()} == {0: "b", 1: "a", 2: "y", 7: "c"}


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_of_one_file_or_many_streams_whole(spark, tmp_path, files):
    rows = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    if files == 1:  # the table as one file
        part = next((tmp_path / "documents.parquet").glob("part-*"))
        (tmp_path / "one").mkdir()
        (tmp_path / "one" / "documents.parquet").write_bytes(part.read_bytes())
    folder = str(tmp_path / "one" if files == 1 else tmp_path)
    found = {r["id"]: r["answer"] for r in table_queries.i1(spark, folder).collect()}
    assert found == {n: f"answer {n}" for n in range(40)}
    assert table_queries.i1_two_streams(spark, folder).where("question = 'second'").count() == 40


def test_encoder_reports_failures(spark):
    def broken():
        def call(texts):
            raise RuntimeError("down")

        return call

    row = spark.range(1).select(
        models.encode_column(F.lit("text"), broken, attempts=2, pause=0.0).alias("e")
    ).first().e
    assert row.dense is None and row.error == "RuntimeError: down"


def test_encoder_is_normalised(spark):
    row = spark.range(1).select(models.encode_column(F.lit("a b a")).alias("e")).first().e
    assert abs(sum(x * x for x in row.dense) - 1) < 1e-6
    assert row.lexical == {"a": 2.0, "b": 1.0}
    assert schemas.ENCODED.fieldNames() == ["dense", "lexical"]
