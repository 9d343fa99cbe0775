"""Exact top-k joins against brute force, on both ways of running them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from threadloom.functions import models
from threadloom.operators import blocks, knn, postings

K = 4


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(90, 6)).round(3)
    vectors[30:60] = vectors[0]  # a third of all rows are copies of one
    vectors[7] = 0.0
    words = [f"w{i}" for i in range(12)]
    maps = []
    for i in range(90):
        chosen = rng.choice(12, size=rng.integers(0, 6), replace=False)
        maps.append({words[j]: float(rng.integers(1, 5)) for j in chosen})
    maps[30:60] = [dict(maps[0])] * 30
    return vectors.astype(np.float32), maps


@pytest.fixture(scope="module")
def points(spark, data):
    vectors, maps = data
    rows = [(i, [float(x) for x in v], m) for i, (v, m) in enumerate(zip(vectors, maps))]
    return spark.createDataFrame(
        rows, "id long, dense array<float>, text_sparse map<string,double>"
    ).repartition(5)


def cosine(a, b):
    scale = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / scale) if scale else 0.0


def dot(a, b):
    shared = a.keys() & b.keys()
    return sum(a[t] * b[t] for t in shared) if shared else None


def best(scores, k):
    kept = [(-round(s, 6), i) for i, s in scores.items() if s is not None]
    return [i for _, i in sorted(kept)[:k]]


def result(df):
    out = {}
    for row in df.collect():
        out.setdefault(row.qid, {})[row["rank"]] = row.id
    return {q: [r[i] for i in sorted(r)] for q, r in out.items()}


def expected(data, kind, k, pairs=None):
    vectors, maps = data
    v = vectors.astype(np.float64)
    out = {}
    for q in range(90):
        ids = range(90) if pairs is None else pairs[q]
        score = (lambda i: cosine(v[q], v[i])) if kind == "dense" else (lambda i: dot(maps[q], maps[i]))
        found = best({i: score(i) for i in ids}, k)
        if found:
            out[q] = found
    return out


@pytest.mark.parametrize("shipped", [True, False])
def test_dense_topk(monkeypatch, data, points, shipped):
    monkeypatch.setattr(knn, "QUERY_BLOCK", 40)
    monkeypatch.setattr(knn, "POINT_BLOCK", 25)
    monkeypatch.setattr(knn, "CELLS", 500)
    queries = points.withColumnRenamed("id", "qid")
    found = knn.dense_topk(queries, points, K, max_shipped=knn.MAX_SHIPPED_QUERIES if shipped else 0)
    assert result(found) == expected(data, "dense", K)


@pytest.mark.parametrize("piece_rows", [1_000_000, 7])
@pytest.mark.parametrize("probe", [0, 1, 8])
def test_sparse_topk(monkeypatch, tmp_path, data, points, piece_rows, probe):
    monkeypatch.setattr(postings, "PROBE", probe)
    index = postings.build_index(points, str(tmp_path), piece_rows=piece_rows)
    assert (index.terms.where("pieces > 1").count() > 0) == (piece_rows == 7)
    for worth in (0, postings.WORTH):
        found = postings.search(points.withColumnRenamed("id", "qid"), index, K, worth=worth)
        assert result(found) == expected(data, "sparse", K)
    assert result(postings.sparse_topk(points.withColumnRenamed("id", "qid"), points, K)) == expected(data, "sparse", K)


def test_long_lists_that_cannot_help_are_skipped(spark, tmp_path):
    """Learned-like weights: frequent terms weigh little, so their lists are looked up, not read."""
    rng = np.random.default_rng(8)
    maps = []
    for _ in range(3000):
        m = {f"c{j}": float(rng.integers(1, 4)) / 100 for j in rng.choice(8, 6, replace=False)}
        m |= {f"r{j}": float(rng.integers(100, 500)) / 100 for j in rng.choice(400, 3, replace=False)}
        maps.append(m)
    points = spark.createDataFrame(list(enumerate(maps)), "id long, text_sparse map<string,double>").repartition(4)
    queries = points.where("id < 60").withColumnRenamed("id", "qid")
    index = postings.build_index(points, str(tmp_path))
    asked = postings.known_terms(postings.entries(queries, "qid", "text_sparse", ("qid", "term", "asked")), index)
    plan = postings.planned_terms(asked, index, 5)
    work = plan.selectExpr("sum(if(skipped, rows, 0)) as skipped", "sum(if(skipped, 0, rows)) as read", "count_if(skipped and term like 'r%') as rare").first()
    # a rare term may be skipped too: two others of its query can outweigh it
    assert work["skipped"] > 20 * work["read"] and work["rare"] < 90
    got = result(postings.search(queries, index, 5, worth=0))
    for q in range(60):
        assert got[q] == best({i: dot(maps[q], maps[i]) for i in range(3000)}, 5)


def test_sparse_search_runs_no_python(spark, tmp_path, points):
    index = postings.build_index(points, str(tmp_path))
    plan = postings.search(points.withColumnRenamed("id", "qid"), index, K, worth=0)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_lexical_weights(spark):
    rng = np.random.default_rng(3)
    texts = [None, "", "  ", "one", "B b B a", *[" ".join(rng.choice(list("abcdE é"), 30)) for _ in range(20)]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", models.lexical_weights(F.col("t")).alias("w")).collect()
    for r in rows:
        words = [w for w in (r["t"] or "").lower().split(" ") if w]
        assert r["w"] == {w: float(words.count(w)) for w in words}


@pytest.mark.parametrize("kind", ["dense", "sparse"])
@pytest.mark.parametrize("shipped", [1000, 0])
def test_topk_among(spark, data, points, kind, shipped):
    rng = np.random.default_rng(9)
    pairs = {q: sorted(rng.choice(90, size=10, replace=False).tolist()) for q in range(90)}
    candidates = spark.createDataFrame([(q, i) for q in pairs for i in pairs[q]], "qid long, id long")
    vector = "dense" if kind == "dense" else "text_sparse"
    queries = points.withColumnRenamed("id", "qid")
    found = knn.topk_among(candidates, queries, points, K, kind, vector, max_shipped=shipped)
    assert result(found) == expected(data, kind, K, pairs)


def test_negative_and_zero_weights_still_share_a_term(spark):
    points = spark.createDataFrame(
        [(1, {"a": 0.0}), (2, {"a": -1.0, "b": 1.0}), (3, {"c": 2.0})],
        "id long, text_sparse map<string,double>",
    )
    queries = spark.createDataFrame([(9, {"a": 1.0, "b": 1.0})], "qid long, text_sparse map<string,double>")
    rows = postings.sparse_topk(queries, points, 5).collect()
    assert sorted((r.id, r.score) for r in rows) == [(1, 0.0), (2, 0.0)]


@pytest.mark.parametrize("work", [3, 2_000_000])
def test_large_query_sides_meet_points_in_blocks(monkeypatch, spark, tmp_path, data, points, work):
    """One-off and stored search give the same rows block by block; the plan shuffles no sums of pairs."""
    for name, value in {"BLOCK_ENTRIES": 60, "BLOCK_QUERIES": 25, "LEAST_ENTRIES": 40, "WORK": work}.items():
        monkeypatch.setattr(blocks, name, value)
    monkeypatch.setattr(knn, "CELLS", 300)
    monkeypatch.setattr(postings, "MANY_POSTINGS", 0)
    monkeypatch.setattr(postings, "MANY_ENTRIES", 0)
    queries = points.withColumnRenamed("id", "qid")
    index = postings.build_index(points, str(tmp_path), piece_rows=7)
    for found in (postings.sparse_topk(queries, points, K), postings.search(queries, index, K)):
        assert result(found) == expected(data, "sparse", K)
        assert "sum(part" not in found._jdf.queryExecution().toString()
    signed = spark.createDataFrame([(1, {"a": 0.0}), (2, {"a": -1.0, "b": 1.0}), (3, {"c": 2.0}), (4, None)], "id long, text_sparse map<string,double>")
    asked = spark.createDataFrame([(9, {"a": 1.0, "b": 1.0}), (8, None)], "qid long, text_sparse map<string,double>")
    rows = postings.sparse_topk(asked, signed, 5).collect()
    assert sorted((r.qid, r.id, r.score) for r in rows) == [(9, 1, 0.0), (9, 2, 0.0)]


def test_dimensions_must_agree(spark):
    points = spark.createDataFrame([(1, [1.0, 2.0])], "id long, dense array<float>")
    queries = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "qid long, dense array<float>")
    with pytest.raises(Exception, match="dimension"):
        knn.dense_topk(queries, points, 1).collect()


@pytest.mark.parametrize("few", [0, 16])
def test_cells_and_blocks_agree(monkeypatch, data, points, few):
    """Few cells: points pass the query blocks, whose results leave a task ranked; many cells: as before."""
    for module, name, value in [
        (knn, "QUERY_BLOCK", 40), (knn, "POINT_BLOCK", 25), (knn, "CELLS", 500), (knn, "FEW_CELLS", few), (blocks, "BLOCK_QUERIES", 25)
    ]:
        monkeypatch.setattr(module, name, value)
    found = knn.dense_topk(points.withColumnRenamed("id", "qid"), points, K, max_shipped=0)
    assert result(found) == expected(data, "dense", K)
    assert ("Window" in found._jdf.queryExecution().toString()) == (few == 0)


@pytest.mark.parametrize("kind", ["dense", "sparse"])
def test_no_search_in_blocks_ranks_its_rows_again(monkeypatch, spark, data, points, kind):
    """Rows leave a query block ranked; they are not shuffled for it, neither from a search nor from a re-ranking."""
    for name, value in {"BLOCK_ENTRIES": 60, "BLOCK_QUERIES": 25, "LEAST_ENTRIES": 40, "RESULT_ROWS": 7}.items():
        monkeypatch.setattr(blocks, name, value)
    monkeypatch.setattr(postings, "MANY_ENTRIES", 0)
    queries = points.withColumnRenamed("id", "qid")
    pairs = {q: list(range(q % 7, 90, 3)) for q in range(90)}
    candidates = spark.createDataFrame([(q, i) for q in pairs for i in pairs[q] * 2], "qid long, id long")
    vector = "dense" if kind == "dense" else "text_sparse"
    among = knn.topk_among(candidates, queries, points, K, kind, vector, max_shipped=0)
    assert result(among) == expected(data, kind, K, pairs)
    searched = knn.dense_topk(queries, points, K, max_shipped=0) if kind == "dense" else postings.sparse_topk(queries, points, K)
    assert result(searched) == expected(data, kind, K)
    for found in (among, searched):
        assert "Window" not in found._jdf.queryExecution().toString()


@pytest.mark.parametrize("k,width", [(1, 5), (4, 3), (4, 50), (40, 9), (500, 64)])
def test_running_best_keeps_the_smallest_ids_of_ties(monkeypatch, k, width):
    monkeypatch.setattr(knn, "CELLS", 60)
    rng = np.random.default_rng(k)
    scores = np.round(rng.integers(-3, 4, (13, 300)) / 3 + rng.random((13, 300)) * 1e-8, 9)
    shared, ids = rng.random((13, 300)) < 0.8, rng.permutation(300)
    shared[4] = False
    kept = knn._Best(13, k)
    for start in range(0, 300, width):
        tile = slice(start, start + width)
        kept.add(scores[:, tile], ids[tile], shared[:, tile])
    rows, found, values, rank = kept.result()
    for row in range(13):
        rounded = np.round(scores[row], knn.ROUND_DIGITS)
        want = sorted((-rounded[i], ids[i]) for i in range(300) if shared[row, i])[:k]
        own = rows == row
        assert [(-s, i) for s, i in zip(values[own], found[own])] == want
        assert rank[own].tolist() == list(range(1, len(want) + 1))
    assert knn._Best(3, k).result() is None


def test_frequent_terms_as_columns_give_the_same_sums():
    rng = np.random.default_rng(5)
    maps = [{f"t{j}": float(rng.integers(1, 5)) for j in range(40) if rng.random() < 1 / (1 + j / 3)} for _ in range(80)]
    lists = lambda part: (pa.array([list(m) for m in part]), pa.array([list(m.values()) for m in part]))
    inverted = blocks._Inverted(*lists(maps[:30]))
    assert 0 < inverted.columns.shape[1] < len(inverted.terms)
    scores = np.concatenate([s for _, s, _ in inverted.score(*lists(maps[30:]))], axis=1)
    assert np.allclose(scores, [[dot(a, b) or 0.0 for b in maps[30:]] for a in maps[:30]])


@pytest.mark.parametrize("kind", ["dense", "sparse", "among"])
def test_points_are_not_copied_for_every_query_block(monkeypatch, data, points, kind):
    """Query blocks read the one stream of points; a plan shuffles the rows of the queries and nothing else."""
    for name, value in {"BLOCK_QUERIES": 10, "LEAST_ENTRIES": 40}.items():
        monkeypatch.setattr(blocks, name, value)
    monkeypatch.setattr(postings, "MANY_ENTRIES", 0)
    queries = points.withColumnRenamed("id", "qid")
    pairs = {q: list(range(q % 7, 90, 3)) for q in range(90)}
    if kind == "dense":
        found = knn.dense_topk(queries, points, K, max_shipped=0)
    elif kind == "sparse":
        found = postings.sparse_topk(queries, points, K)
    else:
        candidates = points.sparkSession.createDataFrame([(q, i) for q in pairs for i in pairs[q]], "qid long, id long")
        found = knn.topk_among(candidates, queries, points, K, "dense", "dense", max_shipped=0)
    assert result(found) == expected(data, "sparse" if kind == "sparse" else "dense", K, pairs if kind == "among" else None)
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # the other exchange is the repartition of the table itself
    assert plan.count("CartesianProduct") == 1 and plan.count("Exchange") <= 2


def test_repeated_queries_have_their_candidates_each(spark, points):
    queries = points.where("id < 3").withColumnRenamed("id", "qid")
    candidates = spark.createDataFrame([(0, 5), (2, 9), (0, 5), (77, 5)], "qid long, id long")
    found = knn.topk_among(candidates, queries.unionByName(queries.where("qid = 0")), points, K, "dense", "dense", max_shipped=0)
    assert sorted((r.qid, r.id) for r in found.collect()) == [(0, 5), (0, 5), (2, 9)]


def test_search_of_many_postings_moves_no_query_terms(monkeypatch, tmp_path, data, points):
    """Counts of the terms decide; the terms of every query are not written with their statistics for it."""
    monkeypatch.setattr(postings, "MANY_POSTINGS", 0)
    monkeypatch.setattr(postings, "known_terms", None)
    index = postings.build_index(points, str(tmp_path))
    assert result(postings.search(points.withColumnRenamed("id", "qid"), index, K)) == expected(data, "sparse", K)
