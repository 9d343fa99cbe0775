from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import ordering as od


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"), (F.col("id") % 3).alias("w"))


@pytest.mark.parametrize("buckets", [1, 13])
def test_running_total_over_buckets(rows, buckets):
    got = {r.id: r.t for r in od.running_total(rows, "id", F.col("w"), out="t", buckets=buckets).collect()}
    total = 0
    for r in sorted(rows.collect(), key=lambda r: r.id):
        total += r.w
        assert got[r.id] == total


@pytest.mark.parametrize("kind", ["even", "spikes", "heavy", "wide", "odd"])
def test_buckets_follow_measured_counts(spark, monkeypatch, kind):
    """No bucket beyond the wanted rows but for one repeated value; buckets are ordered like the key."""
    rng = np.random.default_rng(9)
    values = {
        "even": np.arange(4000.0),
        "spikes": np.r_[rng.normal(0, 1e-9, 2000), rng.normal(1e12, 1e-3, 2000)],
        "heavy": np.r_[np.full(3000, 7.0), rng.random(1000) * 100],
        "wide": 10.0 ** rng.uniform(-300, 300, 4000) * rng.choice([-1, 1], 4000),
        "odd": np.r_[rng.random(3990), np.full(5, np.inf), np.full(4, -np.inf), [np.nan]],
    }[kind]
    monkeypatch.setattr(od, "ROWS_PER_BUCKET", 100)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    bounds = od.numeric_bounds(df, "v")
    placed = df.select("v", od.bucket_of(F.col("v"), bounds).alias("b")).filter("abs(v) < 1.7e308").groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    found = sorted(placed.collect(), key=lambda r: r.b)
    assert all(r.n <= 100 or r.low == r.high for r in found)
    assert all(x.high < y.low for x, y in zip(found, found[1:]))
    assert len(bounds) <= 3 * 4000 / 100 + 2


def test_hashed_buckets_are_ordered_and_even(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    placed = df.select("k", od.hashed_bucket(df, "k", 50).alias("b")).collect()
    assert [r.b for r in sorted(placed, key=lambda r: r.k)] == sorted(r.b for r in placed)
    sizes = np.bincount([r.b for r in placed])
    assert len(sizes) == 50 and sizes.max() < 160


def test_nothing_has_no_buckets(spark):
    none = spark.range(0)
    assert od.numeric_bounds(none, "id") == [] and od.global_row_number(none, "id").count() == 0
    assert od.shuffled_position(none, "id").count() == 0


def test_row_numbers_per_partition(rows):
    numbered = od.global_row_number(rows, "id", partition=["w"], buckets=5).collect()
    for w in range(3):
        mine = sorted((r.id, r.rn) for r in numbered if r.w == w)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))


def test_shuffled_positions_follow_the_hash(rows):
    key = lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()
    want = sorted(range(1000), key=key)
    got = sorted((r.rn, r.id) for r in od.shuffled_position(rows, "id").collect())
    assert [i for _, i in got] == want


def test_splits_are_disjoint_and_complete(rows):
    split = od.split_tail_valid(rows, "id", 20).collect()
    assert len(split) == 1000 and len({r.id for r in split}) == 1000
    assert sum(r.cat == "valid" for r in split) == 200
    head = od.split_head_valid(rows, "id", n_valid=15).collect()
    assert sum(r.split == "valid" for r in head) == 15


def test_replacement_sample_has_the_exact_size(rows):
    assert od.sample_with_replacement(rows, "id", 512).count() == 512
    assert od.sample_with_replacement(rows.limit(40), "id", 512).count() == 40


def test_mismatched_pairs_rotate_inside_a_batch(spark):
    df = spark.range(10).withColumn("c", F.concat(F.lit("c"), F.col("id").cast("string")))
    got = {r.id: r.o for r in od.mismatched_pairs(df, "id", "c", 4, "o").collect()}
    assert got == {0: "c3", 1: "c0", 2: "c1", 3: "c2", 4: "c7", 5: "c4", 6: "c5", 7: "c6", 8: "c9", 9: "c8"}
    with pytest.raises(ValueError):
        od.mismatched_pairs(df, "id", "c", 1, "o")
