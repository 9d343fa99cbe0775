from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from threadloom.operators import ordering, rollouts as ro, stats


def test_reverse_scan_matches_the_loop(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.normal(size=n).tolist(), rng.normal(size=n).tolist()) for i, n in enumerate([1, 5, 0, 9])]
    rows = spark.createDataFrame(data, "id long, rewards array<double>, values array<double>").coalesce(1)
    got = {r.id: r for r in ro.returns_and_advantages(rows, "rewards", "values", 0.9, 0.8).collect()}
    for i, rewards, values in data:
        run, out = 0.0, []
        for t in reversed(range(len(rewards))):
            following = values[t + 1] if t + 1 < len(values) else 0.0
            run = rewards[t] + 0.9 * following - values[t] + 0.9 * 0.8 * run
            out.insert(0, run)
        assert np.allclose(got[i].advantages, out)
        assert np.allclose(got[i].returns, np.array(out) + np.array(values))


def test_one_row_group_has_no_deviation(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, 1.0), (2, 3.0)], "group_id long, reward double")
    got = {(r.group_id, r.reward): r.advantage for r in ro.group_advantages(rows).collect()}
    assert got[(1, 2.0)] is None
    assert abs(got[(2, 3.0)] - 1 / (np.sqrt(2) + 1e-4)) < 1e-12
    assert [r.baseline for r in ro.leave_one_out(rows).filter("group_id = 1").collect()] == [None]


def test_masked_whiten(spark):
    data = [(1, [1.0, 2.0, 50.0], [1, 1, 0]), (2, [4.0], [1])]
    rows = spark.createDataFrame(data, "id long, v array<double>, m array<int>")
    got = {r.id: r.w for r in ro.masked_whiten(rows, "v", "m", "w").collect()}
    kept = np.array([1.0, 2.0, 4.0])
    scale = lambda x: (np.array(x) - kept.mean()) / np.sqrt(kept.var(ddof=1) + 1e-8)
    assert np.allclose(got[1], scale(data[0][1])) and np.allclose(got[2], scale(data[1][1]))


def test_token_rewards_place_the_score_last(spark):
    df = spark.sql("select array(0.5D, 1.0D) p, array(0.25D, 1.0D) r, 3.0D s")
    got = df.select(ro.token_rewards(F.col("s"), F.col("p"), F.col("r"), 2.0).alias("v")).first().v
    assert got == [-0.5, 3.0]


def test_tie_goes_to_the_first(spark):
    side = lambda c, s: spark.createDataFrame([(1, c, s)], "k long, completion string, score double")
    row = ro.best_of_two(side("a", 2.0), side("b", 2.0), ["k"], ro.by_score()).first()
    assert (row.chosen, row.rejected) == ("a", "b")


def test_quantiles_and_histogram(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(size=401), 2)
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(values)], "x double, g int")
    d = stats.describe(df, "x").first()
    for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        assert abs(d[name] - np.quantile(values, q)) < 1e-9
    by = {r.g: r for r in stats.describe(df, "x", by=["g"]).collect()}
    assert abs(by[1].q50 - np.quantile(values[1::2], 0.5)) < 1e-9
    counts, _ = np.histogram(values, bins=10)
    rows = stats.histogram(df, "x").orderBy("bin").collect()
    assert [r.n for r in rows] == counts.tolist()
    constant = stats.histogram(df.withColumn("x", F.lit(2.0)), "x").orderBy("bin").collect()
    assert [r.n for r in constant] == [0, 0, 0, 0, 0, 401, 0, 0, 0, 0]
    spark.catalog.clearCache()


def test_describe_of_offsets_groups_and_nothing(spark):
    values = np.array([1e9 + k / 8 for k in range(64)])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 5.0), ("c", None)], "g string, x double")
    by = {r.g: r for r in stats.describe(df, "x", ["g"]).collect()}
    assert abs(by["a"]["std"] - values.std(ddof=1)) < 1e-9 and by["a"]["count"] == 64
    assert (by["b"]["count"], by["b"]["std"], by["b"].q50) == (1, None, 5.0) and (by["c"]["count"], by["c"]["mean"]) == (0, None)
    none = stats.describe(df.where("false"), "x").first()
    assert (none["count"], none["mean"], none["std"], none.q25) == (0, None, None, None)


def test_sketches_merge(spark):
    rng = np.random.default_rng(2)
    values = np.round(rng.gamma(2.0, 50.0, 40_000) + 1e6, 2)
    df = spark.createDataFrame([(int(k % 7), float(v)) for k, v in enumerate(values)] + [(9, None)], "part int, x double")
    parts = stats.sketch(df, "x", ["part"], k=1024)
    assert parts.count() == 8
    told = stats.describe_sketch(stats.merge_sketches(parts)).first()
    assert told["count"] == 40_000 and abs(told["mean"] - values.mean()) < 1e-6 and abs(told["std"] - values.std(ddof=1)) < 1e-6
    assert (told["min"], told["max"]) == (values.min(), values.max())
    for name, f in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        low, high = (values < told[name]).mean(), (values <= told[name]).mean()
        assert low - stats.rank_error(1024) <= f <= high + stats.rank_error(1024)
    # one pass over the input, one row a task in the shuffle
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_running_moments(spark, monkeypatch):
    rng = np.random.default_rng(4)
    values = rng.normal(size=600) + 1e8
    steps = np.sort(rng.integers(0, 100, 600))
    rows = [(int(s), int((steps == s).sum()), float(values[steps == s].mean()), float(((values[steps == s] - values[steps == s].mean()) ** 2).sum())) for s in np.unique(steps)]
    rows.append((1000, 0, 0.0, 0.0))
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 17)
    got = {r.step: r for r in stats.running_moments(spark.createDataFrame(rows, "step int, n long, mean double, m2 double"), "step").collect()}
    for s in np.unique(steps):
        upto = values[steps <= s]
        assert got[s].n == len(upto) and abs(got[s].running_mean - upto.mean()) < 1e-6
        # the batch means themselves are only known to 1.5e-8 at this size
        assert len(upto) < 2 or abs(got[s].running_var / upto.var(ddof=1) - 1) < 1e-7
    assert got[1000].n == 600


def test_empty_bins_are_returned(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    assert [r.n for r in stats.histogram(df, "x").orderBy("bin").collect()] == [1] + [0] * 8 + [1]
