"""Connected components of a link table.

Large-star and small-star steps in turn: each node hands its neighbours to its
smallest neighbour. The links are rewritten as tables in the shared folder, a
hub's neighbours are only ever aggregated or joined by key, never gathered. Their
number never grows, so it says how many tasks and files a step takes: few links in
many would cost a block of disk for each, step after step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.llm.base import written

LINKS_A_TASK = 1 << 18


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node."""
    tasks = max(1, -(-links.count() // LINKS_A_TASK))
    current = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().coalesce(tasks), "links"
    )
    state = _state(current)
    while True:
        # large star: larger neighbours of a node point to the smallest of its neighbourhood
        around = _both(current)
        least = around.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("low"))
        large = around.join(least, "a").where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = written(large.coalesce(tasks).distinct().coalesce(tasks), "large-star")
        # small star: smaller neighbours and the node itself point to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b")))
        )
        small = written(small.coalesce(tasks).distinct().coalesce(tasks), "small-star")
        before, state, current = state, _state(small), small
        if state == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    ).coalesce(tasks)
