"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from threadloom import plans  # noqa: E402
from threadloom.session import build_session  # noqa: E402

HEADLINE = (
    "b6_best_answer",
    "d6_rating_summary",
    "d7_rating_histogram",
    "e1_tail_split",
    "e7_completion_advantages",
    "c1_dense_topk",
    "c2_sparse_topk",
    "c3_dense_then_sparse",
    "c5_rank_fusion",
    "c11_records_of_id_list",
    "c12_sweep",
    "c13_search_comparison",
    "k6_dataset_job",
    "k8_rag_context",
    "k13_pack",
    "k17_length_budget_keep_end",
    "k19_unpaired_preparation",
    "e12_reverse_scan",
    "e17_masked_whiten",
    "a1_read_line_dump",
    "a7_upsert_last_write_wins",
    "m3_verdicts_with_retry",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = plans.queries()
    # start the JVM code paths and the Python workers before anything is timed
    catalog["b6_best_answer"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    catalog["j1_encoder"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        began = time.perf_counter()
        catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
