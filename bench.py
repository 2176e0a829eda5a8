"""Times the headline queries and prints one JSON line.

Every query is run once to warm up and then timed; the graph queries, which are short, get the median of three runs.
``BENCH_SF_DIR`` names the folder of tables and ``BENCH_CPUS`` the number of cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillgraph.registry import QUERIES  # noqa: E402
from quillgraph.session import build_session  # noqa: E402

HEADLINE = {
    "csv_roundtrip": 1,
    "null_profile": 1,
    "join_agg_default": 3,
    "join_agg_hash": 3,
    "join_agg_coalesce": 3,
    "join_agg_broadcast": 3,
    "join_salted": 3,
    "edges_prescribed": 1,
    "node_upsert": 1,
    "mentions_extract": 1,
    "pairs_exact_jaccard": 1,
    "pairs_lsh": 1,
    "er_features_names": 1,
    "er_train_metrics": 1,
    "cooccurrence": 1,
    "pagerank_bipartite": 1,
    "wcc": 1,
    "louvain": 1,
    "q1_shortest_path": 3,
    "q2_differential_dx": 3,
    "q3_similar_cohort": 3,
    "q4_medication_diagnoses": 3,
    "q5_top_drugs": 3,
}


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(HEADLINE)
    warm, cold = {}, {}
    for name in names:
        cold[name] = round(run(spark, name, folder), 3)
        warm[name] = round(statistics.median(run(spark, name, folder) for _ in range(HEADLINE.get(name, 1))), 3)
        print(f"{name} {cold[name]} {warm[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "first_run": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
