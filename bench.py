"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (no driver
collect), once to warm up, then $BENCH_REPEAT times; the median is
reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "knn_by_product",        # every product's top-5 neighbours (batch kNN join)
    "text_search",           # encode every distinct name, top-5 over the catalog
    "doc_search",            # whole-document index, every benchmark passage as a query
    "recommend_all",         # rule join + scoring + top-5 for every product
    "dup_pairs_chain",       # exact all-pairs similarity >= 0.40
    "dup_clusters",          # pairs -> connected components -> clusters
    "dup_clusters_planted",  # planted near-copies at 0.92
    "clean_catalog",         # cleaning pipeline
    "profile_scalars",       # clean + images + cap + profile
    "freq_article_type_top20",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from vitrine.plans.queries import REGISTRY
    from vitrine.session import build_session

    spark = build_session(cpus, app="vitrine-bench")
    times: dict[str, float] = {}
    for name in (only or HEADLINE):
        fn = REGISTRY[name]

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        run()  # warm-up (Python workers, JIT, file listing)
        times[name] = round(statistics.median(run() for _ in range(max(repeat, 1))), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
