"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the no-op sink (no driver collection).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def headline(spark, d):
    from arborlex.operators import trees as T
    from arborlex.plans import catalog as C
    from arborlex.plans import catalog_more as CM

    def order_edges(spark, d):
        return T.mask_edges(T.materialize(T.expand(C.order_actions(spark, d))))

    return {
        "tree_expand": C.tree_expand,            # T1-T8 on the order tree
        "tree_mask_edges": order_edges,          # T9 edges on the order tree
        "tree_mask_degree": C.tree_mask_degree,  # T9 compact (sweep)
        "tree_rejects": C.tree_rejects,          # T2/T3 on broken order trees
        "vocab_train": CM.vocab_train,           # V1-V3
        "vocab_encode": CM.vocab_encode,         # V5-V7
        "count_dot": CM.count_dot,               # K7
        "pad_batches": CM.pad_batches,           # B1-B4
        "bpe_encode": CM.bpe_encode,             # V14
    }


def main() -> None:
    from arborlex.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="arborlex-bench")
    # warm the JVM (JIT, codegen, Python workers) once on the smallest tables
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for fn in headline(spark, warm_dir).values():
            fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in headline(spark, sf_dir).items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
