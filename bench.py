"""Headline-query timing. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list of keys; default the headline set).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.registry import load_all  # noqa: E402
from shelfcast.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_safe_forecast",
    "train_final",
    "horizon_features",
    "holiday_flags",
    "target_encode_oof",
    "family_metrics",
    "concentration_store",
    "acf",
    "decompose_additive",
    "representative_series",
    "kruskal_wallis",
    "store_rank",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reg = load_all()
    want = os.environ.get("BENCH_QUERIES")
    keys = [k for k in (want.split(",") if want else HEADLINE) if k in reg]
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) * 2, app="shelfcast-bench")
    # warm-up: JVM, file listing and codegen caches
    reg[keys[0]].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        t0 = time.time()
        reg[k].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
