"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (names, default the list below, `all` for every query) steer it.
Every query writes its whole result to the no-op sink. Caches are cleared
before each query, so no query profits from another one.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brightloom.plans.registry import PLANS  # noqa: E402
from brightloom.session import build_session  # noqa: E402

HEADLINE = (
    "tx_clean", "rfm", "rfm_segments", "segment_profile", "describe_table", "boxplot", "histogram",
    "value_counts_share", "distinct_counts", "text_stats", "slug_hash_redact", "secret_scan", "json_schema_check",
    "grade_bands", "calc_binary", "catalogue_clean", "genre_counts", "tfidf_terms", "similar_items",
    "experiment_grid", "cache_lookup", "row_validation", "rubric_scores", "prompt_ranking", "blind_labels",
    "macro_metrics", "roc_auc", "roc_points", "cluster_quality", "scaled_features", "stratified_split",
    "kmeans_score", "best_model_scores", "kmeans_sweep", "business_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(PLANS) if asked == "all" else asked.split() or list(HEADLINE)
    spark = build_session(
        f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()  # JVM start is not timed
    seconds = {}
    for name in names:
        spark.catalog.clearCache()
        started = time.perf_counter()
        PLANS[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    factor = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(factor.group(1)) if factor else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
