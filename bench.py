"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8).  Each query runs to completion through the ``noop`` sink, so
the full plan executes without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_tract_rollup", "q_property_base", "q_stratified_extract", "q_id_bridge", "q_image_wide",
    "q_features_pooled", "q_features_prior_sale", "q_outlier_filter", "q_stratified_split", "q_label_encode",
    "q_regression_metrics", "q_feature_extremes", "q_extrema_report", "q_importance_rank",
    "q_parse_tags", "q_pair_counts", "q_triple_counts", "q_combined_doc", "q_tfidf_smooth",
    "q_topic_coherence", "q_gbt_price", "q_lda_topics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from propval.plans import registry
    from propval.session import local_session
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16))
    registry.load_all()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
