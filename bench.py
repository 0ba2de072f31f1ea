"""Time the registered queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name …]

The headline queries cover all six jobs; names or `all` choose others. Each query first runs
on the smallest tables, so that its code is compiled, and is then timed `BENCH_RUNS` times
(default 1); its whole result is computed and dropped. The value is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from datamill.plans import catalog
from datamill.session import build_session

HEADLINE = """
missing_stats matched_contrast score_threshold_contingency distinct_counts linkage_parse
alias_ratings item_popularity popularity_predict user_item_sets negative_samples
mean_auc_popularity als_train_factors als_recommend_many
labeled_features class_priors chance_accuracy class_metrics tree_predictions forest_predictions
onehot_features vector_moments standardize nearest_center kmeans_lloyd_step cluster_entropy
anomalies kmeans_k_scan
page_articles doc_terms term_frequency vocabulary tfidf lsa_singular_values
topic_counts cooccurrence_counts graph_edges connected_components top_degree_names
chi_square_stats triangle_counts path_length_histogram
""".split()


def run(spark, sf_dir: str, name: str) -> float:
    begin = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(catalog.QUERIES)
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        if os.path.isdir(warm):
            run(spark, warm, name)
        seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
