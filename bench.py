"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of Parquet tables, ``BENCH_CPUS`` the number of local cores.
"""

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from coterie.plans.catalog import ALL_QUERIES  # noqa: E402

HEADLINE = [
    "item_support",
    "basket_pairs",
    "basket_stats",
    "pcy_bucket_counts",
    "pcy_pairs",
    "word_shingles",
    "shingle_universe",
    "minhash_signatures",
    "near_duplicate_documents",
    "lsh_verified_pairs",
    "sliding_periods",
    "nearest_clustroid",
    "kclustroid_titles",
    "levenshtein_eps_join",
    "connected_components",
    "tfidf_features",
    "clean_html_body",
    "clean_text_tokens",
    "apriori_itemsets",
    "pcy_multilevel_triples",
    "fpgrowth_itemsets",
    "jaccard_similar_pairs",
    "similarity_histogram",
    "lsh_band_plan",
    "clustroid_update",
    "elbow_sweep",
    "dbscan_titles",
    "single_linkage_merges",
    "affinity_propagation",
    "kmeans_vectors",
    "maximal_itemsets",
    "adaptive_threshold_trace",
    "itemset_containment_count",
    "nearest_titles",
    "lsh_candidate_pairs",
    "dbscan_labels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # session start is not a query
    seconds = {}
    for name in names:
        started = time.time()
        ALL_QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    scale = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
