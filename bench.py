"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
collect).  Prints one JSON line.  ``reads_per_sec`` is the bulk-match
throughput (reads in / seconds) for the six-frame search.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from repflow.plans.registry import QUERIES, load_all  # noqa: E402
from repflow.session import get_spark  # noqa: E402

HEADLINE = [
    "bulk_match", "sc_match", "match_richness_per_document", "six_frames",
    "richness", "richness_with_metadata", "length_spectrum_unique", "feature_matrix_v2", "feature_matrix_wide",
    "cohort_outer_join", "classifier_table", "repertoire_summary", "assay_overlap",
    "normalise_log1p", "highly_variable_genes", "scale_genes", "cell_type_scores", "spearman_typing",
    "stratified_split", "standardise_train_test", "mutual_information", "roc_auc",
    "series_matrix_parse", "match_folder_richness",
    "knn_graph", "knn_classifier", "smote_oversample", "pca_embedding",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    load_all()
    # warm-up: JVM, Python workers and the Arrow UDF path
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("richness", "bulk_match"):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, errors = {}, {}
    for name in only:
        t0 = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as exc:  # keep the one-line contract even if a query fails
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    n_reads = None
    if "bulk_match" in times and times["bulk_match"] > 0:
        from repflow.plans.fixtures import reads
        n_reads = reads(spark, sf_dir).count()
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "total_headline_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}
    if n_reads:
        out["reads_per_sec_bulk_match"] = round(n_reads / times["bulk_match"], 1)
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
