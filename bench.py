"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

import pyarrow.parquet as pq

HEADLINE = [
    "violation_rate_by_fold",
    "validate_report",
    "duplicate_report",
    "dedupe",
    "number_rows",
    "multilabel_stratified_kfold",
    "length_dealt_folds",
    "sample_fraction",
    "class_distribution",
    "length_stats_words",
    "vocabulary_stats",
    "top_terms",
    "length_density_words",
    "zero_shot",
    "prepare_splits",
    "url_clean",
    "url_semantics",
    "append_random_urls",
    "phonetic_swap",
    "sentence_shuffle",
    "augment",
    "few_shot_chat",
    "truncate_prompt",
    "roc_auc_by_rule",
    "roc_auc_continuous",
    "column_averaged_auc",
    "ensemble_weighted",
    "triplets",
    "triplets_prefer_community",
    "tokenize",
    "tfidf",
    "mean_vector_drift",
    "violation_rate",
    "score",
    "score_many",
    "out_of_fold",
    "train_text_classifier",
    "domain_classifier",
    "detect_drift_one_table",
    "detect_drift_two_tables",
    "whole_run_predictions",
]


def laid_out(sf_dir: str, parts: int) -> str:
    """A copy of the tables with several row groups each, as large files have: one group is one task."""
    to = tempfile.mkdtemp(prefix="bench-")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        rows = pq.read_table(path)
        pq.write_table(rows, f"{to}/{path.name}", row_group_size=max(1, -(-len(rows) // parts)))
    return to


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    from modsieve.catalog import QUERIES
    from modsieve.session import local_session

    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    # The bench files are small: their row groups are splits of their own.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    names = sys.argv[1:] or HEADLINE
    sf_name, sf_dir = os.path.basename(sf_dir.rstrip("/")), laid_out(sf_dir, int(cpus) if cpus.isdigit() else 8)
    QUERIES["violation_rate_by_fold"](spark, sf_dir).collect()  # start the engine before the clock
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # A sink that reads every row and every column.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline queries, total wall-clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_name,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
