"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.chdir(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.getcwd())

from checks.compare import session  # noqa: E402

# Whole build first: the number comparable to the published preparation times.
HEADLINE = (
    "manifest", "materialize_rows", "group_split", "dedup_within_split", "class_distribution", "length_stats",
    "length_ecdf", "leak_exact_text", "jaccard_pairs", "cosine_pairs", "vocab_topk", "tfidf_weights",
    "feature_vectors", "encode_fixed", "batch_scoring", "confusion_matrix", "run_result", "auroc_ovr",
)


def prepare_chats(spark, sf):
    """Corpus build over the conversation families alone: short texts, like the published corpus."""
    from checks import fixtures as fx
    from corpuswright.operators import manifest
    from corpuswright.plans import build

    corpus = build.build_corpus(fx.chat_records(spark, sf), staged=True)
    return manifest.manifest_cells(corpus.rows, corpus.dropped)


def logreg_fit(spark, sf) -> float:
    """Seconds of the logistic-regression fit itself, features prepared before."""
    from checks import fixtures as fx
    from corpuswright.operators import models
    from corpuswright.plans import baseline

    run = baseline.fit_baseline(fx.labelled(spark, sf), models.logistic_regression)
    return run.train_time_sec


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    from checks.queries import QUERIES

    def consume(build) -> float:
        started = time.perf_counter()
        build(spark, sf).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    for _ in range(2):  # start the JVM paths and the Python workers
        consume(prepare_chats)
    times = {"prepare_chats": consume(prepare_chats)}
    for name in HEADLINE:
        times[name] = consume(QUERIES[name])
    times["logreg_fit"] = round(logreg_fit(spark, sf), 3)
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
