"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8), executing the whole plan into Spark's ``noop``
sink (no collection to the driver), and prints one JSON line (cached tables are dropped before each query):
``{"metric": "headline_total", "value": <sum of seconds>, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordmill.plans.catalog import QUERIES  # noqa: E402
from wordmill.session import get_spark  # noqa: E402

HEADLINE = [
    "v7_tfidf",                 # relational TF-IDF, whole corpus
    "k1_top_terms_per_doc",     # flagship: top 20 terms per document
    "k2_top_terms_overall",
    "v9_ngram_top_features",    # unigrams + bigrams, stopwords, top 10 features
    "v11_pruned_sublinear",
    "v6_class_top_words",       # per-class word-cloud tables with data-driven stopwords
    "t10_preprocess",           # composite token pipeline
    "m1_sample_fraction",       # exact seeded sample without a global sort
    "m4_stratified_fraction",
    "a5_metrics_by_method",     # learning-curve metrics, one grouped job
    "l6_contrastive_pairs",
    "l10_prompt_classify",      # prompts + batched responder + parsing
    "l1_fit_predict",           # TF-IDF + logistic regression fit and scoring
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", max(cpus, 8))
    # warm-up, not timed: every query once on the smallest scale, so the timings below
    # are steady-state (JIT-compiled regex and codegen paths, Python workers started)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in names:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        spark.catalog.clearCache()  # no query reads what another one left
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "warmup": f"each query once on {warm_dir}, untimed"}))
    spark.stop()


if __name__ == "__main__":
    main()
