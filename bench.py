"""Wall seconds of the headline queries, warm, median of three; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from talkatlas.operators.recommend import cosine_scores  # noqa: E402
from talkatlas.plans.common import vectors  # noqa: E402
from talkatlas.plans.registry import all_queries  # noqa: E402
from talkatlas.session import build_session  # noqa: E402

HEADLINE = [
    "clean_transcripts",
    "clean_text",
    "column_profile",
    "playlist_top5_share",
    "word_count_curve",
    "map_category",
    "chunk_text",
    "tfidf_l2",
    "recommend_tfidf",
    "summarise_extractive",
    "cosine_scores",
    "recommend_topk",
    "recommend_topk_all",
    "hit_rate_top1",
    "classify_knn",
    "knn_grid",
    "tfidf_spark_ml",
    "hashing_tf",
    "embed_hashed",
    "classify_svc",
    "classify_rf",
    "lemma_lookup",
    "preprocess_column",
]
ONCE = {"classify_svc", "classify_rf"}  # full grids, five folds and the refit
SWEEP = [4, 8, 20]


def seconds(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "talkatlas-bench")
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        run = registered[name].run
        if name in ONCE:
            timings[name] = round(seconds(lambda: run(spark, sf_dir)), 3)
            continue
        seconds(lambda: run(spark, sf_dir))
        timings[name] = round(statistics.median(seconds(lambda: run(spark, sf_dir)) for _ in range(3)), 3)
    for parts in SWEEP:

        def scored():
            v = vectors(spark, sf_dir)
            return cosine_scores(v.repartition(parts), v.where(F.col("vec_id") == 7), "embedding")

        seconds(scored)
        timings[f"cosine_scores_{parts}_partitions"] = round(statistics.median(seconds(scored) for _ in range(3)), 3)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
