"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import time

from versus.plans import registry
from versus.session import get_session

HEADLINE = [
    "word_overlap_pref",
    "accuracy",
    "meteor_alpha_sweep",
    "bleu_default",
    "bleu_smoothing_sweep",
    "clipped_precision",
    "corpus_ngram_freq",
    "freq_quartiles",
    "pos_class_diff",
    "match_split",
    "wordvec_mean",
    "idf_corpus",
    "knn_uniform",
    "stream_confusion",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "versus-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("word_overlap_pref")  # starts the executor threads and loads classes
    times = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
