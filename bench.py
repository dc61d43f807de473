"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores).
Every query is planned and run to the end once after a warm-up of the session;
the results go to Spark's no-op sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINES = (
    "l14_training_frame",
    "l15_gold_frame",
    "t06_vocabulary",
    "t07_tfidf",
    "t08_fit",
    "t09_predict",
    "t13_training_report",
    "r15_r19_relations",
    "p01_extract_event",
    "e05_e13_evaluation_report",
    "e17_corrected_report",
    "t02_oversample",
    "c01_classification_report",
    "x09_class_answers",
    "x02_x08_x11_batch_answers",
    "x13_micro_batches",
    "a08_s05_leaderboard_merge",
)


def main() -> None:
    from tidings.catalog import SPARK
    from tidings.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").groupBy("n_regionkey").count().collect()

    seconds: dict[str, float] = {}
    for name in HEADLINES:
        start = time.perf_counter()
        SPARK[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
