"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and then BENCH_RUNS times (2 by default); the median counts. The noop sink
makes Spark produce every row without writing it.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from dailypanel.catalog import Catalog
from dailypanel.queries import bindings as B
from dailypanel.queries.all import QUERIES
from dailypanel.operators import features as X
from dailypanel.operators import impute as I
from dailypanel.operators import panel as P
from dailypanel.session import local_session

HEADLINES = [
    "load_readings", "daily_panel", "tod_panel", "sliding_std", "rest_times", "impute_all", "ewma", "ready_panel",
    "both_panel", "chrono_split", "scale_standard", "sequence_dataset", "missing_profile", "corr_matrix",
    "target_correlation", "histogram", "top_category_box", "label_encode", "regression_metrics",
    "classification_report", "param_grid", "fit_linear",
]


def yardstick(spark, sf_dir):
    level, only_mood = "mood_mean_daily", Catalog(averaged=("mood",), summed=())
    panel = P.daily_panel(B.readings(spark, sf_dir), only_mood).select("entity", "date", level)
    panel = X.add_ewma(I.fill_linear(panel, [level]), [level])
    return X.add_next_day(panel, level)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "dailypanel-bench")
    spark.sparkContext.setLogLevel("ERROR")
    builders = {"yardstick": yardstick, **{name: QUERIES[name] for name in HEADLINES}}
    seconds = {}
    for name, build in builders.items():
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
