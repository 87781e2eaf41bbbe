"""Headline queries, warm median of three runs each; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local threads. The reports run
from the star tables to a sink that discards rows, so every result row is computed.
"""

import itertools
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trendlens.operators import model
from trendlens.plans import frames
from trendlens.plans.queries import QUERIES
from trendlens.session import build_session, scratch_path
from trendlens.sources import messages
from trendlens.streaming import scoring, sinks

HEADLINES = (
    "w01_keep_best",
    "a04_total_views_by_category",
    "a05_unique_channels",
    "a07_channel_concentration",
    "a15_hour_by_weekday",
    "a17_time_to_trend_by_category",
    "a19_trending_lifespan",
    "a20_rates_by_category",
    "c01_correlation_matrix",
    "t02_top20_views",
    "k03_upsert_keep_last",
    "q07_profile",
    "m02_features",
    "m04_time_split",
)
RUNS = 3


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def warm_median(action) -> float:
    action()
    return statistics.median(timed(action) for _ in range(RUNS))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str):
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()

    seconds = {name: warm_median(lambda n=name: run(n)) for name in HEADLINES}

    # One micro-batch holding the whole table.
    rows = frames.model_rows(spark, sf_dir, 0.15)
    fitted = []
    seconds["m06_train_10_trees"] = timed(
        lambda: fitted.append(model.train(rows, frames.ROW_KEY, iterations=10)[0])
    )
    root = scratch_path(spark, "bench")
    sinks.publish_files(frames.raw_file_rows(spark, sf_dir).repartition(8), f"{root}/in")
    batch = messages.decode(spark.read.text(f"{root}/in"))
    ids = itertools.count()  # a batch that was committed would not be done again
    seconds["st03_micro_batch"] = warm_median(
        lambda: scoring.process_batch(batch, next(ids), fitted[0], root)
    )

    print(
        json.dumps(
            {
                "metric": "sum of warm median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
