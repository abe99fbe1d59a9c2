"""Time the registered queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (optional, comma-separated) the queries. The tables that
queries share are built first and timed as ``build_layers`` (Bronze, Silver),
``write_raw`` (the text files of the scans) and ``build_study`` (features, split,
scalers); every query then runs whole, to
a sink that takes all its rows. Each query runs ``BENCH_RUNS`` times and the
fastest run counts, so that compilation of the first one does not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wearline.plans import queries as registered  # noqa: E402
from wearline.workspace import session  # noqa: E402

# Forests are timed once: the fitted models are kept for later queries.
ONCE = ("rul_results",)
HEADLINE = (
    "scan_readings", "silver_status_full", "silver_derived", "rows_by_status",
    "rolling_averages", "engine_health", "ml_features", "sensor_drift", "sensor_drift_join",
    "anomaly_scores", "anomaly_summary", "anomaly_by_life_stage", "top_anomalous_engines",
    "gold_write", "engine_split", "scaled_features", "regression_metrics",
    "quality_report", "stream_ingest", "rul_results",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(f"local[{cpus}]", "wearline-bench", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered.all_queries()

    seconds = {"build_layers": timed(lambda: registered.tables(spark, sf_dir))}
    seconds["write_raw"] = timed(lambda: registered.raw_files(spark, sf_dir))
    study = registered.study(spark, sf_dir)
    seconds["build_study"] = timed(lambda: (study.cuts, study.feature_rows, study.fallback))
    for name in names:
        repeats = 1 if name in ONCE else runs
        seconds[name] = min(
            timed(lambda: consume(queries[name](spark, sf_dir))) for _ in range(repeats)
        )
        print(f"{name}: {seconds[name]:.2f}s", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "readings": registered.tables(spark, sf_dir).bronze.count(),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
