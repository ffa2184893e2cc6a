"""Headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Tables derived from the test data are landed before timing. Each job runs once to warm up and is then
timed; ``BENCH_REPEATS`` (default 1) takes the median of several runs. Results are forced with the
``noop`` sink, so every output row is computed.
"""

import json
import os
import statistics
import sys
import time
from dataclasses import replace

from pyspark.sql import functions as F

from meterflow import fixtures as fx
from meterflow.config import LATENCY_BOUNDS, ModelSettings
from meterflow.models.training import predict, train_model
from meterflow.operators import telemetry as tm
from meterflow.operators.champions import champion_history
from meterflow.operators.cleaning import clean_trips, cleaning_report
from meterflow.operators.drift import DISTANCE, DURATION, batch_drift, period_drift, rolling_drift
from meterflow.operators.evaluation import regression_metrics
from meterflow.operators.features import training_features
from meterflow.operators.ordering import with_row_index
from meterflow.operators.splitting import seeded_subsample, split_by_ratio, split_sizes
from meterflow.operators.throttle import throttle_marks
from meterflow.operators.validation import violation_counts
from meterflow.session import build_session, materialise

ORDER = ("pickup_datetime", "trip_id", "trip_distance", "total_amount")


def jobs(spark, sf_dir):
    trips, requests = fx.trips_hist(spark, sf_dir), fx.requests(spark, sf_dir)
    predictions, runs = fx.predictions(spark, sf_dir), fx.model_runs(spark, sf_dir)
    cleaned = materialise(clean_trips(trips), "cleaned")
    features = materialise(training_features(cleaned, keep=["trip_id", "total_amount"]), "features")
    scored = trips.select(*ORDER, (3 + 4 * F.col("trip_distance")).alias("predicted_duration_minutes"))
    small = ModelSettings(trees=5, max_depth=5, subsample_rows=None)
    split = materialise(split_by_ratio(features, order=ORDER), "split")

    def train(settings):
        model = train_model(split.filter("split = 'train'"), settings)
        return regression_metrics(predict(model, split.filter("split <> 'train'")), by=["split"])

    return {
        "clean_report": lambda: cleaning_report(trips),
        "clean_report_by_month": lambda: cleaning_report(
            trips.withColumn("month", F.trunc("pickup_datetime", "month")), ["dataset", "month"]),
        "clean_rows": lambda: clean_trips(trips),
        "strict_violations": lambda: violation_counts(trips),
        "features": lambda: training_features(cleaned, keep=["trip_id"]),
        "row_index": lambda: with_row_index(trips.select(*ORDER), ORDER),
        "split_ratio": lambda: split_sizes(split_by_ratio(features, order=ORDER)),
        "subsample": lambda: seeded_subsample(features, 100_000, 42),
        "period_psi": lambda: period_drift(
            features.withColumn("month", F.trunc("pickup_datetime", "month")), ["month"], DISTANCE),
        "rolling_psi": lambda: rolling_drift(scored, ORDER, (DISTANCE, DURATION)),
        "batch_psi": lambda: batch_drift(
            scored.withColumn("batch", F.to_date("pickup_datetime")), ORDER, "batch", (DISTANCE, DURATION)),
        "latency_quantile_5m": lambda: tm.latency_quantiles(requests, {"p95": 0.95}),
        "latency_hist": lambda: tm.cumulative_histogram(requests, "latency_s", LATENCY_BOUNDS, ["endpoint"]),
        "error_alert": lambda: tm.error_rate_alert(requests),
        "heartbeat_gaps": lambda: tm.heartbeat_gaps(requests, "endpoint"),
        "prediction_rate": lambda: tm.rates(predictions, ["model_version", "status"]),
        "throttle": lambda: throttle_marks(requests, "client", "ts", "request_id", 2, 86_400, 4),
        "champions": lambda: champion_history(runs, tolerance=0.05),
        "train_forest": lambda: train(replace(small, algorithm="forest")),
        "train_boosting": lambda: train(small),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = build_session("bench", f"local[{cpus}]", spark__driver__memory="16g", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name, build in jobs(spark, sf_dir).items():
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs[1:]), 3)
        print(f"{name}: first {runs[0]:.2f}s, then {timings[name]:.2f}s", file=sys.stderr)
    print(json.dumps({
        "metric": "total seconds of the headline jobs", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
