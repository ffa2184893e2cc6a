"""Telemetry windows and client sessions on streams."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.config import LATENCY_BOUNDS
from meterflow.functions.histograms import bound_index, bucket_quantile, running_totals


def request_windows(stream: DataFrame, time: str = "ts", watermark: str = "10 minutes", window: str = "5 minutes",
                    slide: str = "1 minute", bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Requests, rate, error share and p95 latency of each sliding window; one row of counts is the state."""
    bucket = bound_index(F.col("latency_s"), bounds)
    names = [f"_n{i}" for i in range(len(bounds) + 1)]
    counted = stream.withWatermark(time, watermark).groupBy(F.window(time, window, slide).alias("window")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status").between(500, 599)).alias("errors"),
        *[F.count_if(bucket == i).alias(name) for i, name in enumerate(names)])
    counts = [F.col(name) for name in names]
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "requests", "errors",
        (F.col("errors") / F.col("requests")).alias("error_ratio"),
        running_totals(counts)[-1].alias("timed"), bucket_quantile(0.95, counts, bounds).alias("p95"))


def client_sessions(stream: DataFrame, client: str = "client", time: str = "ts", gap: str = "60 seconds",
                    watermark: str | None = "10 minutes") -> DataFrame:
    """Activity of each client between silences longer than ``gap``."""
    if watermark:
        stream = stream.withWatermark(time, watermark)
    sessions = stream.groupBy(client, F.session_window(time, gap).alias("session")).agg(F.count(F.lit(1)).alias("requests"))
    return sessions.select(client, F.col("session.start").alias("session_start"),
                           F.col("session.end").alias("session_end"), "requests")
