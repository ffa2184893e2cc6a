"""Drift on streams: count-based windows carried across batches, and event-time windows."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.config import DriftSettings
from meterflow.functions.histograms import bucket_counts, bucket_index, severity
from meterflow.operators.drift import (
    DISTANCE, DURATION, Monitored, positioned_buckets, windows_of_positions, with_drift_index,
)
from meterflow.session import materialise
from meterflow.streaming.pickup import each_batch


def rolling_drift_stream(stream: DataFrame, order: Sequence[str], out: str, checkpoint: str,
                         features: Sequence[Monitored] = (DISTANCE, DURATION),
                         settings: DriftSettings = DriftSettings()) -> StreamingQuery:
    """The last ``window_rows`` arrivals at every ``every``-th arrival, continued over batches and restarts.

    Between batches only the last window of bucket numbers is kept, stored by batch number, so a
    repeated batch starts from the same state. Within a batch the work is the distributed operator.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            carried = spark.read.parquet(f"{out}/state/{number - 1}")
        except AnalysisException:
            carried = None
        seen = carried.agg(F.max("row_index").alias("seen")).first().seen or 0 if carried else 0
        placed = positioned_buckets(batch, features, order).withColumn("row_index", F.col("row_index") + seen)
        whole = materialise(placed.unionByName(carried) if carried else placed, "arrivals")
        points = windows_of_positions(whole, features, settings).filter(F.col("row_index") > seen)
        points.write.mode("overwrite").parquet(f"{out}/points/batch={number}")
        last = whole.agg(F.max("row_index").alias("last")).first().last or 0
        tail = whole.filter(F.col("row_index") > last - settings.window_rows)
        tail.coalesce(1).write.mode("overwrite").parquet(f"{out}/state/{number}")

    return each_batch(stream, write, checkpoint)


def windowed_drift(df: DataFrame, time: str, window: str, slide: str | None = None, feature: Monitored = DISTANCE,
                   settings: DriftSettings = DriftSettings(), watermark: str | None = None,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Drift per event-time window, tumbling or sliding, of a table or a stream.

    The state per window is one row of bucket counts. On a stream, rows later than the watermark are
    dropped and a window appears once the watermark has passed its end.
    """
    if watermark:
        df = df.withWatermark(time, watermark)
    bucket = bucket_index(F.col(feature.column), feature.edges)
    span = F.window(time, window, slide) if slide else F.window(time, window)
    counted = df.groupBy(*keys, span.alias("window")).agg(*bucket_counts(bucket, feature.buckets))
    scored = with_drift_index(counted, feature.names, feature, settings, "rows", "psi").filter("rows > 0")
    return scored.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         F.lit(feature.column).alias("feature"), "rows", "psi",
                         severity(F.col("psi"), settings).alias("severity"))
