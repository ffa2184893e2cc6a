from datetime import date, datetime

from pyspark.sql import functions as F

from meterflow import fixtures as fx
from meterflow.config import LATENCY_BOUNDS, ModelSettings, PICKUP
from meterflow.models.scoring import score_requests
from meterflow.models.training import train_model
from meterflow.operators.cleaning import clean_trips
from meterflow.operators.features import training_features
from meterflow.session import scratch_path
from meterflow.streaming.cleaning import accepted_rows, clean_stream, feature_stream, rejected_rows
from meterflow.streaming.drift import rolling_drift_stream, windowed_drift
from meterflow.streaming.pickup import append_files, landed_stream
from meterflow.streaming.telemetry import client_sessions, request_windows
from meterflow.streaming.throttle import throttle_stream
from verification import query
from verification.drift import DISTANCE_REF, ROLLING_SQL, _bucket_sql, _psi_sql, _severity_sql, arrivals
from verification.tables import KEPT, RAW_CLEAN, RAW_FEATURES, REQUESTS, TRIPS_RAW, flagged
from verification.telemetry import SESSIONS_SQL, THROTTLE_SQL

_CUTS = (datetime(2024, 1, 11), datetime(2024, 1, 21))


def fed(spark, table, time, start):
    """Land a table in three periods; after each, ``start(stream, out, checkpoint)`` drains what is new."""
    landing, out, checkpoint = (scratch_path(spark, name) for name in ("landing", "out", "checkpoint"))
    edges = [None, *_CUTS, None]
    for low, high in zip(edges, edges[1:]):
        part = table
        if low is not None:
            part = part.filter(F.col(time) >= F.lit(low).cast("timestamp_ntz"))
        if high is not None:
            part = part.filter(F.col(time) < F.lit(high).cast("timestamp_ntz"))
        part.write.mode("append").parquet(landing)
        start(landed_stream(spark, landing, table.schema), out, checkpoint)
    return out


def appended(transform):
    return lambda stream, out, checkpoint: append_files(transform(stream), out, checkpoint)


@query("stream_pickup", f"WITH {TRIPS_RAW} SELECT trip_id, trip_distance FROM trips_raw")
def stream_pickup(spark, sf_dir):
    """Every landed file exactly once over three runs."""
    trips = fx.trips_raw(spark, sf_dir)
    out = fed(spark, trips, PICKUP, appended(lambda s: s.select("trip_id", "trip_distance")))
    return spark.read.parquet(out)


@query("stream_clean", f"""{RAW_CLEAN} SELECT trip_id, VendorID, trip_distance, tpep_dropoff_datetime FROM cleaned""")
def stream_clean(spark, sf_dir):
    """Accepted rows of the cleaning stream."""
    out = fed(spark, fx.trips_raw(spark, sf_dir), PICKUP, clean_stream)
    return accepted_rows(spark, out).select("trip_id", "VendorID", "trip_distance", "tpep_dropoff_datetime")


@query("stream_rejects", f"""WITH {TRIPS_RAW}, {flagged('trips_raw')} SELECT trip_id,
 concat_ws(',', CASE WHEN NOT ok_timestamps THEN 'timestamps' END, CASE WHEN NOT ok_duration THEN 'duration' END,
  CASE WHEN NOT ok_distance THEN 'distance' END, CASE WHEN NOT ok_passengers THEN 'passengers' END,
  CASE WHEN NOT ok_monetary THEN 'monetary' END) AS reasons FROM flagged WHERE NOT ({KEPT})""")
def stream_rejects(spark, sf_dir):
    """Rejected rows of the cleaning stream."""
    out = fed(spark, fx.trips_raw(spark, sf_dir), PICKUP, clean_stream)
    return rejected_rows(spark, out).select("trip_id", F.array_join("reject_reasons", ",").alias("reasons"))


@query("stream_reports", f"""WITH {TRIPS_RAW}, {flagged('trips_raw')} SELECT CASE
 WHEN tpep_pickup_datetime < TIMESTAMP '2024-01-11' THEN 0 WHEN tpep_pickup_datetime < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS batch,
 count(*) AS initial_rows, count(*) FILTER ({KEPT}) AS cleaned_rows, count(*) FILTER (NOT ok_duration) AS invalid_duration
 FROM flagged GROUP BY ALL""")
def stream_reports(spark, sf_dir):
    """Quality report of each batch, observed on its write."""
    out = fed(spark, fx.trips_raw(spark, sf_dir), PICKUP, clean_stream)
    return spark.read.json(f"{out}/reports").select("batch", "initial_rows", "cleaned_rows", "invalid_duration")


@query("stream_features", f"""{RAW_FEATURES} SELECT trip_id, pickup_hour, PU_DO_pair,
 round(trip_duration_minutes, 6) AS trip_duration_minutes FROM featured""")
def stream_features(spark, sf_dir):
    """Features of the cleaned stream."""
    out = fed(spark, fx.trips_raw(spark, sf_dir), PICKUP, appended(lambda s: feature_stream(s).select(
        "trip_id", "pickup_hour", "PU_DO_pair", F.round("trip_duration_minutes", 6).alias("trip_duration_minutes"))))
    return spark.read.parquet(out)


@query("stream_rolling_psi", ROLLING_SQL)
def stream_rolling_psi(spark, sf_dir):
    """Rolling drift continued over three runs equals the batch result."""
    out = fed(spark, arrivals(spark, sf_dir), "arrived_at",
              lambda s, o, c: rolling_drift_stream(s, ("arrived_at", "trip_id"), o, c))
    points = spark.read.parquet(f"{out}/points").drop("batch")
    return points.withColumn("psi", F.round("psi", 6) + F.lit(0.0))


def _windowed_sql(steps: int) -> str:
    """Windows of ``steps`` days starting every day, once the watermark of an hour has passed their end."""
    return f"""WITH {TRIPS_RAW}, {DISTANCE_REF},
 seen AS (SELECT date_trunc('day', tpep_pickup_datetime) - to_days(CAST(s.d AS INT)) AS w,
  {_bucket_sql('trip_distance', (0.5, 1.0, 2.0, 3.0, 5.0, 10.0, 15.0, 20.0, 30.0, 50.0))} AS b
  FROM trips_raw CROSS JOIN (SELECT unnest(range({steps})) AS d) AS s),
 closed AS (SELECT DISTINCT w FROM seen WHERE w + to_days({steps}) <=
  (SELECT date_trunc('millisecond', max(tpep_pickup_datetime)) - INTERVAL 1 HOUR FROM trips_raw)),
 counts AS (SELECT p.w, g.b, count(s.b) AS c FROM closed p CROSS JOIN range(11) AS g(b)
  LEFT JOIN seen s ON s.w = p.w AND s.b = g.b GROUP BY ALL)
 SELECT w AS window_start, w + to_days({steps}) AS window_end, 'trip_distance' AS feature,
 CAST(window_rows AS BIGINT) AS rows, round(psi, 6) + 0.0e0 AS psi, {_severity_sql('psi')} AS severity
 FROM {_psi_sql('counts', 'w', 'distance_ref')}"""


def _windowed(spark, sf_dir, window, slide):
    out = fed(spark, arrivals(spark, sf_dir), "arrived_at", appended(
        lambda s: windowed_drift(s.withColumn("arrived_at", F.col("arrived_at").cast("timestamp")), "arrived_at", window, slide, watermark="1 hour")))
    return _plain(spark.read.parquet(out).withColumn("psi", F.round("psi", 6) + F.lit(0.0)), "window_start", "window_end")


def _plain(df, *times):
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


@query("stream_window_psi", _windowed_sql(1))
def stream_window_psi(spark, sf_dir):
    """Drift in tumbling event-time days."""
    return _windowed(spark, sf_dir, "1 day", None)


@query("stream_sliding_psi", _windowed_sql(3))
def stream_sliding_psi(spark, sf_dir):
    """Drift in event-time windows of three days, sliding by one."""
    return _windowed(spark, sf_dir, "3 days", "1 day")


@query("stream_request_windows", f"""WITH {REQUESTS}, spread AS (SELECT date_trunc('hour', ts) - to_hours(CAST(s.h AS INT)) AS w, status
 FROM requests CROSS JOIN (SELECT unnest(range(5)) AS h) AS s)
 SELECT w AS window_start, count(*) AS requests, count(*) FILTER (status BETWEEN 500 AND 599) AS errors,
 round(count(*) FILTER (status BETWEEN 500 AND 599) / count(*), 6) AS error_ratio FROM spread
 WHERE w + INTERVAL 5 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM requests) GROUP BY w""")
def stream_request_windows(spark, sf_dir):
    """Requests and error share in sliding event-time windows."""
    out = fed(spark, fx.requests(spark, sf_dir), "ts", appended(lambda s: request_windows(
        s.withColumn("ts", F.col("ts").cast("timestamp")), window="5 hours", slide="1 hour", bounds=LATENCY_BOUNDS)))
    windows = _plain(spark.read.parquet(out), "window_start")
    return windows.select("window_start", "requests", "errors", F.round("error_ratio", 6).alias("error_ratio"))


@query("stream_throttle", THROTTLE_SQL)
def stream_throttle(spark, sf_dir):
    """The sliding limit as keyed state equals the batch marks."""
    table = fx.requests(spark, sf_dir).select("client", "request_id", "ts")
    out = fed(spark, table, "ts", appended(lambda s: throttle_stream(
        s.withColumn("ts", F.col("ts").cast("timestamp")), "client", "ts", "request_id", 2, 86_400, "1 day")))
    return spark.read.parquet(out).select("client", "request_id", "admitted")


@query("client_sessions", SESSIONS_SQL)
def client_sessions_query(spark, sf_dir):
    """Client activity between silences of an hour."""
    return client_sessions(fx.requests(spark, sf_dir), gap="1 hour", watermark=None)


@query("stream_scoring")
def stream_scoring(spark, sf_dir):
    """Requests scored as they land."""
    table = training_features(clean_trips(fx.trips_hist(spark, sf_dir)), keep=["trip_id"])
    model = train_model(table, ModelSettings(algorithm="forest", trees=2, max_depth=4, subsample_rows=None))
    asked = fx.trips_raw(spark, sf_dir).withColumnRenamed(PICKUP, "pickup_datetime")
    out = fed(spark, asked, "pickup_datetime", appended(lambda s: score_requests(
        model, s, date(2026, 1, 1), "v1", "forest")))
    return spark.read.parquet(out)
