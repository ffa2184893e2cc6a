"""Trip, request and model-run tables derived row by row from the given test tables."""

from pyspark.sql import DataFrame, SparkSession

from meterflow.session import prepare, scratch_path

# One statement per table; the words in braces are the only parts that differ between SQL engines.
TRIPS_RAW = """
WITH e AS (SELECT event_id, {trunc} AS p, user_id, value, {k} AS k FROM {events})
SELECT event_id AS trip_id, event_id % 2 + 1 AS VendorID, p AS tpep_pickup_datetime,
 CASE WHEN k = 6 THEN NULL ELSE {dropoff} END AS tpep_dropoff_datetime,
 CASE k WHEN 9 THEN 0 WHEN 10 THEN 10 WHEN 11 THEN NULL ELSE event_id % 6 + 1 END AS passenger_count,
 CASE k WHEN 0 THEN 0.0e0 WHEN 1 THEN -1.0e0 WHEN 2 THEN 150.0e0
        WHEN 8 THEN value / 1000.0e0 ELSE value / 10.0e0 END AS trip_distance,
 user_id % 265 + 1 AS PULocationID, (user_id * 31 + k) % 265 + 1 AS DOLocationID,
 event_id % 4 + 1 AS payment_type,
 CASE k WHEN 12 THEN -5.0e0 ELSE 3.0e0 + value / 4.0e0 END AS fare_amount,
 CASE k WHEN 13 THEN 0.0e0 ELSE 5.5e0 + value / 4.0e0 END AS total_amount
FROM e
"""
TRIPS_RAW_SECONDS = """CASE k WHEN 3 THEN 30 WHEN 4 THEN 14400 WHEN 5 THEN -600 WHEN 7 THEN 120
 WHEN 8 THEN 3600 ELSE 120 + 6 * k + CAST(floor(value * 18.0e0) AS BIGINT) END"""

TRIPS_HIST = """
WITH b AS (SELECT *, ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS trip_id,
  (l_partkey * 7 + l_suppkey) % 100 AS k, {pickup} AS p FROM {lineitem})
SELECT trip_id, CASE WHEN l_linestatus = 'O' THEN 'green' ELSE 'yellow' END AS dataset,
 l_suppkey % 2 + 1 AS VendorID, p AS pickup_datetime,
 CASE WHEN k = 6 THEN NULL ELSE {dropoff} END AS dropoff_datetime,
 CASE k WHEN 9 THEN 0 WHEN 10 THEN 10 WHEN 11 THEN NULL ELSE l_orderkey % 6 + 1 END AS passenger_count,
 CASE k WHEN 0 THEN 0.0e0 WHEN 1 THEN -1.0e0 WHEN 2 THEN 150.0e0 WHEN 8 THEN l_quantity / 100.0e0
        ELSE l_quantity / 5.0e0 + l_discount * 10.0e0 END AS trip_distance,
 l_partkey % 265 + 1 AS PULocationID, (l_suppkey * 31 + k) % 265 + 1 AS DOLocationID,
 l_linenumber % 4 + 1 AS payment_type,
 CASE k WHEN 12 THEN -5.0e0 ELSE 3.0e0 + l_quantity / 2.0e0 END AS fare_amount,
 CASE k WHEN 13 THEN 0.0e0 ELSE 5.5e0 + l_quantity / 2.0e0 END AS total_amount
FROM b
"""
TRIPS_HIST_SECONDS = """CASE k WHEN 3 THEN 30 WHEN 4 THEN 14400 WHEN 5 THEN -600 WHEN 7 THEN 120
 WHEN 8 THEN 3600 ELSE 120 + 6 * k + CAST(floor(l_quantity * 40.0e0) AS BIGINT) END"""
TRIPS_HIST_OFFSET = "(l_orderkey * 7919 + l_linenumber * 3607 + l_partkey * 31 + l_suppkey) % 86400"

REQUESTS = """
SELECT event_id AS request_id, ts, user_id AS client,
 CASE event_type WHEN 'click' THEN '/predict' WHEN 'view' THEN '/predict' WHEN 'error' THEN '/predict'
                 WHEN 'purchase' THEN '/predict/batch' ELSE '/unknown' END AS endpoint,
 CASE WHEN event_type = 'signup' THEN 'GET' ELSE 'POST' END AS method,
 CASE WHEN event_type = 'error' THEN 500 WHEN event_id % 50 = 0 THEN 422 ELSE 200 END AS status,
 value / 100.0e0 AS latency_s
FROM {events}
"""

# The order key numbers the runs, so no window over the whole history of a model is needed.
MODEL_RUNS = """
SELECT o_orderpriority AS model, o_orderkey AS version, o_totalprice / 50000.0e0 AS val_mae,
 (o_custkey % 100) / 100.0e0 AS val_r2
FROM {orders}
"""

# Predictions as a fixed linear rule, so that any engine can repeat them.
PREDICTIONS = """
SELECT event_id AS trip_id, ts, {hour} AS batch_start,
 CASE event_id % 3 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2' ELSE 'v3' END AS model_version,
 CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
 value / 10.0e0 AS trip_distance, 3.0e0 + 0.4e0 * value AS predicted_duration_minutes
FROM {events}
"""


_LANDED: dict[tuple[str, str, str], str] = {}


def _derive(spark: SparkSession, sf_dir: str, name: str, source: str, sql: str) -> DataFrame:
    """Write a derived table once per session, so that every query starts from plain Parquet columns."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        rows = prepare(spark).sql(sql, **{source: spark.read.parquet(f"{sf_dir}/{source}.parquet")})
        parts = spark.sparkContext.defaultParallelism
        if rows.rdd.getNumPartitions() < parts:
            rows = rows.repartition(parts)
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        _LANDED[key] = path
    return prepare(spark).read.parquet(_LANDED[key])


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = TRIPS_RAW.format(
        trunc="CAST(date_trunc('SECOND', ts) AS TIMESTAMP_NTZ)",
        k="CAST(get_json_object(props, '$.k') AS INT)",
        dropoff=f"CAST(timestampadd(SECOND, {TRIPS_RAW_SECONDS}, p) AS TIMESTAMP_NTZ)",
        events="{events}",
    )
    return _derive(spark, sf_dir, "trips_raw", "events", sql)


def trips_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = TRIPS_HIST.format(
        pickup=f"CAST(timestampadd(SECOND, {TRIPS_HIST_OFFSET}, l_shipdate) AS TIMESTAMP_NTZ)",
        dropoff=f"CAST(timestampadd(SECOND, {TRIPS_HIST_SECONDS}, p) AS TIMESTAMP_NTZ)",
        lineitem="{lineitem}",
    )
    return _derive(spark, sf_dir, "trips_hist", "lineitem", sql)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "requests", "events", REQUESTS)


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "model_runs", "orders", MODEL_RUNS)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = PREDICTIONS.format(hour="CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)", events="{events}")
    return _derive(spark, sf_dir, "predictions", "events", sql)
