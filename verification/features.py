from pyspark.sql import functions as F

from meterflow import fixtures as fx
from meterflow.config import FEATURES, PICKUP, TARGET
from meterflow.functions.parsing import local_wall_clock
from meterflow.functions.trip_time import finished_prediction, plausible_speed, plus_minutes
from meterflow.operators.cleaning import clean_trips
from meterflow.operators.evaluation import flat_metrics, gated, regression_metrics
from meterflow.operators.features import scoring_features, timed_trips, training_features
from meterflow.operators.splitting import split_by_ratio
from verification import query
from verification.tables import HIST_FEATURES, RAW_CLEAN, RAW_FEATURES, TRIPS_RAW

_ROUNDED = ("pickup_hour_sin", "pickup_hour_cos", TARGET)
_FEATURE_SQL = ", ".join(f"round({c}, 6) + 0.0e0 AS {c}" if c in _ROUNDED else c for c in FEATURES)


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in _ROUNDED if c in df.columns})


@query("features", f"""{RAW_FEATURES} SELECT trip_id, {_FEATURE_SQL},
 round(trip_duration_minutes, 6) AS trip_duration_minutes, pickup_datetime FROM featured""")
def features(spark, sf_dir):
    """Training features, target and pickup time of cleaned trips."""
    return _rounded(training_features(clean_trips(fx.trips_raw(spark, sf_dir)), keep=["trip_id"]))


@query("features_history", f"""{HIST_FEATURES} SELECT pickup_month, pickup_hour, is_weekend, is_rush_hour,
 count(*) AS trips, round(avg(trip_duration_minutes), 6) AS avg_minutes, count(DISTINCT PU_DO_pair) AS pairs
 FROM featured GROUP BY ALL""")
def features_history(spark, sf_dir):
    """Features of the long history, summarised by derived time columns."""
    table = training_features(clean_trips(fx.trips_hist(spark, sf_dir)))
    return table.groupBy("pickup_month", "pickup_hour", "is_weekend", "is_rush_hour").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.avg(TARGET), 6).alias("avg_minutes"),
        F.countDistinct("PU_DO_pair").alias("pairs"))


@query("trip_duration", f"""WITH {TRIPS_RAW} SELECT trip_id,
 round(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 6e7, 6) AS trip_duration_minutes
 FROM trips_raw WHERE tpep_dropoff_datetime IS NOT NULL""")
def trip_duration(spark, sf_dir):
    """Fractional minutes between pickup and drop-off."""
    timed = timed_trips(fx.trips_raw(spark, sf_dir)).filter(F.col(TARGET).isNotNull())
    return timed.select("trip_id", F.round(TARGET, 6).alias(TARGET))


@query("speed_filter", f"""{RAW_CLEAN} SELECT
 count(*) FILTER (NOT (trip_distance / (minutes / 60.0e0) <= 75)) AS too_fast,
 count(*) FILTER (minutes > 15 AND trip_distance / (minutes / 60.0e0) < 1) AS too_slow,
 count(*) FILTER (trip_distance / (minutes / 60.0e0) <= 75 AND (minutes <= 15 OR trip_distance / (minutes / 60.0e0) >= 1)) AS plausible
 FROM cleaned""")
def speed_filter(spark, sf_dir):
    """Trips that are too fast or too slow to be real."""
    from meterflow.config import CleaningLimits

    timed = timed_trips(clean_trips(fx.trips_raw(spark, sf_dir)))
    minutes, distance = F.col(TARGET), F.col("trip_distance")
    any_speed = CleaningLimits(max_mph=float("inf"))
    any_slow = CleaningLimits(min_mph=0.0)
    return timed.agg(
        F.count_if(~plausible_speed(distance, minutes, any_slow)).alias("too_fast"),
        F.count_if(~plausible_speed(distance, minutes, any_speed)).alias("too_slow"),
        F.count_if(plausible_speed(distance, minutes, CleaningLimits())).alias("plausible"))


@query("pu_do_top", f"""{HIST_FEATURES} SELECT PU_DO_pair, count(*) AS trips FROM featured GROUP BY ALL
 ORDER BY trips DESC, PU_DO_pair LIMIT 20""")
def pu_do_top(spark, sf_dir):
    """The busiest zone pairs."""
    table = training_features(clean_trips(fx.trips_hist(spark, sf_dir)))
    return (table.groupBy("PU_DO_pair").agg(F.count(F.lit(1)).alias("trips"))
            .orderBy(F.desc("trips"), "PU_DO_pair").limit(20))


@query("category_sizes", f"""{HIST_FEATURES} SELECT count(DISTINCT VendorID) AS VendorID,
 count(DISTINCT PULocationID) AS PULocationID, count(DISTINCT DOLocationID) AS DOLocationID,
 count(DISTINCT PU_DO_pair) AS PU_DO_pair FROM featured""")
def category_sizes(spark, sf_dir):
    """Distinct values of each categorical feature."""
    from meterflow.models.encoding import category_sizes as sizes

    return sizes(training_features(clean_trips(fx.trips_hist(spark, sf_dir))))


@query("scoring_features", f"""{RAW_FEATURES} SELECT trip_id, pickup_hour, PU_DO_pair, trip_distance,
 is_rush_hour, 0 AS airport_flag FROM featured""")
def scoring_features_query(spark, sf_dir):
    """Features aligned to a model's own column order; columns it expects in vain become 0."""
    cleaned = training_features(clean_trips(fx.trips_raw(spark, sf_dir)), keep=["trip_id"])
    asked = cleaned.select("trip_id", "pickup_datetime", "trip_distance", "PULocationID", "DOLocationID")
    return scoring_features(
        asked, ["pickup_hour", "PU_DO_pair", "trip_distance", "is_rush_hour", "airport_flag"], keep=["trip_id"])


@query("local_wall_clock", """SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS zoned,
 ts AS unzoned FROM events""")
def local_wall_clock_query(spark, sf_dir):
    """Zoned times moved to the local wall clock, times without a zone left alone."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = events.select("event_id", F.col("ts").cast("string").alias("plain"),
                         F.concat(F.col("ts").cast("string"), F.lit("+00:00")).alias("with_zone"))
    return text.select("event_id", local_wall_clock(text, "with_zone").alias("zoned"),
                       local_wall_clock(text, "plain").alias("unzoned"))


@query("finished_predictions", f"""{RAW_CLEAN} SELECT trip_id,
 greatest(1.0e0, round(trip_distance * 2, 2)) AS predicted_duration_minutes,
 tpep_pickup_datetime + to_microseconds(CAST(round(greatest(1.0e0, round(trip_distance * 2, 2)) * 6e7) AS BIGINT))
 AS estimated_dropoff_datetime FROM cleaned""")
def finished_predictions(spark, sf_dir):
    """Clamped, rounded minutes and the arrival they imply."""
    cleaned = clean_trips(fx.trips_raw(spark, sf_dir))
    minutes = finished_prediction(F.col("trip_distance") * 2)
    return cleaned.select("trip_id", minutes.alias("predicted_duration_minutes"),
                          plus_minutes(F.col(PICKUP), minutes).alias("estimated_dropoff_datetime"))


@query("log_target", f"""{RAW_FEATURES} SELECT trip_id, round(ln(1 + trip_duration_minutes), 6) AS log_minutes,
 round(exp(ln(1 + trip_duration_minutes)) - 1, 6) AS minutes FROM featured""")
def log_target(spark, sf_dir):
    """Log-scaled target and its way back."""
    from meterflow.models.encoding import from_log, to_log

    table = training_features(clean_trips(fx.trips_raw(spark, sf_dir)), keep=["trip_id"])
    scaled = to_log(F.col(TARGET))
    return table.select("trip_id", F.round(scaled, 6).alias("log_minutes"), F.round(from_log(scaled), 6).alias("minutes"))


_SPLIT = """placed AS (SELECT *, row_number() OVER (ORDER BY pickup_datetime, trip_id, trip_distance, total_amount) AS rn,
 count(*) OVER () AS n FROM featured),
 parts AS (SELECT *, CASE WHEN rn <= floor(n * 0.7e0) THEN 'train'
 WHEN rn <= floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'validation' ELSE 'test' END AS split FROM placed)"""
_ERRORS = """errors AS (SELECT split, trip_duration_minutes AS y, 3 + 4 * trip_distance AS p FROM parts),
 scored AS (SELECT split, count(*) AS rows, avg(abs(p - y)) AS mae, sqrt(avg((p - y) * (p - y))) AS rmse,
 1 - avg((p - y) * (p - y)) / var_pop(y) AS r2 FROM errors GROUP BY split)"""


def _split_errors(spark, sf_dir):
    trips = clean_trips(fx.trips_hist(spark, sf_dir))
    table = training_features(trips, keep=["trip_id", "total_amount"])
    split = split_by_ratio(table, order=("pickup_datetime", "trip_id", "trip_distance", "total_amount"))
    scored = split.withColumn("prediction", 3 + 4 * F.col("trip_distance"))
    return regression_metrics(scored, by=["split"])


@query("eval_metrics", f"""{HIST_FEATURES}, {_SPLIT}, {_ERRORS}
 SELECT split, rows, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM scored""")
def eval_metrics(spark, sf_dir):
    """MAE, RMSE and R2 of a fixed linear predictor on each split part."""
    return _split_errors(spark, sf_dir).select(
        "split", "rows", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


@query("eval_flat", f"""{HIST_FEATURES}, {_SPLIT}, {_ERRORS} SELECT
 round(max(mae) FILTER (split = 'validation'), 6) AS val_mae, round(max(rmse) FILTER (split = 'validation'), 6) AS val_rmse,
 round(max(r2) FILTER (split = 'validation'), 6) AS val_r2, round(max(mae) FILTER (split = 'test'), 6) AS test_mae,
 round(max(rmse) FILTER (split = 'test'), 6) AS test_rmse, round(max(r2) FILTER (split = 'test'), 6) AS test_r2 FROM scored""")
def eval_flat(spark, sf_dir):
    """Validation and test metrics in one row."""
    flat = flat_metrics(_split_errors(spark, sf_dir))
    return flat.select(*[F.round(c, 6).alias(c) for c in flat.columns])


@query("quality_gate", """SELECT o_orderpriority AS model, o_orderkey AS version,
 NOT (o_totalprice / 50000.0e0 > 8.0) AND NOT ((o_custkey % 100) / 100.0e0 < 0.30) AS passed,
 concat_ws(',', CASE WHEN o_totalprice / 50000.0e0 > 8.0 THEN 'val_mae above maximum' END,
  CASE WHEN (o_custkey % 100) / 100.0e0 < 0.30 THEN 'val_r2 below minimum' END) AS reasons FROM orders""")
def quality_gate(spark, sf_dir):
    """Every model run against the gate."""
    return gated(fx.model_runs(spark, sf_dir)).select(
        "model", "version", "passed", F.array_join("gate_reasons", ",").alias("reasons"))
