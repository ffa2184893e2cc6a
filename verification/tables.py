"""The derived tables as SQL for the checking engine."""

from meterflow import fixtures as fx

TRIPS_RAW = "trips_raw AS (" + fx.TRIPS_RAW.format(
    trunc="date_trunc('second', ts)",
    k="CAST(json_extract_string(props, '$.k') AS INT)",
    dropoff=f"p + to_seconds({fx.TRIPS_RAW_SECONDS})",
    events="events",
) + ")"
TRIPS_HIST = "trips_hist AS (" + fx.TRIPS_HIST.format(
    pickup=f"l_shipdate + to_seconds({fx.TRIPS_HIST_OFFSET})",
    dropoff=f"p + to_seconds({fx.TRIPS_HIST_SECONDS})",
    lineitem="lineitem",
) + ")"
REQUESTS = "requests AS (" + fx.REQUESTS.format(events="events") + ")"
MODEL_RUNS = "model_runs AS (" + fx.MODEL_RUNS.format(orders="orders") + ")"
PREDICTIONS = "predictions AS (" + fx.PREDICTIONS.format(hour="date_trunc('hour', ts)", events="events") + ")"


def flagged(source: str, pickup: str = "tpep_pickup_datetime", dropoff: str = "tpep_dropoff_datetime") -> str:
    """Rule flags, false for missing values."""
    minutes = f"(date_diff('microsecond', {pickup}, {dropoff}) / 6e7)"
    return f"""flagged AS (SELECT *, {minutes} AS minutes,
 ({pickup} IS NOT NULL AND {dropoff} IS NOT NULL) AS ok_timestamps,
 coalesce({minutes} BETWEEN 1 AND 180, false) AS ok_duration,
 coalesce(trip_distance > 0 AND trip_distance <= 100, false) AS ok_distance,
 coalesce(passenger_count BETWEEN 1 AND 9, false) AS ok_passengers,
 coalesce(fare_amount > 0 AND total_amount > 0, false) AS ok_monetary
 FROM {source})"""


KEPT = "ok_timestamps AND ok_duration AND ok_distance AND ok_passengers AND ok_monetary"
CLEANED = f"cleaned AS (SELECT * FROM flagged WHERE {KEPT})"


def featured(pickup: str = "tpep_pickup_datetime") -> str:
    """Speed filter and features over ``cleaned``."""
    dow, hour = f"(isodow({pickup}) - 1)", f"hour({pickup})"
    return f"""featured AS (SELECT trip_id, VendorID, passenger_count, trip_distance, PULocationID, DOLocationID,
 {hour} AS pickup_hour, {dow} AS pickup_day_of_week, month({pickup}) AS pickup_month, day({pickup}) AS pickup_day,
 CAST({dow} >= 5 AS INT) AS is_weekend,
 sin(2 * pi() * {hour} / 24.0e0) AS pickup_hour_sin, cos(2 * pi() * {hour} / 24.0e0) AS pickup_hour_cos,
 CAST({dow} < 5 AND {hour} IN (7, 8, 9, 16, 17, 18, 19) AS INT) AS is_rush_hour,
 PULocationID || '_' || DOLocationID AS PU_DO_pair, minutes AS trip_duration_minutes, {pickup} AS pickup_datetime,
 total_amount
 FROM cleaned WHERE trip_distance / (minutes / 60.0e0) <= 75 AND (minutes <= 15 OR trip_distance / (minutes / 60.0e0) >= 1))"""


RAW_CLEAN = f"WITH {TRIPS_RAW}, {flagged('trips_raw')}, {CLEANED}"
HIST_CLEAN = f"WITH {TRIPS_HIST}, {flagged('trips_hist', 'pickup_datetime', 'dropoff_datetime')}, {CLEANED}"
RAW_FEATURES = f"{RAW_CLEAN}, {featured()}"
HIST_FEATURES = f"{HIST_CLEAN}, {featured('pickup_datetime')}"
