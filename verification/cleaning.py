from datetime import date

from pyspark.sql import functions as F

from meterflow import fixtures as fx
from meterflow.config import DROPOFF, PICKUP, RAW_REQUIRED
from meterflow.functions.parsing import lenient_number, lenient_timestamp, with_canonical_times
from meterflow.operators.cleaning import clean_trips, cleaning_report, cleaning_rules, parsed_trips, rejected_trips
from meterflow.operators.requests import checked_requests
from meterflow.operators.validation import missing_counts, null_shares, target_counts, violation_counts
from verification import query
from verification.tables import CLEANED, HIST_CLEAN, KEPT, RAW_CLEAN, TRIPS_HIST, TRIPS_RAW, flagged

_REPORT = f"""count(*) AS initial_rows, count(*) FILTER ({KEPT}) AS cleaned_rows,
 count(*) FILTER (NOT ({KEPT})) AS dropped_rows,
 round(count(*) FILTER (NOT ({KEPT})) * 100.0e0 / count(*), 2) AS loss_percentage,
 count(*) FILTER (NOT ok_timestamps) AS invalid_timestamps, count(*) FILTER (NOT ok_duration) AS invalid_duration,
 count(*) FILTER (NOT ok_distance) AS invalid_distance, count(*) FILTER (NOT ok_passengers) AS invalid_passengers,
 count(*) FILTER (NOT ok_monetary) AS invalid_monetary"""


def _flat_report(report, *keys):
    return report.select(*keys, "initial_rows", "cleaned_rows", "dropped_rows", "loss_percentage", "dropped_details.*")


@query("clean_report", f"WITH {TRIPS_RAW}, {flagged('trips_raw')} SELECT {_REPORT} FROM flagged")
def clean_report(spark, sf_dir):
    """Quality report of one raw file: totals and independent counts per rule."""
    return _flat_report(cleaning_report(fx.trips_raw(spark, sf_dir)))


@query("clean_report_by_file", f"""WITH {TRIPS_HIST}, {flagged('trips_hist', 'pickup_datetime', 'dropoff_datetime')}
SELECT dataset, year(pickup_datetime) AS year, month(pickup_datetime) AS month, {_REPORT}
FROM flagged GROUP BY ALL""")
def clean_report_by_file(spark, sf_dir):
    """All monthly files reported in one job."""
    trips = fx.trips_hist(spark, sf_dir).withColumns({
        "year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    keys = ("dataset", "year", "month")
    return _flat_report(cleaning_report(trips, by=keys), *keys)


@query("clean_rows", f"""{RAW_CLEAN} SELECT trip_id, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
 CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance, PULocationID, DOLocationID, payment_type,
 fare_amount, total_amount FROM cleaned""")
def clean_rows(spark, sf_dir):
    """Rows passing all rules, in canonical types."""
    return clean_trips(fx.trips_raw(spark, sf_dir))


@query("clean_rows_history", f"""{HIST_CLEAN} SELECT dataset, CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS day,
 count(*) AS trips, round(avg(minutes), 6) AS avg_minutes, round(avg(trip_distance), 6) AS avg_distance
 FROM cleaned GROUP BY ALL""")
def clean_rows_history(spark, sf_dir):
    """Aliased time columns through cleaning, summarised per day."""
    from meterflow.functions.trip_time import minutes_between

    cleaned = clean_trips(fx.trips_hist(spark, sf_dir))
    minutes = minutes_between(F.col(PICKUP), F.col(DROPOFF))
    return cleaned.groupBy("dataset", F.to_date(PICKUP).cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.avg(minutes), 6).alias("avg_minutes"),
        F.round(F.avg("trip_distance"), 6).alias("avg_distance"))


@query("clean_days", f"""{RAW_CLEAN} SELECT CAST(CAST(tpep_pickup_datetime AS DATE) AS VARCHAR) AS pickup_day,
 count(*) AS trips, round(avg(minutes), 6) AS avg_minutes, round(avg(trip_distance), 6) AS avg_distance
 FROM cleaned GROUP BY ALL""")
def clean_days(spark, sf_dir):
    """Cleaned trips by pickup day."""
    from meterflow.functions.trip_time import minutes_between

    cleaned = clean_trips(fx.trips_raw(spark, sf_dir))
    return cleaned.groupBy(F.to_date(PICKUP).cast("string").alias("pickup_day")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(F.avg(minutes_between(F.col(PICKUP), F.col(DROPOFF))), 6).alias("avg_minutes"),
        F.round(F.avg("trip_distance"), 6).alias("avg_distance"))


def _rule_query(rule):
    @query(f"rule_{rule}", f"""WITH {TRIPS_RAW}, {flagged('trips_raw')}
    SELECT trip_id, tpep_pickup_datetime AS pickup, trip_distance, fare_amount FROM flagged WHERE ok_{rule}""")
    def passing(spark, sf_dir):
        parsed = parsed_trips(fx.trips_raw(spark, sf_dir))
        kept = parsed.filter(cleaning_rules(parsed)[rule])
        return kept.select("trip_id", F.col(PICKUP).alias("pickup"), "trip_distance", "fare_amount")


for _rule in ("timestamps", "duration", "distance", "passengers", "monetary"):
    _rule_query(_rule)


@query("clean_rejects", f"""WITH {TRIPS_RAW}, {flagged('trips_raw')} SELECT trip_id,
 concat_ws(',', CASE WHEN NOT ok_timestamps THEN 'timestamps' END, CASE WHEN NOT ok_duration THEN 'duration' END,
  CASE WHEN NOT ok_distance THEN 'distance' END, CASE WHEN NOT ok_passengers THEN 'passengers' END,
  CASE WHEN NOT ok_monetary THEN 'monetary' END) AS reasons
 FROM flagged WHERE NOT ({KEPT})""")
def clean_rejects(spark, sf_dir):
    """Dropped rows with every rule they fail."""
    return rejected_trips(fx.trips_raw(spark, sf_dir)).select(
        "trip_id", F.array_join("reject_reasons", ",").alias("reasons"))


@query("loss_audit", f"""WITH {TRIPS_HIST}, {flagged('trips_hist', 'pickup_datetime', 'dropoff_datetime')},
 r AS (SELECT dataset, year(pickup_datetime) AS year, month(pickup_datetime) AS month,
 count(*) FILTER (NOT ({KEPT})) * 100.0e0 / count(*) AS loss FROM flagged GROUP BY ALL)
 SELECT dataset, year, month, loss > 12.5 AS over_limit FROM r""")
def loss_audit(spark, sf_dir):
    """Which files lose more than a limit, compared unrounded."""
    from meterflow.config import CleaningLimits

    trips = fx.trips_hist(spark, sf_dir).withColumns({
        "year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    report = cleaning_report(trips, ("dataset", "year", "month"), CleaningLimits(max_loss_pct=12.5))
    return report.select("dataset", "year", "month", "over_limit")


_NULL_PCT = ", ".join(f"round(avg(CAST({c} IS NULL AS INT)) * 100, 6) AS null_pct_{c}" for c in RAW_REQUIRED)


@query("null_pct", f"WITH {TRIPS_RAW} SELECT {_NULL_PCT} FROM trips_raw")
def null_pct(spark, sf_dir):
    """Percentage of missing values of each required column."""
    shares = null_shares(fx.trips_raw(spark, sf_dir))
    return shares.select(*[F.round(c, 6).alias(c) for c in shares.columns])


_STRICT = """count(*) AS total_rows,
 count(*) FILTER (tpep_pickup_datetime IS NULL) AS invalid_tpep_pickup_datetime,
 count(*) FILTER (tpep_dropoff_datetime IS NULL) AS invalid_tpep_dropoff_datetime,
 count(*) FILTER (passenger_count IS NULL) AS non_numeric_passenger_count,
 count(*) FILTER (trip_distance IS NULL) AS non_numeric_trip_distance,
 count(*) FILTER (fare_amount IS NULL) AS non_numeric_fare_amount,
 count(*) FILTER (total_amount IS NULL) AS non_numeric_total_amount,
 count(*) FILTER (passenger_count < 0) AS negative_passenger_count,
 count(*) FILTER (trip_distance < 0) AS negative_trip_distance,
 count(*) FILTER (fare_amount < 0) AS negative_fare_amount,
 count(*) FILTER (total_amount < 0) AS negative_total_amount,
 count(*) FILTER (passenger_count <= 0 OR passenger_count > 9) AS bad_passenger_count,
 count(*) FILTER (trip_distance <= 0) AS bad_trip_distance,
 count(*) FILTER (tpep_dropoff_datetime <= tpep_pickup_datetime) AS dropoff_not_after_pickup"""


@query("strict_violations", f"WITH {TRIPS_RAW} SELECT {_STRICT} FROM trips_raw")
def strict_violations(spark, sf_dir):
    """Every strict rule's violations, from one scan."""
    counts = violation_counts(fx.trips_raw(spark, sf_dir))
    return counts.select(*[c for c in counts.columns if not c.startswith("null_pct_")])


@query("target_violations", f"""WITH {TRIPS_RAW}, {flagged('trips_raw')} SELECT count(*) AS total_rows,
 count(*) FILTER (NOT ok_timestamps) AS invalid_times, count(*) FILTER (minutes IS NULL) AS null_target,
 count(*) FILTER (minutes <= 0) AS non_positive_target, count(*) FILTER (minutes > 180) AS target_over_limit
 FROM flagged""")
def target_violations(spark, sf_dir):
    """Target checks of the feature job on uncleaned trips."""
    return target_counts(fx.trips_raw(spark, sf_dir))


_TEXT = """trips_text AS (SELECT trip_id, CAST(tpep_pickup_datetime AS VARCHAR) AS pickup_text,
 CASE WHEN trip_id % 7 = 0 THEN 'n/a' ELSE CAST(passenger_count AS VARCHAR) END AS passengers_text,
 CASE WHEN trip_id % 11 = 0 THEN 'not a time' ELSE CAST(tpep_dropoff_datetime AS VARCHAR) END AS dropoff_text
 FROM trips_raw)"""


@query("lenient_parse", f"""WITH {TRIPS_RAW}, {_TEXT} SELECT count(*) AS rows,
 count(TRY_CAST(passengers_text AS DOUBLE)) AS numbers, count(TRY_CAST(pickup_text AS TIMESTAMP)) AS pickups,
 count(TRY_CAST(dropoff_text AS TIMESTAMP)) AS dropoffs,
 CAST(sum(epoch(TRY_CAST(dropoff_text AS TIMESTAMP))) AS BIGINT) AS dropoff_seconds,
 sum(TRY_CAST(passengers_text AS DOUBLE)) AS passengers FROM trips_text""")
def lenient_parse(spark, sf_dir):
    """Text columns with unreadable values parsed to null."""
    bad_number, bad_time = F.col("trip_id") % 7 == 0, F.col("trip_id") % 11 == 0
    text = fx.trips_raw(spark, sf_dir).select(
        F.col(PICKUP).cast("string").alias("pickup_text"),
        F.when(bad_number, "n/a").otherwise(F.col("passenger_count").cast("string")).alias("passengers_text"),
        F.when(bad_time, "not a time").otherwise(F.col(DROPOFF).cast("string")).alias("dropoff_text"))
    dropoff, number = lenient_timestamp(text, "dropoff_text"), lenient_number(text, "passengers_text")
    return text.agg(
        F.count(F.lit(1)).alias("rows"), F.count(number).alias("numbers"),
        F.count(lenient_timestamp(text, "pickup_text")).alias("pickups"), F.count(dropoff).alias("dropoffs"),
        F.sum(F.unix_seconds(dropoff.cast("timestamp"))).alias("dropoff_seconds"), F.sum(number).alias("passengers"))


@query("time_aliases", f"""WITH {TRIPS_HIST} SELECT trip_id, pickup_datetime AS tpep_pickup_datetime,
 pickup_datetime FROM trips_hist""")
def time_aliases(spark, sf_dir):
    """Canonical pickup column from an alias; the alias stays."""
    return with_canonical_times(fx.trips_hist(spark, sf_dir)).select("trip_id", PICKUP, "pickup_datetime")



@query("canonical_types", f"""WITH {TRIPS_RAW}, {flagged('trips_raw')}, {CLEANED}
 SELECT trip_id, VendorID, CAST(passenger_count AS BIGINT) AS passenger_count,
 CAST(PULocationID AS BIGINT) AS PULocationID FROM cleaned""")
def canonical_types(spark, sf_dir):
    """Floating columns truncated to integers after cleaning."""
    trips = fx.trips_raw(spark, sf_dir).withColumns({
        "passenger_count": F.col("passenger_count") + F.lit(0.0), "PULocationID": F.col("PULocationID") + F.lit(0.5)})
    return clean_trips(trips).select("trip_id", "VendorID", "passenger_count", "PULocationID")


_REQUEST_RULES = """CASE WHEN NOT coalesce(VendorID BETWEEN 1 AND 2, false) THEN 'vendor' END,
 CASE WHEN NOT coalesce(year(pickup_datetime) BETWEEN 2020 AND 2027, false) THEN 'pickup' END,
 CASE WHEN NOT coalesce(passenger_count BETWEEN 1 AND 9, false) THEN 'passengers' END,
 CASE WHEN NOT coalesce(trip_distance > 0 AND trip_distance <= 100, false) THEN 'distance' END,
 CASE WHEN NOT coalesce(PULocationID BETWEEN 1 AND 265, false) THEN 'pickup_zone' END,
 CASE WHEN NOT coalesce(DOLocationID BETWEEN 1 AND 265, false) THEN 'dropoff_zone' END"""
_REQUEST_TABLE = """asked AS (SELECT trip_id, coalesce(CASE WHEN trip_id % 13 = 0 THEN 3 ELSE VendorID END, 1) AS VendorID,
 CASE WHEN trip_id % 17 = 0 THEN tpep_pickup_datetime - INTERVAL 8 YEAR ELSE tpep_pickup_datetime END AS pickup_datetime,
 coalesce(passenger_count, 1) AS passenger_count, trip_distance,
 CASE WHEN trip_id % 19 = 0 THEN 161 ELSE PULocationID END AS PULocationID,
 CASE WHEN trip_id % 23 = 0 THEN 266 ELSE DOLocationID END AS DOLocationID FROM trips_raw)"""


def _asked(spark, sf_dir):
    trips = fx.trips_raw(spark, sf_dir)
    odd = {n: F.col("trip_id") % n == 0 for n in (13, 17, 19, 23)}
    return trips.select(
        "trip_id", F.when(odd[13], 3).otherwise(F.col("VendorID")).alias("VendorID"),
        F.when(odd[17], F.col(PICKUP) - F.expr("INTERVAL 8 YEAR")).otherwise(F.col(PICKUP)).alias("pickup_datetime"),
        "passenger_count", "trip_distance",
        F.when(~odd[19], F.col("PULocationID")).alias("PULocationID"),
        F.when(odd[23], 266).otherwise(F.col("DOLocationID")).alias("DOLocationID"))


@query("request_rejects", f"""WITH {TRIPS_RAW}, {_REQUEST_TABLE}
 SELECT trip_id, concat_ws(',', {_REQUEST_RULES}) AS reasons FROM asked WHERE concat_ws(',', {_REQUEST_RULES}) <> ''""")
def request_rejects(spark, sf_dir):
    """Rejected scoring requests with all their reasons."""
    checked = checked_requests(_asked(spark, sf_dir), date(2026, 1, 1))
    return checked.filter(F.size("reject_reasons") > 0).select(
        "trip_id", F.array_join("reject_reasons", ",").alias("reasons"))


@query("request_accepted", f"""WITH {TRIPS_RAW}, {_REQUEST_TABLE} SELECT trip_id, VendorID, pickup_datetime,
 passenger_count, trip_distance, PULocationID, DOLocationID FROM asked WHERE concat_ws(',', {_REQUEST_RULES}) = ''""")
def request_accepted(spark, sf_dir):
    """Accepted scoring requests with defaults filled in."""
    checked = checked_requests(_asked(spark, sf_dir), date(2026, 1, 1))
    return checked.filter(F.size("reject_reasons") == 0).drop("reject_reasons")


@query("missing_values", f"""{RAW_CLEAN} SELECT count(*) AS total_rows,
 count(*) FILTER (trip_distance IS NULL) AS missing_trip_distance,
 count(*) FILTER (passenger_count IS NULL) AS missing_passenger_count FROM flagged""")
def missing_values(spark, sf_dir):
    """Missing values per column of a model input table."""
    return missing_counts(fx.trips_raw(spark, sf_dir), ["trip_distance", "passenger_count"])
