from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames import noisy_trips, table, valid_trips
from meterflow.config import CleaningLimits
from meterflow.errors import DataValidationError
from meterflow.functions.parsing import lenient_number, lenient_timestamp, local_wall_clock
from meterflow.operators.cleaning import check_loss, clean_trips, cleaning_report, rejected_trips
from meterflow.operators.requests import checked_requests, rejected_requests, valid_requests
from meterflow.operators.validation import (
    validate_feature_matrix, validate_target, validate_training_table, validate_trips,
)

NAN = float("nan")


def test_valid_trips_pass(spark):
    assert validate_trips(table(spark, valid_trips())).count() == 2


@pytest.mark.parametrize("changes, message", [
    ({"trip_distance": [-5.0, 5.0]}, "negative_trip_distance"),
    ({"trip_distance": [0.0, 5.0]}, "bad_trip_distance"),
    ({"passenger_count": [20, 1]}, "bad_passenger_count"),
    ({"fare_amount": [None, None]}, "missing"),
    ({"fare_amount": [NAN, 1.0]}, "non_numeric_fare_amount"),
    ({"tpep_dropoff_datetime": [datetime(2026, 1, 1, 9), datetime(2026, 1, 1, 12)]}, "dropoff_not_after_pickup"),
    ({"tpep_pickup_datetime": ["2026-01-01 10:00:00", "nonsense"]}, "invalid_tpep_pickup_datetime"),
])
def test_strict_rules_raise(spark, changes, message):
    frame = valid_trips(**changes)
    if frame["fare_amount"].isna().all():
        df = table(spark, frame.drop(columns="fare_amount")).withColumn("fare_amount", F.lit(None).cast("double"))
    else:
        df = table(spark, frame)
    with pytest.raises(DataValidationError, match=message):
        validate_trips(df)


def test_empty_and_incomplete_tables_raise(spark):
    df = table(spark, valid_trips())
    with pytest.raises(DataValidationError, match="empty"):
        validate_trips(df.limit(0))
    with pytest.raises(DataValidationError, match="trip_distance"):
        validate_trips(df.drop("trip_distance"))


def test_report_counts_each_rule_and_loss(spark):
    df = table(spark, noisy_trips())
    row = cleaning_report(df).first()
    assert (row.initial_rows, row.cleaned_rows, row.dropped_rows, row.loss_percentage) == (5, 1, 4, 80.0)
    assert row.dropped_details.asDict() == {
        "invalid_timestamps": 0, "invalid_duration": 1, "invalid_distance": 1, "invalid_passengers": 1, "invalid_monetary": 1}
    with pytest.raises(DataValidationError, match="80.00%"):
        check_loss(cleaning_report(df))
    check_loss(cleaning_report(df, limits=CleaningLimits(max_loss_pct=80.0)), CleaningLimits(max_loss_pct=80.0))


def test_kept_and_rejected_rows_make_the_whole(spark):
    df = table(spark, noisy_trips())
    assert clean_trips(df).count() + rejected_trips(df).count() == df.count()
    reasons = [row.reject_reasons for row in rejected_trips(df).collect()]
    assert sorted(r[0] for r in reasons) == ["distance", "duration", "monetary", "passengers"]


def test_missing_values_fail_their_rule(spark):
    frame = valid_trips(fare_amount=[NAN, 20.0], trip_distance=[2.5, NAN])
    row = cleaning_report(table(spark, frame)).first()
    assert row.cleaned_rows == 0
    assert row.dropped_details.invalid_monetary == 1 and row.dropped_details.invalid_distance == 1


def test_cleaned_types_and_order(spark):
    frame = valid_trips(passenger_count=[1.0, 2.0]).iloc[::-1]
    cleaned = clean_trips(table(spark, frame), ordered=True)
    assert dict(cleaned.dtypes)["passenger_count"] == "bigint"
    assert [row.VendorID for row in cleaned.collect()] == [1, 2]


def test_missing_zone_after_cleaning_is_an_error(spark):
    with pytest.raises(Exception, match="PULocationID"):
        clean_trips(table(spark, valid_trips(PULocationID=[NAN, 2.0]))).collect()


def test_alias_columns_are_cleaned(spark):
    frame = valid_trips().rename(columns={
        "tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"})
    cleaned = clean_trips(table(spark, frame))
    assert {"lpep_pickup_datetime", "tpep_pickup_datetime"} <= set(cleaned.columns) and cleaned.count() == 2


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("2026-01-01 10:00:00", "2.5"), ("nope", "x"), (None, None)], "t string, n string")
    rows = df.select(lenient_timestamp(df, "t").alias("t"), lenient_number(df, "n").alias("n")).collect()
    assert rows[0].t == datetime(2026, 1, 1, 10) and rows[0].n == 2.5
    assert rows[1].t is None and rows[1].n is None and rows[2].t is None


def test_wall_clock_of_zoned_and_plain_text(spark):
    df = spark.createDataFrame([("2026-07-01T12:00:00Z",), ("2026-07-01T12:00:00",), ("2026-01-01T12:00:00+01:00",)], "t string")
    hours = [row[0] for row in df.select(F.hour(local_wall_clock(df, "t"))).collect()]
    assert hours == [8, 12, 6]


def _request(**changes):
    return {"trip_id": 1, "VendorID": 1, "pickup_datetime": datetime(2026, 10, 5, 14, 30), "passenger_count": 1,
            "trip_distance": 3.5, "PULocationID": 161, "DOLocationID": 236, **changes}


@pytest.mark.parametrize("changes, reason", [
    ({"trip_distance": -2.5}, "distance"), ({"trip_distance": 150.0}, "distance"), ({"trip_distance": NAN}, "distance"),
    ({"passenger_count": 50}, "passengers"), ({"pickup_datetime": datetime(1999, 1, 1)}, "pickup"),
    ({"pickup_datetime": datetime(2028, 1, 1)}, "pickup"), ({"VendorID": 3}, "vendor"),
    ({"PULocationID": 266}, "pickup_zone"), ({"DOLocationID": 0}, "dropoff_zone"),
])
def test_requests_out_of_bounds_are_rejected(spark, changes, reason):
    df = table(spark, pd.DataFrame([_request(), _request(**changes)]))
    assert [r.reject_reasons for r in rejected_requests(df, date(2026, 1, 1)).collect()] == [[reason]]
    assert valid_requests(df, date(2026, 1, 1)).count() == 1


def test_absent_request_fields_get_defaults(spark):
    df = table(spark, pd.DataFrame([{"pickup_datetime": datetime(2026, 1, 1), "trip_distance": 1.0}]))
    row = checked_requests(df, date(2026, 1, 1)).first()
    assert (row.VendorID, row.passenger_count, row.PULocationID, row.DOLocationID) == (1, 1, 161, 236)
    assert row.reject_reasons == []
    with pytest.raises(DataValidationError, match="trip_distance"):
        checked_requests(df.drop("trip_distance"), date(2026, 1, 1))


def test_target_and_matrix_checks(spark):
    df = table(spark, valid_trips())
    validate_target(df)
    late = df.withColumn("tpep_dropoff_datetime", F.col("tpep_pickup_datetime") + F.expr("INTERVAL 4 HOUR"))
    with pytest.raises(DataValidationError, match="target_over_limit"):
        validate_target(late)
    early = df.withColumn("tpep_dropoff_datetime", F.col("tpep_pickup_datetime") - F.expr("INTERVAL 1 HOUR"))
    with pytest.raises(DataValidationError, match="non_positive_target"):
        validate_target(early)
    with pytest.raises(DataValidationError, match="drop-off"):
        validate_feature_matrix(df, ["trip_distance", "tpep_dropoff_datetime"])
    with pytest.raises(DataValidationError, match="missing_trip_distance"):
        validate_feature_matrix(df.withColumn("trip_distance", F.lit(NAN)), ["trip_distance"])
    text = df.withColumn("trip_duration_minutes", F.lit(1.0)).withColumn("note", F.lit("x"))
    with pytest.raises(DataValidationError, match="note"):
        validate_training_table(text, ["trip_distance", "note"], [])
