import math
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames import table, valid_trips
from meterflow.config import FEATURES, TARGET
from meterflow.errors import DataValidationError
from meterflow.functions.trip_time import finished_prediction, plus_minutes
from meterflow.operators.features import scoring_features, training_features


def feature_input():
    """A month's last evening before midnight, an early Sunday, the first minute of a rush hour."""
    starts = [datetime(2025, 10, 31, 23, 50), datetime(2025, 11, 2, 3, 5), datetime(2025, 11, 3, 7)]
    return pd.DataFrame({
        "VendorID": [2, 1, 2], "tpep_pickup_datetime": starts,
        "tpep_dropoff_datetime": [s + timedelta(minutes=m) for s, m in zip(starts, (25, 8, 61))],
        "passenger_count": [4, 1, 3], "trip_distance": [6.5, 1.25, 17.0], "PULocationID": [71, 140, 9], "DOLocationID": [72, 33, 256],
    })


def test_features_of_three_trips(spark):
    rows = training_features(table(spark, feature_input())).orderBy("pickup_datetime").collect()
    assert [row[TARGET] for row in rows] == [25.0, 8.0, 61.0]
    assert [row.is_weekend for row in rows] == [0, 1, 0]
    assert [row.is_rush_hour for row in rows] == [0, 0, 1]
    assert [row.pickup_day_of_week for row in rows] == [4, 6, 0]
    assert rows[0].PU_DO_pair == "71_72"
    assert rows[0].pickup_hour_sin == pytest.approx(math.sin(2 * math.pi * 23 / 24))


def test_columns_hold_no_dropoff(spark):
    columns = training_features(table(spark, feature_input())).columns
    assert columns == [*FEATURES, TARGET, "pickup_datetime"]


def test_absent_optional_column_is_left_out(spark):
    columns = training_features(table(spark, feature_input().drop(columns="VendorID"))).columns
    assert "VendorID" not in columns
    with pytest.raises(DataValidationError, match="DOLocationID"):
        training_features(table(spark, feature_input().drop(columns="DOLocationID")))


def test_implausible_speeds_are_dropped(spark):
    frame = feature_input()
    frame["trip_distance"] = [60.0, 1.25, 0.2]  # 144 mph, plausible, then 0.2 mph for an hour
    assert training_features(table(spark, frame)).count() == 1


def test_fractions_of_minutes_are_kept(spark):
    frame = feature_input().head(1)
    frame["tpep_dropoff_datetime"] = frame["tpep_pickup_datetime"] + timedelta(minutes=20, seconds=30)
    assert training_features(table(spark, frame)).first()[TARGET] == 20.5


def test_green_aliases(spark):
    frame = valid_trips().rename(columns={
        "tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"})
    assert {row[TARGET] for row in training_features(table(spark, frame)).collect()} == {19.0, 26.0}


def test_scoring_features_equal_training_features(spark):
    trips = table(spark, feature_input())
    trained = training_features(trips).select(*FEATURES, "pickup_datetime").orderBy("pickup_datetime").collect()
    asked = trips.withColumnRenamed("tpep_pickup_datetime", "pickup_datetime")
    scored = scoring_features(asked, FEATURES, keep=["pickup_datetime"]).orderBy("pickup_datetime").collect()
    assert [[row[f] for f in FEATURES] for row in trained] == [[row[f] for f in FEATURES] for row in scored]


def test_finished_prediction(spark):
    df = spark.createDataFrame([(0.2, datetime(2026, 1, 1)), (12.345678, datetime(2026, 1, 1))], "p double, t timestamp_ntz")
    rows = df.select(finished_prediction(F.col("p")).alias("m"), "t").select("m", plus_minutes(F.col("t"), F.col("m")).alias("d")).collect()
    assert [row.m for row in rows] == [1.0, 12.35]
    assert rows[0].d == datetime(2026, 1, 1, 0, 1) and rows[1].d == datetime(2026, 1, 1, 0, 12, 21)
