"""Small hand-made trip tables."""

from datetime import datetime, timedelta

import pandas as pd

START = datetime(2026, 1, 1, 8, 35)


def valid_trips(**changes) -> pd.DataFrame:
    """Two trips that break no rule, built by a rule of their own."""
    number = pd.Series([1, 2])
    pickup = pd.Series([START + timedelta(minutes=95 * int(n)) for n in number])
    rows = {
        "VendorID": number,
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": pickup + pd.to_timedelta(12 + 7 * number, unit="min"),
        "passenger_count": number,
        "trip_distance": 1.5 + 2.25 * number,
        "PULocationID": 40 + number,
        "DOLocationID": 60 + 3 * number,
        "payment_type": 1,
        "fare_amount": 6.0 + 5.5 * number,
        "total_amount": 9.0 + 6.25 * number,
    }
    frame = pd.DataFrame({**rows, **changes})
    return frame.astype({name: "datetime64[us]" for name in frame.select_dtypes("datetime").columns})


def noisy_trips() -> pd.DataFrame:
    """A valid row, then copies of it with one broken field each."""
    base = valid_trips().iloc[0].to_dict()
    faults = [
        {}, {"trip_distance": 0.0}, {"passenger_count": 0},
        {"tpep_dropoff_datetime": base["tpep_pickup_datetime"] - timedelta(minutes=4)}, {"fare_amount": -3.5, "total_amount": -3.5},
    ]
    frame = pd.DataFrame([base | fault for fault in faults])
    return frame.astype({name: "datetime64[us]" for name in frame.select_dtypes("datetime").columns})


def table(spark, frame: pd.DataFrame):
    """A Spark table whose times carry no zone."""
    df = spark.createDataFrame(frame)
    for name, kind in df.dtypes:
        if kind == "timestamp":
            df = df.withColumn(name, df[name].cast("timestamp_ntz"))
    return df
