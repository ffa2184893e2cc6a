import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from frames import noisy_trips, table, valid_trips
from meterflow.operators.drift import rolling_drift
from meterflow.streaming.cleaning import accepted_rows, clean_stream, rejected_rows
from meterflow.streaming.drift import rolling_drift_stream, windowed_drift
from meterflow.streaming.pickup import append_files, landed_stream
from meterflow.streaming.telemetry import client_sessions
from meterflow.streaming.throttle import throttle_stream
from test_drift import arrivals, random_rows
from test_throttle import literal, requests

START = datetime(2026, 1, 1)


def test_files_are_picked_up_once(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / name) for name in ("landing", "out", "checkpoint"))
    df = spark.range(10)
    for landed, expected in ((True, 10), (True, 20), (False, 20)):
        if landed:
            df.write.mode("append").parquet(landing)
        append_files(landed_stream(spark, landing, df.schema), out, checkpoint)
        assert spark.read.parquet(out).count() == expected


def test_clean_stream_splits_every_row(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / name) for name in ("landing", "out", "checkpoint"))
    trips = table(spark, noisy_trips())
    trips.write.parquet(landing)
    clean_stream(landed_stream(spark, landing, trips.schema), out, checkpoint)
    assert accepted_rows(spark, out).count() == 1 and rejected_rows(spark, out).count() == 4
    report = spark.read.json(f"{out}/reports").first()
    assert (report.batch, report.initial_rows, report.cleaned_rows, report.invalid_distance) == (0, 5, 1, 1)
    table(spark, valid_trips()).write.mode("append").parquet(landing)
    clean_stream(landed_stream(spark, landing, trips.schema), out, checkpoint)
    assert accepted_rows(spark, out).count() == 3 and spark.read.json(f"{out}/reports").count() == 2


def test_rolling_drift_continues_over_runs(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / name) for name in ("landing", "out", "checkpoint"))
    whole = arrivals(spark, random_rows(900))
    for low, high in ((0, 57), (57, 640), (640, 900)):
        whole.filter((F.col("n") >= low) & (F.col("n") < high)).write.mode("append").parquet(landing)
        rolling_drift_stream(landed_stream(spark, landing, whole.schema), ["n"], out, checkpoint)
    got = {(r.row_index, r.feature): round(r.psi, 9) for r in spark.read.parquet(f"{out}/points").collect()}
    assert got == {(r.row_index, r.feature): round(r.psi, 9) for r in rolling_drift(whole, ["n"]).collect()}


def test_stream_limit_carries_state_over_runs(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / name) for name in ("landing", "out", "checkpoint"))
    rows = sorted(requests(400, 0.5, 600, seed=9), key=lambda r: r[2])
    schema = "client string, request_id bigint, ts timestamp"
    for part in (rows[:150], rows[150:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(landing)
        stream = landed_stream(spark, landing, spark.read.parquet(landing).schema)
        append_files(throttle_stream(stream, "client", "ts", "request_id", 3, 30, "1 minute"), out, checkpoint)
    got = {r.request_id: r.admitted for r in spark.read.parquet(out).collect()}
    assert got == literal(rows, 3, 30)


def test_windowed_drift_on_a_table(spark):
    rng = random.Random(1)
    rows = [(START + timedelta(hours=i), rng.expovariate(0.3)) for i in range(100)]
    df = spark.createDataFrame(rows, "at timestamp, trip_distance double")
    windows = windowed_drift(df, "at", "1 day").collect()
    assert sum(r.rows for r in windows) == 100 and all(r.psi >= 0 for r in windows)


def test_sessions_end_after_a_silence(spark):
    seconds = [0, 30, 59, 200, 210]
    df = spark.createDataFrame([("a", START + timedelta(seconds=s)) for s in seconds], "client string, ts timestamp")
    got = sorted(r.requests for r in client_sessions(df, watermark=None).collect())
    assert got == [2, 3]
