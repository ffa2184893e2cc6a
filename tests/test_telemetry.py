import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterflow.functions.histograms import bucket_quantile
from meterflow.operators import telemetry as tm

START = datetime(2026, 1, 1)


def at(**delta):
    return START + timedelta(**delta)


def test_unknown_paths_are_unmatched(spark):
    df = spark.createDataFrame([("GET", "/health", 200), ("GET", "/secret", 404), ("GET", "/other", 404)],
                               "method string, endpoint string, status int")
    assert {tuple(r) for r in tm.request_counts(df).collect()} == {("GET", "/health", 200, 1), ("GET", "unmatched", 404, 2)}


def test_histogram_bounds_are_inclusive_and_cumulative(spark):
    df = spark.createDataFrame([(0.5,), (0.6,), (99.0,), (None,)], "v double")
    rows = {r.le: (r.cumulative, r.total) for r in tm.cumulative_histogram(df, "v", (0.5, 1.0)).collect()}
    assert rows == {"0.5": (1, 3), "1.0": (2, 3), "+Inf": (3, 3)}


@pytest.mark.parametrize("counts, q, want", [
    ([10, 0, 0], 0.5, 0.5), ([0, 10, 0], 0.5, 1.5), ([5, 5, 0], 0.9, 1.8), ([0, 0, 3], 0.5, 2.0), ([0, 0, 0], 0.5, None)])
def test_bucket_quantile(spark, counts, q, want):
    got = spark.range(1).select(bucket_quantile(q, [F.lit(c) for c in counts], (1.0, 2.0))).first()[0]
    assert got == (pytest.approx(want) if want is not None else None)


def test_alert_needs_every_step_of_its_time(spark):
    minutes = [1, 2, 3, 5, 6, 7, 8]
    df = spark.createDataFrame([(at(minutes=m), m != 7) for m in minutes], "window_end timestamp, bad boolean")
    fired = [r.fires_at for r in tm.sustained(df, F.col("bad"), 120).collect()]
    assert fired == [at(minutes=3)]


def test_error_ratio_slides_over_steps(spark):
    df = spark.createDataFrame([(at(seconds=10), 500), (at(seconds=70), 200)], "ts timestamp, status int")
    rows = {r.window_end: (r.errors, r.requests) for r in tm.error_ratio(df).collect()}
    assert rows[at(minutes=1)] == (1, 1) and rows[at(minutes=2)] == (1, 2) and rows[at(minutes=6)] == (0, 1)
    assert len(rows) == 6


def test_rates_are_per_second(spark):
    df = spark.createDataFrame([(at(seconds=s), "a") for s in range(30)], "ts timestamp, k string")
    assert tm.rates(df, ["k"]).first().per_second == 0.5


def test_only_silences_over_a_minute_are_gaps(spark):
    seconds = [0, 59, 119, 180, 300]
    df = spark.createDataFrame([("a", at(seconds=s)) for s in seconds] + [("b", at(seconds=0))], "source string, ts timestamp")
    gaps = sorted((r.silent_from, r.gap_seconds) for r in tm.heartbeat_gaps(df, "source").collect())
    assert gaps == [(at(seconds=119), 61.0), (at(seconds=180), 120.0)]


def test_drift_alert_and_totals(spark):
    rows = [(at(minutes=1), "HIGH"), (at(minutes=1), "MEDIUM")]
    df = spark.createDataFrame(rows, "ts timestamp, severity string")
    fired = {r.fires_at for r in tm.drift_alert(df).collect()}
    assert fired == {at(minutes=m) for m in range(3, 12)}
    assert {r.severity: r.alerts for r in tm.alert_totals(df.limit(0)).collect()} == {"HIGH": 0, "MEDIUM": 0}


def test_status_down_and_current(spark):
    df = spark.createDataFrame([(at(seconds=s), f, "m") for s, f in ((5, 1), (30, 0), (70, 0), (130, 1))],
                               "ts timestamp, flag int, name string")
    assert [r.fires_at for r in tm.status_down(df, F.col("flag")).collect()] == [at(minutes=1)]
    assert tm.current_status(df, "flag", ["name"]).first().status == 1


def test_slot_sessions_equal_session_windows(spark):
    from meterflow.streaming.telemetry import client_sessions

    rows = [("hot" if i % 3 else "b", at(seconds=(i * i * 7) % 5000)) for i in range(300)]
    df = spark.createDataFrame(rows, "client string, ts timestamp")
    got = {tuple(r) for r in tm.activity_sessions(df).collect()}
    assert got == {tuple(r) for r in client_sessions(df, watermark=None).collect()}


@pytest.mark.parametrize("few_rows", [1, 40, 10_000])
def test_exact_quantiles_by_counting(spark, few_rows):
    """Half of the rows in one group, ties, lone rows, values that are missing or no number, groups without any."""
    rng = random.Random(5)
    start = datetime(2026, 3, 1)
    rows = [("hot" if i % 2 else rng.choice(["a", "b", None]), start + timedelta(seconds=rng.randrange(2) * 300),
             rng.choice([rng.gauss(0, 1) * 10 ** rng.randint(-3, 3), 5.0, -0.0, 0.0])) for i in range(900)]
    rows += [("lone", start, 1.5), ("none", start, None), ("nan", start, float("nan")), ("nan", start, 2.0), ("wide", start, 1.7e308), ("wide", start, -1.7e308),
             ("wide", start, 1.0)]
    df = spark.createDataFrame(rows, "endpoint string, ts timestamp, latency_s double").repartition(4)
    wanted = {"low": 0.0, "p50": 0.5, "p95": 0.95, "top": 1.0}
    got = {(r.endpoint, r.window_start): r for r in tm.exact_quantiles(df, wanted, few_rows=few_rows).collect()}
    groups = {}
    for endpoint, ts, value in rows:
        groups.setdefault((endpoint, ts), []).extend([] if value is None or value != value else [value])
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        values.sort()
        for name, q in wanted.items():
            if not values:
                assert got[key][name] is None
                continue
            at = q * (len(values) - 1)
            below, above = values[math.floor(at)], values[math.ceil(at)]
            assert got[key][name] == pytest.approx(below + (above - below) * (at - math.floor(at)))
