import math
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from meterflow.config import DISTANCE_EDGES, DISTANCE_SHARES, DURATION_EDGES, DURATION_SHARES, DriftSettings
from meterflow.functions.histograms import bucket_index, floored_shares, severity, stability_index
from meterflow.operators.drift import (
    DISTANCE, DURATION, Monitored, batch_drift, drift_alerts, period_drift, reference_distribution, rolling_drift,
    with_reference,
)


def expected_index(values, edges, shares):
    """Plain-Python stability index of a window."""
    counts = [0] * (len(edges) + 1)
    for value in values:
        counts[next((i for i, edge in enumerate(edges) if value < edge), len(edges))] += 1
    seen = [max(c / len(values), 0.005) for c in counts]
    seen = [s / sum(seen) for s in seen]
    wanted = floored_shares(shares, len(counts), 0.005)
    return sum((o - e) * math.log(o / e) for o, e in zip(seen, wanted))


def arrivals(spark, rows):
    return spark.createDataFrame(
        [(i, float(d), float(m), i // 37) for i, (d, m) in enumerate(rows)],
        "n bigint, trip_distance double, predicted_duration_minutes double, batch bigint").repartition(5)


def random_rows(count, seed=5):
    rng = random.Random(seed)
    return [(rng.expovariate(0.3), rng.expovariate(0.05)) for _ in range(count)]


def test_buckets_are_half_open(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.99,), (50.0,), (1e9,), (None,)], "v double")
    assert [r[0] for r in df.select(bucket_index(F.col("v"), DISTANCE_EDGES)).collect()] == [0, 1, 1, 10, 10, None]


def test_equal_shares_have_no_drift(spark):
    shares = F.array(*[F.lit(s) for s in DISTANCE_SHARES])
    assert spark.range(1).select(stability_index(shares, DISTANCE_SHARES, 1e-4)).first()[0] == 0.0
    short = F.array(F.lit(0.08), F.lit(0.14))
    assert spark.range(1).select(stability_index(short, DISTANCE_SHARES, 1e-4)).first()[0] == 0.0


def test_severity_thresholds_are_inclusive(spark):
    df = spark.createDataFrame([(0.0999,), (0.1,), (0.1999,), (0.2,)], "psi double")
    got = [r[0] for r in df.select(severity(F.col("psi"), DriftSettings())).collect()]
    assert got == ["NONE", "MEDIUM", "MEDIUM", "HIGH"]


def test_short_reference_is_padded_and_renormalised():
    shares = floored_shares(DURATION_SHARES, 9, 0.005)
    assert len(shares) == 9 and sum(shares) == pytest.approx(1.0)
    assert shares[-1] == pytest.approx(0.005 / 1.005)


def test_first_evaluation_is_the_hundredth_row_for_both_features(spark):
    assert rolling_drift(arrivals(spark, [(2.0, 12.0)] * 99), ["n"]).count() == 0
    rows = rolling_drift(arrivals(spark, [(2.0, 12.0)] * 100), ["n"]).collect()
    assert {(r.row_index, r.feature, r.window_rows, r.severity) for r in rows} == {
        (100, "trip_distance", 100, "HIGH"), (100, "predicted_duration_minutes", 100, "HIGH")}


def test_evaluations_come_every_tenth_row(spark):
    index = {r.row_index for r in rolling_drift(arrivals(spark, [(2.0, 12.0)] * 619), ["n"]).collect()}
    assert {i for i in index if i > 600} == {610}


def test_rolling_drift_equals_a_literal_window(spark):
    rows = random_rows(1234)
    got = {(r.row_index, r.feature): (r.window_rows, r.psi) for r in rolling_drift(arrivals(spark, rows), ["n"]).collect()}
    window = deque(maxlen=500)
    want = {}
    for i, row in enumerate(rows, 1):
        window.append(row)
        if i >= 100 and i % 10 == 0:
            want[i, "trip_distance"] = len(window), expected_index([r[0] for r in window], DISTANCE_EDGES, DISTANCE_SHARES)
            want[i, "predicted_duration_minutes"] = (
                len(window), expected_index([r[1] for r in window], DURATION_EDGES, DURATION_SHARES))
    assert got.keys() == want.keys()
    for key, (size, psi) in want.items():
        assert got[key][0] == size and got[key][1] == pytest.approx(psi, abs=1e-9)


def test_batch_drift_equals_a_literal_window(spark):
    rows = random_rows(1300, seed=8)
    got = {(r.batch, r.feature): (r.window_rows, r.psi) for r in batch_drift(arrivals(spark, rows), ["n"], "batch").collect()}
    window, want = deque(maxlen=500), {}
    for start in range(0, len(rows), 37):
        window.extend(rows[start: start + 37])
        if len(window) >= 100:
            want[start // 37, "trip_distance"] = (
                len(window), expected_index([r[0] for r in window], DISTANCE_EDGES, DISTANCE_SHARES))
            want[start // 37, "predicted_duration_minutes"] = (
                len(window), expected_index([r[1] for r in window], DURATION_EDGES, DURATION_SHARES))
    assert got.keys() == want.keys()
    assert all(got[k][0] == s and got[k][1] == pytest.approx(p, abs=1e-9) for k, (s, p) in want.items())


def test_a_batch_over_the_window_keeps_its_last_rows(spark):
    rows = [(40.0, 50.0)] * 700 + [(2.5, 12.0)] * 500
    one_batch = arrivals(spark, rows).withColumn("batch", F.lit(1))
    row = batch_drift(one_batch, ["n"], "batch", (DISTANCE,)).collect()
    assert len(row) == 1 and row[0].window_rows == 500
    assert row[0].psi == pytest.approx(expected_index([2.5], DISTANCE_EDGES, DISTANCE_SHARES), abs=1e-9)


def test_exported_reference_replaces_the_built_in_one(spark):
    values = spark.createDataFrame([(0.1,)] * 30 + [(4.0,)] * 70, "trip_distance double")
    reference = reference_distribution(values)
    row = reference.first()
    assert row.sample_count == 100 and sum(row.fractions) == pytest.approx(1.0)
    assert row.fractions[0] == pytest.approx((30 + 1e-4) / (100 + 11e-4))
    watched = with_reference(DISTANCE, reference)
    again = period_drift(values.withColumn("day", F.lit(1)), ["day"], watched).first()
    assert again.psi == pytest.approx(0.0, abs=1e-6) and again.severity == "NONE"
    assert with_reference(DISTANCE, None) == DISTANCE
    assert with_reference(DISTANCE, reference_distribution(values.limit(0))) == DISTANCE


def test_period_drift_ignores_nulls_and_empty_periods(spark):
    df = spark.createDataFrame([(1, 2.5), (1, None), (2, None)], "day int, trip_distance double")
    rows = period_drift(df, ["day"], DISTANCE).collect()
    assert [(r.day, r.rows) for r in rows] == [(1, 1)]


def test_alerts_are_counted_by_feature_and_severity(spark):
    scored = spark.createDataFrame([("a", "HIGH"), ("a", "HIGH"), ("a", "NONE"), ("b", "MEDIUM")], "feature string, severity string")
    assert {tuple(r) for r in drift_alerts(scored).collect()} == {("a", "HIGH", 2), ("b", "MEDIUM", 1)}


def test_window_and_step_must_fit(spark):
    with pytest.raises(ValueError):
        rolling_drift(arrivals(spark, [(1.0, 1.0)]), ["n"], (Monitored("trip_distance", (1.0,), (0.5, 0.5)),),
                      DriftSettings(window_rows=55))
    assert DURATION.buckets == 9


def test_reference_leaves_out_what_is_not_a_number(spark):
    known = [(0.5,), (3.0,), (None,)]
    plain = reference_distribution(spark.createDataFrame(known, "trip_distance double")).first()
    mixed = reference_distribution(spark.createDataFrame([*known, (float("nan"),)], "trip_distance double")).first()
    assert plain == mixed and mixed.sample_count == 2
