import random
from collections import deque
from datetime import datetime, timedelta

import numpy as np
import pytest

from meterflow.operators import throttle
from meterflow.operators.throttle import admit_in_order, throttle_marks

START = datetime(2026, 1, 1)


def literal(rows, limit, window):
    """Walk each client's requests one by one."""
    marks, kept = {}, {}
    for client, request, at in sorted(rows, key=lambda r: (r[2], r[1])):
        times = kept.setdefault(client, deque())
        while times and times[0] < at - timedelta(seconds=window):
            times.popleft()
        marks[request] = len(times) < limit
        if marks[request]:
            times.append(at)
    return marks


def requests(count, hot_share, span, seed):
    """A third and more of the requests from one client, in bursts."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        client = "hot" if rng.random() < hot_share else f"c{rng.randrange(5)}"
        burst = rng.randrange(6) * span // 6
        rows.append((client, i, START + timedelta(seconds=burst + round(rng.random() * span / 12, rng.randrange(3)))))
    return rows


@pytest.mark.parametrize("limit, window, span, slices", [(3, 10, 600, 3), (20, 60, 3000, 5), (1, 5, 400, 3), (60, 60, 100, 60)])
def test_marks_equal_a_literal_walk(spark, limit, window, span, slices):
    rows = requests(1500, 0.5, span, seed=limit)
    df = spark.createDataFrame(rows, "client string, request_id bigint, ts timestamp").repartition(6)
    got = {r.request_id: r.admitted for r in throttle_marks(df, "client", "ts", "request_id", limit, window, slices).collect()}
    assert got == literal(rows, limit, window)


@pytest.mark.parametrize("gap", [0.4, 0.5, None])
def test_a_client_that_never_pauses_is_walked_slice_by_slice(spark, monkeypatch, gap):
    """Periodic traffic never forgets where its windows began; uneven traffic does. No walk but the last takes it whole."""
    rng = random.Random(8)
    at, rows = 0.0, []
    for i in range(1200):
        at += gap or rng.choice([0.01, 0.2, 0.9])
        rows.append(("hot", i, START + timedelta(seconds=round(at, 3))))
    rows += [(f"c{i % 40}", 5000 + i, START + timedelta(seconds=i / 3)) for i in range(400)]
    walks, plain = [], throttle._walked
    monkeypatch.setattr(throttle, "_walked", lambda rows, *rest: walks.append(rest[-1]) or plain(rows, *rest))
    df = spark.createDataFrame(rows, "client string, request_id bigint, ts timestamp").repartition(5)
    got = {r.request_id: r.admitted for r in throttle_marks(df, "client", "ts", "request_id", 7, 10, 3).collect()}
    assert got == literal(rows, 7, 10)
    assert walks == [0, *range(len(walks) - 1)] and 2 <= len(walks) <= 7  # of 15 to 20 slices


def test_a_request_without_a_time_has_no_decision(spark):
    rows = [("a", i, None if i % 3 == 0 else START) for i in range(9)]
    df = spark.createDataFrame(rows, "client string, request_id bigint, ts timestamp")
    got = {r.request_id: r.admitted for r in throttle_marks(df, "client", "ts", "request_id", 4, 10, 3).collect()}
    assert [got[i] for i in range(9)] == [None, True, True, None, True, True, None, False, False]


def test_requests_without_a_client_share_one_limit(spark):
    rows = [(None if i % 2 else 7, i, START + timedelta(seconds=i)) for i in range(60)]
    df = spark.createDataFrame(rows, "client bigint, request_id bigint, ts timestamp").repartition(3)
    got = {r.request_id: r.admitted for r in throttle_marks(df, "client", "ts", "request_id", 2, 15, 3).collect()}
    assert got == literal(rows, 2, 15)


def test_a_time_exactly_one_window_old_still_counts():
    times = np.array([0, 60, 61, 121, 122])
    assert admit_in_order(times, deque(), 1, 60).tolist() == [True, False, True, False, True]


def test_state_carries_over_batches_and_stays_small():
    rng = random.Random(4)
    times = np.array(sorted(rng.randrange(10_000) for _ in range(800)))
    whole = admit_in_order(times, deque(), 5, 300)
    recent, parts = deque(), []
    for start in range(0, 800, 37):
        parts.extend(admit_in_order(times[start: start + 37], recent, 5, 300))
        assert len(recent) <= 5
    assert parts == whole.tolist()


def test_slices_must_hold_the_lookback(spark):
    with pytest.raises(ValueError):
        throttle_marks(spark.range(1), "id", "id", "id", limit=1, window_seconds=1, slice_windows=1)
