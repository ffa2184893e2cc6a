import random
from collections import Counter
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterflow.errors import DataValidationError
from meterflow.operators import ordering
from meterflow.operators.ordering import key_at_rank, trailing_counts, with_row_index
from meterflow.operators.splitting import (
    check_split, seeded_subsample, split_by_date, split_by_ratio, split_sizes, split_trips,
)

START = datetime(2026, 1, 1)


def timed_rows(count, hot=0.4, seed=1):
    """Rows of which many share one time."""
    rng = random.Random(seed)
    return [(i, START if rng.random() < hot else START + timedelta(seconds=rng.randrange(-500, 500))) for i in range(count)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "trip_id bigint, pickup_datetime timestamp_ntz").repartition(7)


def test_row_index_equals_sorting_even_with_a_hot_time(spark):
    rows = timed_rows(3000)
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    got = with_row_index(frame(spark, rows), ("pickup_datetime", "trip_id"), partitions=9).collect()
    assert {row.trip_id: row.row_index for row in got} == want


@pytest.mark.parametrize("chunk_rows", [10, 37, 1000])
def test_trailing_counts_equal_brute_force(spark, chunk_rows):
    values = [random.Random(3).randrange(5) for _ in range(1)] + [i * 7 % 5 for i in range(399)]
    df = spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], "pos bigint, c bigint").repartition(5)
    got = trailing_counts(df, "pos", ["c"], 10, chunk_rows, following=["pos"]).orderBy("pos").collect()
    assert [row.c for row in got] == [sum(values[max(0, i - 9): i + 1]) for i in range(400)]
    assert [row.next_pos for row in got] == [*range(2, 401), None]


def test_key_at_rank_with_ties_at_every_depth(spark, monkeypatch):
    monkeypatch.setattr(ordering, "_FEW_ROWS", 3)
    monkeypatch.setattr(ordering, "_BINS", 4)
    rows = timed_rows(300)
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    df = frame(spark, rows).cache()
    for rank in (1, 77, 150, 300):
        key = key_at_rank(df, ("pickup_datetime", "trip_id"), rank)
        assert (key["trip_id"], key["pickup_datetime"]) == ordered[rank - 1]
    with pytest.raises(DataValidationError):
        key_at_rank(df, ("pickup_datetime", "trip_id"), 301)
    df.unpersist()


def test_ratio_split_follows_the_clock(spark):
    df = frame(spark, [(i, START + timedelta(minutes=7 * i)) for i in range(50)])
    split = split_by_ratio(df, (0.6, 0.1, 0.3))
    sizes = {"train": 30, "validation": 5, "test": 15}
    assert {r.split: r.rows for r in split_sizes(split).collect()} == sizes == check_split(split)
    assert {r.split: r.first for r in split.groupBy("split").agg(F.min("trip_id").alias("first")).collect()} == {"train": 0, "validation": 30, "test": 35}


def test_ratio_split_is_exact_on_tied_times(spark):
    split = split_by_ratio(frame(spark, timed_rows(1001, hot=0.9)))
    assert check_split(split) == {"train": 700, "validation": 150, "test": 151}


@pytest.mark.parametrize("ratios", [(0.7, 0.2, 0.2), (1.0, 0.0, 0.0), (0.5, 0.6, -0.1)])
def test_bad_ratios_raise(spark, ratios):
    with pytest.raises(DataValidationError):
        split_by_ratio(frame(spark, timed_rows(20)), ratios)


def test_too_few_rows_raise(spark):
    with pytest.raises(DataValidationError):
        split_by_ratio(frame(spark, timed_rows(2)))
    with pytest.raises(DataValidationError):
        split_by_ratio(frame(spark, []))


def every_third_day(spark):
    days = [datetime(2025, 3, 3) + timedelta(days=3 * k) for k in range(40)]
    return frame(spark, list(enumerate(days)))


def test_date_split_of_a_spring(spark):
    split = split_by_date(every_third_day(spark), datetime(2025, 4, 2), datetime(2025, 5, 29))  # days 30 and 87 from the first
    assert check_split(split) == {"train": 10, "validation": 19, "test": 11}


def test_date_split_guards(spark):
    with pytest.raises(DataValidationError, match="before test"):
        split_by_date(every_third_day(spark), datetime(2025, 5, 29), datetime(2025, 4, 2))
    with pytest.raises(DataValidationError, match="empty"):
        check_split(split_by_date(every_third_day(spark), datetime(2027, 1, 1), datetime(2027, 2, 1)))
    lost = every_third_day(spark).withColumn("pickup_datetime", F.when(F.col("trip_id") > 0, F.col("pickup_datetime")))
    with pytest.raises(DataValidationError, match="lost 1 rows"):
        check_split(split_by_date(lost, datetime(2025, 4, 2), datetime(2025, 5, 29)))


def test_split_kind_follows_the_cutoffs(spark):
    by_ratio = split_trips(every_third_day(spark), (0.5, 0.3, 0.2))
    assert check_split(by_ratio) == {"train": 20, "validation": 12, "test": 8}
    by_date = split_trips(every_third_day(spark), (0.5, 0.3, 0.2), datetime(2025, 4, 2), datetime(2025, 5, 29))
    assert check_split(by_date)["train"] == 10


def test_subsample_is_exact_and_repeatable(spark):
    df = frame(spark, timed_rows(2000))
    one = {r.trip_id for r in seeded_subsample(df, 333, seed=1).collect()}
    again = {r.trip_id for r in seeded_subsample(df.repartition(3), 333, seed=1).collect()}
    other = {r.trip_id for r in seeded_subsample(df, 333, seed=2).collect()}
    assert len(one) == 333 and one == again and one != other
    assert seeded_subsample(df, 5000, seed=1).count() == 2000


def texts(count):
    rng = random.Random(7)
    return ["same" * 3 + rng.choice(["", "\x00", "a", "ab", "é", "z" * rng.randrange(4)]) for _ in range(count)]


KINDS = {
    "string": texts(300),
    "binary": [t.encode() for t in texts(300)],
    "double": [random.Random(i).choice([0.0, 5e-324, -1.7e308, 1.7e308, float("inf"), float("-inf"), float("nan"), i / 7]) for i in range(300)],
    "decimal(12,3)": [Decimal(i * i % 97) / 8 for i in range(300)],
    "timestamp": [datetime(2026, 3, 29, tzinfo=timezone.utc) + timedelta(minutes=i * i % 211) for i in range(300)],
    "date": [date(1969, 12, 1) + timedelta(days=i * i % 61) for i in range(300)],
    "boolean": [i % 3 == 0 for i in range(300)],
    "bigint": [(-1) ** i * (2 ** 63 - 1 - i % 5) for i in range(300)],
}


@pytest.mark.parametrize("kind, few", [*((kind, 0) for kind in KINDS), ("string", 1000), ("timestamp", 1000)])
def test_key_at_rank_counts_every_kind_of_column(spark, monkeypatch, kind, few):
    monkeypatch.setattr(ordering, "_FEW_ROWS", few)
    df = spark.createDataFrame([(v, i) for i, v in enumerate(KINDS[kind])], f"k {kind}, trip_id bigint").repartition(2)
    ranked = [r.trip_id for r in df.orderBy("k", "trip_id").collect()]
    for rank in (140, 300):
        key = key_at_rank(df, ("k", "trip_id"), rank)
        assert key["trip_id"] == ranked[rank - 1]
        assert df.filter(ordering.at_or_before(key, df)).count() == rank


def test_split_by_ratio_with_one_time_and_text_ids(spark, monkeypatch):
    monkeypatch.setattr(ordering, "_FEW_ROWS", 50)
    rows = [(START, f"trip-{i * 7919 % 4001:05d}") for i in range(4001)]
    df = spark.createDataFrame(rows, "pickup_datetime timestamp, trip_id string").repartition(6)
    split = split_by_ratio(df)
    assert {r.split: r["rows"] for r in split_sizes(split).collect()} == {"train": 2800, "validation": 600, "test": 601}
    ids = {s: sorted(r.trip_id for r in split.filter(f"split = '{s}'").collect()) for s in ("train", "validation", "test")}
    assert ids["train"][-1] < ids["validation"][0] and ids["validation"][-1] < ids["test"][0]


@pytest.mark.parametrize("few", [0, 10_000])
def test_subsample_is_exact_when_ids_and_rows_repeat(spark, monkeypatch, few):
    monkeypatch.setattr(ordering, "_FEW_ROWS", few)
    rows = [(i % 4, START + timedelta(seconds=i % 40 if i % 2 else 0)) for i in range(800)]
    df = frame(spark, rows)
    for wanted in (150, 799):
        took = sorted(map(tuple, seeded_subsample(df, wanted, seed=3).collect()))
        assert len(took) == wanted
        assert took == sorted(map(tuple, seeded_subsample(df.repartition(3), wanted, seed=3).collect()))
        assert not Counter(took) - Counter(rows)
