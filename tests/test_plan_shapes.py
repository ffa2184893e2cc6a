"""The physical plans stay the ones the operators were designed for."""

from pyspark.sql import functions as F

from frames import table, valid_trips
from meterflow.operators.cleaning import clean_trips, cleaning_report
from meterflow.operators.features import training_features
from meterflow.operators.ordering import with_row_index
from meterflow.operators.splitting import split_by_ratio
from meterflow.operators.telemetry import heartbeat_gaps
from meterflow.operators.validation import violation_counts
from meterflow.sources.zones import read_zone, write_zone


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, frame, name="t"):
    write_zone(table(spark, frame), str(tmp_path), "raw", name)
    return read_zone(spark, str(tmp_path), "raw", name)


def test_cleaning_is_one_narrow_pushed_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    cleaned = plan(clean_trips(stored(spark, tmp_path, valid_trips())).select("trip_distance"))
    assert cleaned.count("FileScan") == 1 and "Exchange" not in cleaned and "Sort" not in cleaned
    assert "GreaterThan(trip_distance,0.0)" in cleaned and "GreaterThanOrEqual(passenger_count,1)" in cleaned
    schema = cleaned.split("ReadSchema")[1]
    assert "payment_type" not in schema


def test_reports_are_one_scan_and_one_small_exchange(spark, tmp_path):
    trips = stored(spark, tmp_path, valid_trips())
    for df in (cleaning_report(trips), violation_counts(trips)):
        assert plan(df).count("FileScan") == 1 and plan(df).count("Exchange") == 1
        assert "partial_count" in plan(df)


def test_features_need_no_exchange(spark, tmp_path):
    features = plan(training_features(clean_trips(stored(spark, tmp_path, valid_trips()))))
    assert features.count("FileScan") == 1 and "Exchange" not in features and "Python" not in features


def test_ratio_split_is_a_filterless_projection(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("trip_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("pickup_datetime"))
    split = plan(split_by_ratio(rows))
    assert "Exchange" not in split and "Window" not in split and "Sort" not in split


def test_row_index_adds_one_row_per_partition(spark):
    indexed = plan(with_row_index(spark.range(100), ["id"], partitions=4))
    # the only unpartitioned window runs over partition sizes, and the table itself is not exchanged again
    assert indexed.count("Window") == 1 and "BroadcastHashJoin" in indexed and "SortMergeJoin" not in indexed


def test_heartbeats_are_counted_before_they_are_ordered(spark):
    events = spark.range(50).select(F.lit("a").alias("source"), F.timestamp_seconds("id").alias("ts"))
    gaps = plan(heartbeat_gaps(events, "source"))
    assert gaps.index("Window") < gaps.index("partial_min")
