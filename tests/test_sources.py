import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from frames import table, valid_trips
from meterflow.errors import DataValidationError
from meterflow.session import broadcast_if_small
from meterflow.sources import manifest as mf
from meterflow.sources.isolation import isolate
from meterflow.sources import planning as pl
from meterflow.sources import zones as zn

EVENT = "stage string, dataset string, filename string, status string, seq bigint"


def walked_state(events):
    """One file's record after its marks, one by one."""
    state, downloaded = None, False
    for status, seq in events:
        if status == "DOWNLOADED":
            if downloaded:
                continue
            downloaded = True
        elif status != "FAILED" and state and state[0] == status:
            continue
        state = (status, seq)
    return state


def test_states_equal_a_walk(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for f in range(60):
        marks = [(rng.choice(["DOWNLOADED", "PROCESSED", "FAILED", "PROCESSED"]), f * 100 + i) for i in range(rng.randrange(1, 9))]
        want[f"f{f}"] = walked_state(marks)
        rows += [("ingestion", "yellow", f"f{f}", status, seq) for status, seq in marks]
    got = mf.file_states(spark.createDataFrame(rows, EVENT).repartition(5)).collect()
    assert {r.filename: (r.status, r.seq) for r in got} == want


def test_manifest_marks_are_kept_and_looked_up(spark, tmp_path):
    root, name = str(tmp_path), "yellow_tripdata_2026-01.parquet"
    files = spark.createDataFrame([("yellow", name)], "dataset string, filename string")
    assert mf.read_events(spark, root).count() == 0
    mf.append_marks(mf.marks(files, "ingestion", mf.DOWNLOADED), root)
    first = mf.read_events(spark, root).first().seq
    mf.append_marks(mf.marks(files, "ingestion", mf.DOWNLOADED), root)
    mf.append_marks(mf.marks(files, "ingestion", mf.FAILED, error=F.lit("broken")), root)
    mf.append_marks(mf.marks(files, "processed", mf.PROCESSED, row_count=F.lit(7), path=F.lit("p")), root)
    mf.append_marks(mf.marks(files, "features", mf.GENERATED, row_count=F.lit(6), feature_count=F.lit(14)), root)
    events = mf.read_events(spark, root)
    assert mf.is_downloaded(events, name) and not mf.is_downloaded(events, "other")
    assert mf.file_status(events, name) == "FAILED" and mf.file_status(events, "other") is None
    assert mf.is_processed(events, name) and not mf.is_processed(events, name, "green") and mf.has_features(events, name)
    assert mf.recorded_files(events, "ingestion").first().first_seq == first
    states = {r.stage: r for r in mf.file_states(events).collect()}
    assert states["features"].feature_count == 14 and states["ingestion"].error == "broken"


def test_latest_is_the_file_marked_last(spark):
    rows = [("ingestion", "yellow", "yellow_tripdata_2026-03.parquet", "DOWNLOADED", 1),
            ("ingestion", "yellow", "yellow_tripdata_2026-01.parquet", "DOWNLOADED", 2)]
    row = mf.latest_files(spark.createDataFrame(rows, EVENT)).first()
    assert row.latest_file.endswith("2026-01.parquet") and row.files == 2


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "filename string")


def test_months_resume_after_the_file_marked_last(spark):
    listing = names(spark, *[f"yellow_tripdata_2026-{m:02d}.parquet" for m in range(1, 7)], "green_tripdata_2026-09.parquet")
    events = spark.createDataFrame(
        [("ingestion", "yellow", f"yellow_tripdata_2026-{m:02d}.parquet", "DOWNLOADED", i) for i, m in enumerate((1, 5, 3))], EVENT)
    got = pl.pending_months(spark, listing, events, "yellow", date(2026, 1, 1)).orderBy("filename").collect()
    assert [r.filename[-10:-8] for r in got] == ["04", "06"]
    fresh = pl.pending_months(spark, listing, events.limit(0), "yellow", date(2026, 2, 1))
    assert fresh.count() == 5
    assert pl.pending_months(spark, listing, events, "fhv", date(2026, 1, 1)).count() == 0
    later = events.withColumn("filename", F.lit("yellow_tripdata_2025-12.parquet"))
    assert pl.pending_months(spark, listing, later, "yellow", date(2026, 4, 1)).count() == 3


def test_work_cascade(spark):
    listing = names(spark, *[f"yellow_tripdata_2026-{m:02d}.parquet" for m in (1, 2, 3)], "green_tripdata_2026-01.parquet")
    done = spark.createDataFrame(
        [("processed", "yellow", f"yellow_tripdata_2026-{m:02d}.parquet", "PROCESSED", m) for m in (1, 2, 3)], EVENT)
    new = names(spark, "yellow_tripdata_2026-09.parquet")
    assert pl.select_work(new, listing, done, "yellow").count() == 1
    assert pl.select_work(None, listing, done.filter("seq < 3"), "yellow", force=True).first().filename[-10:-8] == "03"
    assert pl.select_work(None, listing, done, "yellow").count() == 0
    assert pl.select_work(None, listing, done, "yellow", True, 2026, [1, 2]).count() == 2
    assert pl.select_work(None, listing, done, "yellow", True, 2025).count() == 0


def test_rolling_history_ranks_per_dataset(spark):
    listing = names(spark, *[f"{d}_tripdata_2026-{m:02d}.parquet" for d in ("green", "yellow") for m in range(1, 6)])
    assert pl.rolling_history(listing, 2).count() == 4
    assert {r.dataset for r in pl.rolling_history(listing, 3, mix_datasets=True).collect()} == {"yellow"}
    with pytest.raises(DataValidationError):
        pl.rolling_history(listing, 0)


def test_round_trip_projection_and_replacement(spark, tmp_path):
    root, df = str(tmp_path), table(spark, valid_trips())
    zn.write_zone(df, root, "processed", "yellow_tripdata_2026-01.parquet")
    zn.write_zone(df.limit(1), root, "processed", "yellow_tripdata_2026-01.parquet")
    back = zn.read_zone(spark, root, "processed", "yellow_tripdata_2026-01.parquet", ["VendorID", "trip_distance"])
    assert back.columns == ["VendorID", "trip_distance"] and back.count() == 1
    with pytest.raises(DataValidationError):
        zn.read_zone(spark, root, "processed", "absent.parquet")
    with pytest.raises(DataValidationError):
        zn.read_zone(spark, root, "elsewhere", "x.parquet")


def test_a_replaced_table_swaps_at_once_or_not_at_all(spark, tmp_path):
    root, name, df = str(tmp_path), "yellow_tripdata_2026-01.parquet", table(spark, valid_trips())
    first = zn.write_zone(df, root, "raw", name)
    assert zn.current_path(spark, root, "raw", name) == first
    reader = zn.read_zone(spark, root, "raw", name)
    broken = df.withColumn("VendorID", F.when(F.col("VendorID") == 2, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("VendorID")))
    with pytest.raises(Exception, match="stop"):
        zn.write_zone(broken, root, "raw", name)
    assert zn.read_zone(spark, root, "raw", name).count() == 2
    assert [r.length for r in zn.list_zone(spark, root, "raw").collect()] == [zn.file_table(spark, root, "raw").agg(F.sum("length")).first()[0]]
    second = zn.write_zone(df.limit(1), root, "raw", name)
    # who began with the old version goes on with it, who comes now meets the new one
    assert reader.count() == 2 and zn.read_zone(spark, root, "raw", name).count() == 1
    listed = zn.file_table(spark, root, "raw").collect()
    assert {r.filename for r in listed} == {name} and {r.data_path.split("/raw/")[1] for r in listed} == {second.split("/raw/")[1]}
    assert zn.read_monthly_files(spark, [listed[0].data_path]).count() == 1
    assert zn.drop_old_versions(spark, root, "raw", name) == 2 and zn.drop_old_versions(spark, root, "raw", "other") == 0
    assert zn.read_zone(spark, root, "raw", name).count() == 1
    # a folder that was never replaced through the library is read as it lies there
    df.write.parquet(zn.zone_path(root, "raw", "green_tripdata_2026-01.parquet"))
    assert zn.read_zone(spark, root, "raw", "green_tripdata_2026-01.parquet").count() == 2
    assert zn.list_zone(spark, root, "raw").count() == 2


def test_isolation_finds_the_bad_names_and_runs_the_rest(spark):
    tried = []

    def attempt(group):
        tried.append(len(group))
        if any(name in ("c", "h") for name in group):
            raise DataValidationError(f"bad: {[n for n in group if n in 'ch']}")
        return sorted(group)

    done, broken = isolate("abcdefghij", attempt)
    assert sorted(n for group in done for n in group) == list("abdefgij") and set(broken) == {"c", "h"} and "['c']" in broken["c"]
    assert tried[0] == 10 and len(tried) < 16
    assert isolate([], attempt) == ([], {}) and len(isolate("abd", attempt)[0]) == 1
    with pytest.raises(RuntimeError):  # no fault of a file
        isolate("a", lambda group: (_ for _ in ()).throw(RuntimeError("cluster")))


def test_listing_skips_hidden_temporary_and_nested_files(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "nested").mkdir(parents=True)
    for name in ("yellow_tripdata_2026-01.parquet", ".hidden.parquet", "_draft.parquet", "part.tmp", "nested/deep.parquet", "note.txt"):
        valid_trips().to_parquet(raw / name)
    zn.write_zone(table(spark, valid_trips()), str(tmp_path), "raw", "green_tripdata_2026-01.parquet")
    got = {r.filename: r.length for r in zn.list_zone(spark, str(tmp_path), "raw").collect()}
    assert set(got) == {"yellow_tripdata_2026-01.parquet", "green_tripdata_2026-01.parquet"} and min(got.values()) > 0
    assert zn.list_zone(spark, str(tmp_path), "features").count() == 0


def test_name_parts(spark):
    rows = zn.with_name_parts(names(spark, "green_tripdata_2026-02.parquet", "odd.parquet", "a_2026-13.parquet")).collect()
    assert (rows[0].dataset, rows[0].year, rows[0].month, rows[0].month_start) == ("green", 2026, 2, date(2026, 2, 1))
    assert rows[1].dataset == "yellow" and rows[1].year is None and rows[2].month_start is None


def test_trip_file_errors(spark, tmp_path):
    good, text, broken = tmp_path / "a.parquet", tmp_path / "a.csv", tmp_path / "b.parquet"
    valid_trips().to_parquet(good)
    text.write_text("x")
    broken.write_text("not parquet")
    assert zn.read_trip_file(spark, str(good)).count() == 2
    assert zn.read_trip_file(spark, str(good), clean=True).count() == 2
    for path, message in ((text, "expected a Parquet"), (tmp_path / "no.parquet", "does not exist"), (broken, "unable to read")):
        with pytest.raises(DataValidationError, match=message):
            zn.read_trip_file(spark, str(path)).count()


def test_months_with_different_types_and_columns_unite(spark, tmp_path):
    one, two = tmp_path / "yellow_tripdata_2026-01.parquet", tmp_path / "yellow_tripdata_2026-02.parquet"
    valid_trips().to_parquet(one)
    valid_trips(passenger_count=[1.0, None], extra=[0.5, 0.5]).to_parquet(two)
    rows = zn.read_monthly_files(spark, [str(one), str(two)])
    assert rows.count() == 4 and dict(rows.dtypes)["passenger_count"] == "double"
    assert rows.filter("extra IS NULL").count() == 2 and rows.select("source_path").distinct().count() == 2


def test_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2026, 1, 1)), (2, None)], "id bigint, at timestamp_ntz")
    zn.write_jsonl(df, str(tmp_path / "lines"))
    assert zn.read_json(spark, str(tmp_path / "lines"), df.schema).count() == 2
    zn.write_small_json(df.limit(1), str(tmp_path / "small"))
    assert len(list((tmp_path / "small").glob("part-*.json"))) == 1
    assert zn.read_json(spark, str(tmp_path / "absent")) is None


def test_broadcast_only_below_the_checked_size(spark):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    small, big = spark.range(10), spark.range(100)
    assert "broadcast" in plan(spark.range(5).join(broadcast_if_small(small, 10), "id"))
    assert "broadcast" not in plan(spark.range(5).join(broadcast_if_small(big, 10), "id"))
