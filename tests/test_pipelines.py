from dataclasses import replace
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from frames import table
from meterflow.config import ModelSettings, TARGET
from meterflow.errors import DataValidationError, QualityGateError
from meterflow.models import encoding
from meterflow.models.encoding import choose_categories, coded_name, encoding_stages
from meterflow.models.registry import champion_version, next_version, read_runs, record_run
from meterflow.models.training import (
    load_model, permutation_importance, predict, save_model, shuffled_place, train_model, tree_importance,
)
from meterflow.plans.etl import etl_job, feature_files
from meterflow.plans.score import score_job
from meterflow.plans.train import load_history, train_job
from meterflow.sources import manifest as mf
from meterflow.session import materialise
from meterflow.sources.zones import MONTH_KEYS, read_json, write_zone, zone_path

SMALL = ModelSettings(algorithm="forest", trees=5, max_depth=5, subsample_rows=None)


def month(year, number, rows=300, seed=0, bad=0):
    rng = np.random.default_rng(seed + number)
    pickup = pd.Timestamp(year, number, 1) + pd.to_timedelta(rng.integers(0, 27 * 86400, rows), unit="s")
    distance = rng.uniform(0.5, 15.0, rows).round(2)
    distance[:bad] = 0.0
    minutes = 3 + 4 * np.maximum(distance, 0.5) + rng.uniform(0, 2, rows)
    return pd.DataFrame({
        "VendorID": rng.integers(1, 3, rows), "tpep_pickup_datetime": pickup.astype("datetime64[us]"),
        "tpep_dropoff_datetime": (pickup + pd.to_timedelta((minutes * 60).round(), unit="s")).astype("datetime64[us]"),
        "passenger_count": rng.integers(1, 5, rows), "trip_distance": distance, "PULocationID": rng.integers(1, 266, rows),
        "DOLocationID": rng.integers(1, 266, rows), "payment_type": 1, "fare_amount": 10.0, "total_amount": 12.0})


def land(root, dataset, year, number, **kwargs):
    folder = root / "raw"
    folder.mkdir(parents=True, exist_ok=True)
    month(year, number, **kwargs).to_parquet(folder / f"{dataset}_tripdata_{year}-{number:02d}.parquet")


@pytest.fixture(scope="module")
def trained_root(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("zone")
    for number in (1, 2, 3):
        land(root, "yellow", 2026, number)
    result = etl_job(spark, str(root))
    assert result.processed == [f"yellow_tripdata_2026-{m:02d}.parquet" for m in (1, 2, 3)] and not result.failed
    return str(root)


def test_etl_publishes_once_and_only_new_files(spark, trained_root):
    events = mf.read_events(spark, trained_root)
    states = {(r.stage, r.status) for r in mf.file_states(events).collect()}
    assert states == {("ingestion", "PROCESSED"), ("processed", "PROCESSED"), ("features", "FEATURES_GENERATED")}
    assert spark.read.parquet(zone_path(trained_root, "processed")).count() == 900
    row = mf.file_states(events).filter("stage = 'features'").first()
    assert row.row_count == 300 and row.feature_count == 14
    assert etl_job(spark, trained_root).processed == []
    assert mf.read_events(spark, trained_root).count() == events.count()


def test_etl_leaves_out_a_file_that_loses_too_much(spark, tmp_path):
    land(tmp_path, "green", 2026, 1)
    land(tmp_path, "green", 2026, 2, bad=200)
    land(tmp_path, "yellow", 2026, 1)
    with pytest.raises(DataValidationError, match="2026-02"):
        etl_job(spark, str(tmp_path), "green")
    events = mf.read_events(spark, str(tmp_path))
    assert mf.file_status(events, "green_tripdata_2026-02.parquet", "green") == "FAILED"
    assert mf.has_features(events, "green_tripdata_2026-01.parquet", "green")
    assert not mf.is_downloaded(events, "yellow_tripdata_2026-01.parquet")
    land(tmp_path, "green", 2026, 2)
    done = []
    assert etl_job(spark, str(tmp_path), "green", then=lambda: done.append(1)).processed == ["green_tripdata_2026-02.parquet"]
    assert done == [1] and mf.file_status(mf.read_events(spark, str(tmp_path)), "green_tripdata_2026-02.parquet", "green") == "PROCESSED"
    forced = etl_job(spark, str(tmp_path), "green", year=2026, months=[1], force=True)
    assert forced.processed == ["green_tripdata_2026-01.parquet"]
    assert spark.read.parquet(zone_path(str(tmp_path), "features")).filter("dataset = 'green'").count() == 600


def test_history_is_pruned_to_months_and_columns(spark, trained_root):
    assert load_history(spark, trained_root, replace(SMALL, history_months=2)).count() == 600
    assert load_history(spark, trained_root, SMALL, latest_only=True).count() == 300
    one = load_history(spark, trained_root, SMALL, filename="yellow_tripdata_2026-01.parquet")
    assert one.agg(F.max("pickup_datetime")).first()[0] < datetime(2026, 2, 1)
    assert TARGET in one.columns and "tpep_dropoff_datetime" not in one.columns
    with pytest.raises(DataValidationError):
        load_history(spark, trained_root, SMALL, dataset="green")


def test_train_then_score(spark, trained_root, tmp_path):
    first = train_job(spark, trained_root, SMALL)
    assert first["version"] == 1 and first["promoted"] and first["split"] == {"train": 630, "validation": 135, "test": 135}
    assert first["metrics"]["val_mae"] < 8 and set(first["metrics"]) >= {"val_r2", "test_mae", "test_rmse"}
    worse = train_job(spark, trained_root, replace(SMALL, trees=1, max_depth=1), gated=False,
                      validation_from=datetime(2026, 2, 1), test_from=datetime(2026, 3, 1))
    assert worse["version"] == 2 and not worse["promoted"] and worse["champion"] == 1
    runs = read_runs(spark, trained_root)
    assert runs.count() == 2 and "fi_trip_distance" in runs.first().metrics
    with pytest.raises(QualityGateError):
        train_job(spark, trained_root, replace(SMALL, gate=replace(SMALL.gate, max_mae=0.01)))
    assert read_runs(spark, trained_root).count() == 2
    reference = read_json(spark, zone_path(trained_root, "metadata", "reference_distribution")).first()
    assert len(reference.fractions) == 11 and reference.sample_count == 300

    asked = month(2026, 4).rename(columns={"tpep_pickup_datetime": "pickup_datetime"})
    asked["trip_id"] = range(len(asked))
    asked.loc[0, "passenger_count"] = 50
    out = score_job(spark, trained_root, table(spark, asked), date(2026, 1, 1), str(tmp_path / "out"), SMALL)
    assert out["scored"].count() == 299 and out["rejected"].count() == 1
    row = out["scored"].first()
    assert row.predicted_duration_minutes >= 1.0 and row.model_version == "v1"
    assert row.estimated_dropoff_datetime > row.pickup_datetime
    assert {r.feature for r in out["drift"].collect()} == {"trip_distance", "predicted_duration_minutes"}


def feature_rows(spark, count=200):
    rng = np.random.default_rng(7)
    distance = rng.uniform(0.5, 15, count)
    frame = pd.DataFrame({
        "trip_id": range(count), "pickup_datetime": [datetime(2026, 1, 1) + timedelta(hours=i) for i in range(count)],
        "trip_distance": distance, "pickup_hour": rng.integers(0, 24, count), "PU_DO_pair": rng.choice(["1_2", "2_3"], count),
        TARGET: 3 + 4 * distance})
    return table(spark, frame)


FEW = replace(SMALL, features=("trip_distance", "pickup_hour", "PU_DO_pair"), categorical=("PU_DO_pair",))


@pytest.mark.parametrize("algorithm", ["forest", "boosting", "RandomForestRegressor", "XGBRegressor"])
def test_models_predict_positive_minutes_and_survive_a_round_trip(spark, tmp_path, algorithm):
    rows = feature_rows(spark)
    model = train_model(rows, replace(FEW, algorithm=algorithm))
    before = [r.prediction for r in predict(model, rows).orderBy("trip_id").collect()]
    assert min(before) > 0
    save_model(model, str(tmp_path), "m", 1)
    after = [r.prediction for r in predict(load_model(str(tmp_path), "m", 1), rows).orderBy("trip_id").collect()]
    assert before == after


def test_unseen_category_is_scored(spark):
    rows = feature_rows(spark)
    model = train_model(rows, FEW)
    assert predict(model, rows.limit(1).withColumn("PU_DO_pair", F.lit("9_9"))).first().prediction > 0


def zone_rows(spark, count=600):
    """Minutes depend on a set of zones that no order of their numbers brings together."""
    zone = np.arange(count) % 12
    frame = pd.DataFrame({
        "trip_id": range(count), "pickup_datetime": datetime(2026, 1, 1), "zone": zone, "pair": [f"p{i % 40:02d}" for i in range(count)],
        TARGET: np.where(np.isin(zone, [0, 3, 4, 7, 9, 11]), 40.0, 5.0) + (np.arange(count) * 7 % 40) * 0.001})
    return table(spark, frame)


ZONED = replace(SMALL, algorithm="boosting", features=("zone", "pair"), categorical=("zone",), trees=1, max_depth=1, bins=8, max_categories=12)


def test_boosted_trees_split_few_values_by_sets_and_many_by_mean(spark):
    rows = zone_rows(spark)
    chosen = choose_categories(rows, ["zone", "pair"], 12)
    assert chosen.nominal == ("zone",) and chosen.ordered == ("pair",) and chosen.sizes == (12,)
    assert choose_categories(rows, ["zone", "pair"], 11).nominal == () and choose_categories(rows, [], 11).bins == 1
    model = train_model(rows, ZONED)
    # one cut is enough for a set, and more values than bins were asked for are no error
    assert "in {" in model.stages[-2].toDebugString
    errors = [abs(r.prediction - r[TARGET]) for r in predict(model, rows).collect()]
    assert max(errors) < 1.0
    ordinal = train_model(rows, replace(ZONED, max_categories=2))
    assert "in {" not in ordinal.stages[-2].toDebugString
    # a forest knows the order of the values alone
    forest = train_model(rows, replace(ZONED, algorithm="forest"))
    assert "in {" not in forest.stages[-2].toDebugString
    assert max(abs(r.prediction - r[TARGET]) for r in predict(forest, rows).collect()) > 10


def test_codes_above_the_threshold_follow_the_training_means(spark):
    rows = zone_rows(spark).withColumn("log", F.log1p(TARGET))
    stages = encoding_stages(rows, ["pair"], choose_categories(rows, ["pair"], 2), "log")
    coded = Pipeline(stages=stages).fit(rows).transform(rows)
    got = [r.pair for r in coded.select("pair", coded_name("pair")).distinct().orderBy(coded_name("pair")).collect()]
    means = rows.toPandas().groupby("pair")["log"].mean().round(9)
    assert got == sorted(means.index, key=lambda pair: (means[pair], pair))
    odd = spark.createDataFrame([("new",), (None,), (got[0],)], "pair string")
    codes = [r[0] for r in Pipeline(stages=stages).fit(rows).transform(odd).select(coded_name("pair")).collect()]
    assert codes == [40.0, 40.0, 0.0]


def test_a_category_is_known_by_value_whatever_its_number_type(spark):
    rows = zone_rows(spark)
    model = train_model(rows, ZONED)
    same = [predict(model, rows.withColumn("zone", F.col("zone").cast(kind))).agg(F.sum("prediction")).first()[0]
            for kind in ("int", "bigint", "double", "string")]
    assert len(set(round(v, 6) for v in same)) == 1
    missing = predict(model, rows.withColumn("zone", F.lit(None).cast("bigint")).limit(1)).first()
    assert missing.prediction > 0


def test_a_key_is_no_category(spark, monkeypatch):
    monkeypatch.setattr(encoding, "MOST_LABELS", 30)
    with pytest.raises(DataValidationError, match="pair"):
        choose_categories(zone_rows(spark), ["zone", "pair"], 12)


def test_importance_ranks_the_real_cause_first(spark):
    rows = feature_rows(spark)
    model = train_model(rows, FEW)
    trees = tree_importance(model, spark, FEW.features).collect()
    shuffled = permutation_importance(model, rows, replace(FEW, importance_rows=100)).collect()
    assert trees[0].feature == shuffled[0].feature == "trip_distance" and len(trees) == len(shuffled) == 3
    assert shuffled[0].importance > 0.5 > abs(shuffled[-1].importance)


@pytest.mark.parametrize("rows", [1, 2, 7, 1000])
def test_a_shuffle_is_a_bijection_of_any_number_of_places(spark, rows):
    df = spark.range(rows).crossJoin(spark.range(3).withColumnRenamed("id", "trial"))
    got = df.select("trial", "id", shuffled_place(F.col("id"), rows, F.lit(42), F.col("trial")).alias("to")).collect()
    for trial in range(3):
        assert sorted(r.to for r in got if r.trial == trial) == list(range(rows))
    if rows == 1000:  # far from where they were, and different in each trial
        moved = [abs(r.to - r.id) for r in got]
        assert 280 < sum(moved) / len(moved) < 390
        assert len({(r.id, r.to) for r in got}) > 2900


def test_importance_of_all_rows_equals_a_plain_shuffle_with_the_same_places(spark):
    rows = feature_rows(spark)
    model = train_model(rows, FEW)
    got = {r.feature: r.importance for r in permutation_importance(model, rows, FEW).collect()}
    frame = rows.select(*FEW.features, "pickup_datetime", "trip_id", "trip_duration_minutes").toPandas()
    frame = frame.sort_values(["pickup_datetime", "trip_id"]).reset_index(drop=True)

    def r2(table):
        scored = predict(model, spark.createDataFrame(table)).toPandas()
        y = scored["trip_duration_minutes"]
        return 1 - ((y - scored["prediction"]) ** 2).sum() / ((y - y.mean()) ** 2).sum()

    name = "trip_distance"
    places = spark.range(len(frame)).crossJoin(spark.range(1, FEW.importance_repeats + 1).selectExpr("CAST(id AS INT) AS repeat"))
    donor = shuffled_place(F.col("id"), len(frame), F.lit(FEW.seed), F.lit(name), F.col("repeat"))
    lent = places.select("repeat", "id", donor.alias("donor")).toPandas().sort_values(["repeat", "id"])
    losses = [r2(frame) - r2(frame.assign(**{name: frame[name].to_numpy()[own["donor"].to_numpy()]})) for _, own in lent.groupby("repeat")]
    assert got[name] == pytest.approx(sum(losses) / len(losses))


def test_training_parameters_are_checked(spark):
    with pytest.raises(DataValidationError):
        train_model(feature_rows(spark), replace(FEW, trees=0))
    with pytest.raises(ValueError, match="unsupported"):
        train_model(feature_rows(spark), replace(FEW, algorithm="LinearRegression"))


def test_run_records(spark, tmp_path):
    root = str(tmp_path)
    assert next_version(read_runs(spark, root), "m") == 1 and champion_version(read_runs(spark, root), "m") is None
    for version, mae in ((1, 3.0), (2, 3.1), (3, 2.0)):
        record_run(spark, root, "m", version, f"run{version}", "forest", {"trees": "5"}, {"val_mae": mae}, ["p"], datetime.now())
    runs = read_runs(spark, root)
    assert next_version(runs, "m") == 4 and champion_version(runs, "m") == 3
    assert champion_version(runs, "m", tolerance=0.5) == 1


def test_etl_marks_an_empty_file_below_a_path_with_blanks(spark, tmp_path):
    root = tmp_path / "own zone + more"
    land(root, "green", 2026, 1)
    land(root, "green", 2026, 2)
    empty = f"{zone_path(str(root), 'raw')}/green_tripdata_2026-03.parquet"
    spark.read.parquet(f"{zone_path(str(root), 'raw')}/green_tripdata_2026-01.parquet").limit(0).write.parquet(empty)
    with pytest.raises(DataValidationError, match="2026-03"):
        etl_job(spark, str(root), "green")
    events = mf.read_events(spark, str(root))
    assert mf.file_status(events, "green_tripdata_2026-03.parquet", "green") == "FAILED"
    assert mf.file_status(events, "green_tripdata_2026-02.parquet", "green") == "PROCESSED"


def test_etl_isolates_bad_files(spark, tmp_path):
    root = str(tmp_path)
    for number in (1, 2, 3, 4, 5, 6):
        land(tmp_path, "green", 2026, number, rows=60)
    raw = tmp_path / "raw"

    def rewritten(number, change):
        path = raw / f"green_tripdata_2026-{number:02d}.parquet"
        change(pd.read_parquet(path)).to_parquet(path)

    (raw / "green_tripdata_2026-02.parquet").write_bytes(b"no Parquet at all" * 20)
    rewritten(3, lambda df: df.drop(columns="trip_distance"))
    rewritten(4, lambda df: df.assign(VendorID=df["VendorID"].astype("Int64").where(df.index % 3 > 0)))
    whole = (raw / "green_tripdata_2026-05.parquet").read_bytes()
    # a sound footer over damaged pages
    (raw / "green_tripdata_2026-05.parquet").write_bytes(whole[:4] + b"\xff" * 600 + whole[604:])
    result = etl_job(spark, root, "green", stop_on_failure=False)
    assert result.processed == [f"green_tripdata_2026-{m:02d}.parquet" for m in (1, 6)]
    states = {r.filename[-10:-8]: r for r in mf.file_states(mf.read_events(spark, root)).filter("stage = 'ingestion'").collect()}
    assert {m: r.status for m, r in states.items()} == {"01": "PROCESSED", "06": "PROCESSED", **{f"0{m}": "FAILED" for m in (2, 3, 4, 5)}}
    assert states["02"].error == "the file cannot be read" == states["05"].error and "100.00% missing" in states["03"].error
    assert states["04"].error == "20 clean trips lack a vendor or zone"
    published = spark.read.parquet(zone_path(root, "features")).groupBy("month").count().collect()
    assert {r.month: r["count"] for r in published} == {1: 60, 6: 60}
    land(tmp_path, "green", 2026, 2, rows=60)
    assert etl_job(spark, root, "green", stop_on_failure=False).processed == ["green_tripdata_2026-02.parquet"]


def test_a_month_with_gaps_never_shows_among_the_features(spark, tmp_path):
    root = str(tmp_path)
    for number in (1, 2, 3):
        land(tmp_path, "yellow", 2026, number, rows=60)
    etl_job(spark, root)
    processed = materialise(spark.read.parquet(zone_path(root, "processed")), "processed")
    hollow = processed.filter("month = 2").withColumn("DOLocationID", F.when(F.col("trip_distance") > 5, F.col("DOLocationID")))
    write_zone(hollow.unionByName(processed.filter("month = 3").withColumn("trip_distance", F.lit(90.0))), root, "processed", partition_by=MONTH_KEYS)
    spark.catalog.refreshByPath(zone_path(root, "processed"))
    names = [f"yellow_tripdata_2026-{m:02d}.parquet" for m in (1, 2, 3)]

    def old_months():
        return sorted(path for path in spark.read.parquet(zone_path(root, "features")).inputFiles() if "/month=1/" not in path)

    before = old_months()
    result = feature_files(spark, root, names)
    assert result.processed == names[:1] and result.failed == names[1:]
    errors = {r.filename: r.error for r in mf.read_events(spark, root).filter("stage = 'features' AND status = 'FAILED'").collect()}
    assert errors == {names[1]: f"{names[1]} lacks DOLocationID, PU_DO_pair", names[2]: "no trip is usable for features"}
    # what was published of it before is untouched
    assert len(before) == 2 and old_months() == before
