"""Permutation importance: lending between rows, scoring by leaves, and the whole against a plain shuffle."""

from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from frames import table
from meterflow.config import ModelSettings, TARGET
from meterflow.models import leaves, lending
from meterflow.models.leaves import read_ensemble
from meterflow.models.lending import Trial, borrowing_place, trial_losses
from meterflow.models.training import _turn_hashes, permutation_importance, predict, shuffled_place, train_model

NAMES = ("trip_distance", "pickup_hour", "zone", "pair")
FOREST = ModelSettings(algorithm="forest", trees=4, max_depth=5, subsample_rows=None, features=NAMES, categorical=("zone", "pair"),
                       importance_repeats=2)
BOOSTED = replace(FOREST, algorithm="boosting", trees=5, max_depth=3, max_categories=12)


def noisy_rows(spark, count=400, unknown=0):
    """Trips whose minutes hang on all features and on chance, so that trees grow many leaves; every fifth twice."""
    rng = np.random.default_rng(11)
    number = np.arange(count) - (np.arange(count) % 5 == 4)
    draw = lambda values: values[number]
    distance, hour, zone = draw(rng.uniform(0.5, 15, count)), draw(rng.integers(0, 24, count)), draw(rng.integers(0, 12, count))
    pair = draw(rng.integers(0, 40, count))
    minutes = 3 + 2 * distance + (hour % 7) + 8 * np.isin(zone, [0, 3, 7, 9]) + pair % 3 + draw(rng.uniform(0, 9, count))
    frame = pd.DataFrame({
        "trip_id": number, "pickup_datetime": [datetime(2026, 1, 1) + timedelta(minutes=int(i) * 7 % 500) for i in number],
        "trip_distance": distance, "pickup_hour": hour, "zone": zone, "pair": [f"p{i:02d}" for i in pair], TARGET: minutes})
    rows = table(spark, frame)
    return rows.withColumn(TARGET, F.when(F.col("trip_id") >= unknown, F.col(TARGET)))


@pytest.mark.parametrize("rows", [1, 2, 7, 1000, 40_000])
def test_the_borrower_is_the_way_back_of_the_shuffle(spark, rows):
    keys = (F.lit(42), F.lit("zone"), F.lit(3))
    turns = spark.range(1).select(_turn_hashes(*keys).alias("turns")).first().turns
    lent = spark.range(rows).select(shuffled_place(F.col("id"), rows, *keys).alias("donor")).orderBy("id").toPandas()["donor"].to_numpy()
    assert (borrowing_place(lent, rows, turns) == np.arange(rows)).all()


@pytest.mark.parametrize("settings, most", [
    (FOREST, 1024), (replace(FOREST, max_depth=9, bins=256), 1024), (replace(FOREST, max_depth=9, bins=256), 8),
    (replace(FOREST, trees=1, max_depth=0), 1024), (BOOSTED, 1024), (BOOSTED, 2)])
def test_leaves_score_an_exchanged_feature_like_the_model(spark, monkeypatch, settings, most):
    monkeypatch.setattr(leaves, "_MOST_LEAVES", most)
    rows = noisy_rows(spark)
    model = train_model(rows, settings)
    learned = model.stages[-2]
    vectors = np.array([r.features.toArray() for r in model.transform(rows).select("features").collect()])
    ensemble = read_ensemble(learned, len(NAMES))
    own, donor = ensemble.classes(vectors), np.random.default_rng(1).permutation(len(vectors))
    got = ensemble.scores(own, [*range(len(NAMES)), -1], np.stack([*own[:, donor], own[0]]))
    for i, at in enumerate([None, *range(len(NAMES)), None]):
        exchanged = vectors.copy()
        if at is not None:
            exchanged[:, at] = vectors[donor, at]
        asked = spark.createDataFrame([(Vectors.dense(v),) for v in exchanged.tolist()], ["features"])
        assert got[i] == pytest.approx([r.log_prediction for r in learned.transform(asked).collect()], rel=1e-12)
    if settings.max_depth > 7 and settings.algorithm == "forest":
        assert max(tree.numNodes for tree in learned.trees) > 2 * 64


@pytest.mark.parametrize("settings", [FOREST, BOOSTED])
def test_importance_over_many_blocks_equals_a_plain_shuffle(spark, monkeypatch, settings):
    monkeypatch.setattr(lending, "_FEW", 16)
    monkeypatch.setattr(lending, "_ITEMS", 8 * 37)  # blocks and packs of 37 rows
    rows = noisy_rows(spark, unknown=30)
    model = train_model(rows.filter(f"{TARGET} IS NOT NULL"), settings)
    got = {r.feature: r.importance for r in permutation_importance(model, rows, settings).collect()}
    frame = rows.toPandas().sort_values(["pickup_datetime", "trip_id"]).reset_index(drop=True)

    def r2(changed):
        scored = predict(model, spark.createDataFrame(changed.drop(columns=TARGET).reset_index())).orderBy("index").toPandas()["prediction"]
        known = frame[TARGET].notna().to_numpy()  # rows of unknown minutes lend, but are not judged
        y, errors = frame[TARGET][known], (scored.to_numpy() - frame[TARGET])[known]
        return 1 - (errors ** 2).mean() / y.var(ddof=0)

    base = r2(frame)
    for name in NAMES:
        losses = []
        for repeat in range(1, settings.importance_repeats + 1):
            keys = (F.lit(settings.seed), F.lit(name), F.lit(repeat))
            donor = spark.range(len(frame)).select(shuffled_place(F.col("id"), len(frame), *keys)).toPandas().to_numpy()[:, 0]
            losses.append(base - r2(frame.assign(**{name: frame[name].to_numpy()[donor]})))
        assert got[name] == pytest.approx(sum(losses) / len(losses), abs=1e-9)
    assert min(got["trip_distance"], got["zone"]) > 0.01


def test_a_feature_no_tree_splits_on_has_no_importance_at_all(spark):
    rows = noisy_rows(spark).withColumn("pickup_hour", F.lit(8))
    got = {r.feature: r.importance for r in permutation_importance(train_model(rows, FOREST), rows, FOREST).collect()}
    assert got["pickup_hour"] == 0.0 and set(got) == set(NAMES)


def test_odd_tables_have_the_importance_of_their_metric(spark):
    rows = noisy_rows(spark)
    model = train_model(rows, FOREST)
    one = permutation_importance(model, rows, replace(FOREST, importance_rows=1)).collect()
    assert len(one) == 4 and all(np.isnan(r.importance) for r in one)
    unknown = permutation_importance(model, rows.withColumn(TARGET, F.lit(None).cast("double")), FOREST).collect()
    assert len(unknown) == 4 and all(r.importance is None for r in unknown)
    with pytest.raises(Exception, match="Encountered null"):
        permutation_importance(model, rows.withColumn("trip_distance", F.lit(None).cast("double")), FOREST).collect()


def test_rows_are_sent_packed_and_never_copied_per_trial(spark):
    rows = noisy_rows(spark)
    plan = permutation_importance(train_model(rows, FOREST), rows, FOREST)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # one row for each row and trial met its donor in a join
    copies, packed = plan.index("Generate explode"), plan.index("MapInArrow")
    assert copies < packed and plan.count("Generate") == 1  # above it: of the one row of sums


def test_gaps_between_row_numbers_are_refused(spark):
    rows = noisy_rows(spark)
    model = train_model(rows, FOREST)
    scored = model.transform(rows).selectExpr("CAST(trip_id AS BIGINT) AS row", f"{TARGET} AS target", "prediction").withColumn(
        "vector", F.array(*[F.lit(1.0)] * 4))
    with pytest.raises(PySparkException, match="gaps or repeats"):
        trial_losses(scored, 400, read_ensemble(model.stages[-2], 4), [Trial(0, (1, 2))], np.expm1).collect()
