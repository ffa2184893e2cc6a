import random

import pytest

from meterflow.config import QualityGate
from meterflow.errors import QualityGateError
from meterflow.operators.champions import champion_history, current_champions
from meterflow.operators.evaluation import check_gate, flat_metrics, gated, regression_metrics


def walked(rows, tolerance, higher):
    best, won = {}, {}
    for model, version, metric in sorted(rows, key=lambda r: r[1]):
        champion = best.get(model)
        bar = None if champion is None else champion * (1 + tolerance if higher else 1 - tolerance)
        won[model, version] = bar is None or (metric >= bar if higher else metric <= bar)
        if won[model, version]:
            best[model] = metric
    return won


@pytest.mark.parametrize("tolerance", [0.0, 0.05])
@pytest.mark.parametrize("higher", [False, True])
@pytest.mark.parametrize("low", [0.1, -5.0])
def test_history_equals_a_walk(spark, tolerance, higher, low):
    rng = random.Random(11)
    rows = [("hot" if rng.random() < 0.6 else rng.choice("abc"), v, round(rng.uniform(low, 5.0), 1)) for v in range(600)]
    df = spark.createDataFrame(rows, "model string, version bigint, val_mae double").repartition(5)
    got = champion_history(df, tolerance=tolerance, higher_is_better=higher, chunk=50).collect()
    assert {(r.model, r.version): r.promoted for r in got} == walked(rows, tolerance, higher)


def test_worse_challenger_stays_challenger(spark):
    df = spark.createDataFrame([("m", 1, 3.00), ("m", 2, 3.10), ("m", 3, 3.00)], "model string, version bigint, val_mae double")
    history = champion_history(df)
    assert [r.promoted for r in history.orderBy("version").collect()] == [True, False, True]
    assert current_champions(history).first().version == 3


def test_run_without_metric_is_not_promoted(spark):
    df = spark.createDataFrame([("m", 1, None), ("m", 2, 3.0), ("m", 3, None)], "model string, version bigint, val_mae double")
    for tolerance in (0.0, 0.1):
        got = champion_history(df, tolerance=tolerance).orderBy("version").collect()
        assert [r.promoted for r in got] == [False, True, False]


def test_metrics_of_known_errors(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 20.0), (30.0, 27.0)], "trip_duration_minutes double, prediction double")
    row = regression_metrics(df).first()
    assert row.mae == pytest.approx(5 / 3) and row.rmse == pytest.approx((13 / 3) ** 0.5)
    assert row.r2 == pytest.approx(1 - 13 / 200)


def test_r2_of_a_constant_target(spark):
    exact = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "trip_duration_minutes double, prediction double")
    off = spark.createDataFrame([(5.0, 5.0), (5.0, 6.0)], "trip_duration_minutes double, prediction double")
    assert regression_metrics(exact).first().r2 == 1.0 and regression_metrics(off).first().r2 == 0.0


def test_flat_metrics_name_their_split(spark):
    df = spark.createDataFrame([("validation", 1.0, 2.0, 0.5), ("test", 3.0, 4.0, 0.25)], "split string, mae double, rmse double, r2 double")
    assert flat_metrics(df).first().asDict() == {
        "val_mae": 1.0, "val_rmse": 2.0, "val_r2": 0.5, "test_mae": 3.0, "test_rmse": 4.0, "test_r2": 0.25}


def test_gate_bounds_are_inclusive_and_may_be_off(spark):
    df = spark.createDataFrame([(8.0, 0.3), (8.01, 0.29)], "val_mae double, val_r2 double")
    good, bad = gated(df).orderBy("val_mae").collect()
    assert good.passed and not bad.passed and len(bad.gate_reasons) == 2
    assert all(r.passed for r in gated(df, QualityGate(None, None)).collect())
    with pytest.raises(QualityGateError, match="val_mae above maximum"):
        check_gate(df.filter("val_mae > 8"))
    with pytest.raises(QualityGateError):
        check_gate(df.filter("val_mae = 8"), QualityGate(max_mae=0.0))


@pytest.mark.parametrize("higher", [True, False])
@pytest.mark.parametrize("tolerance", [0.0, 0.01])
def test_a_metric_that_is_no_number_is_no_champion(spark, higher, tolerance):
    values = [0.5, float("nan"), 0.9, 0.2]
    df = spark.createDataFrame([("m", v, x) for v, x in enumerate(values)], "model string, version int, val_mae double")
    rows = champion_history(df, higher_is_better=higher, tolerance=tolerance).orderBy("version").collect()
    assert [r.promoted for r in rows] == ([True, False, True, False] if higher else [True, False, False, True])
