"""Regression metrics, and the quality gate on them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.config import QualityGate, TARGET
from meterflow.errors import QualityGateError


def r2_score(rows: Column, mse: Column, variance: Column) -> Column:
    constant = F.when(mse == 0, 1.0).otherwise(0.0)
    return F.when(rows < 2, F.lit(float("nan"))).when(variance == 0, constant).otherwise(1.0 - mse / variance)


def regression_metrics(df: DataFrame, target: str = TARGET, prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 in one aggregate; variance rather than a difference of large sums."""
    error = F.col(prediction) - F.col(target)
    sums = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("_mse"),
        F.var_pop(target).alias("_variance"))
    r2 = r2_score(F.col("rows"), F.col("_mse"), F.col("_variance"))
    return sums.select(*by, "rows", "mae", F.sqrt("_mse").alias("rmse"), r2.alias("r2"))


def flat_metrics(by_split: DataFrame) -> DataFrame:
    """One row with ``val_*`` and ``test_*`` columns from metrics grouped by ``split``."""
    return by_split.agg(*[
        F.max(F.when(F.col("split") == split, F.col(metric))).alias(f"{prefix}_{metric}")
        for split, prefix in (("validation", "val"), ("test", "test"))
        for metric in ("mae", "rmse", "r2")
    ])


def _missing(metric: str):
    return F.col(metric).isNull() | F.isnan(F.col(metric))


def gated(metrics: DataFrame, gate: QualityGate = QualityGate()) -> DataFrame:
    """Reasons for which each row misses the gate, and whether it passes. A threshold may be off; a missing metric misses it."""
    reasons = []
    if gate.max_mae is not None:
        reasons.append(F.when(_missing("val_mae") | (F.col("val_mae") > gate.max_mae), F.lit("val_mae above maximum")))
    if gate.min_r2 is not None:
        reasons.append(F.when(_missing("val_r2") | (F.col("val_r2") < gate.min_r2), F.lit("val_r2 below minimum")))
    listed = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return metrics.withColumn("gate_reasons", listed).withColumn("passed", F.size("gate_reasons") == 0)


def check_gate(metrics: DataFrame, gate: QualityGate = QualityGate()) -> None:
    row = gated(metrics, gate).first()
    if not row.passed:
        raise QualityGateError(f"model rejected: {', '.join(row.gate_reasons)} "
                               f"(val_mae={row.val_mae:.4f}, val_r2={row.val_r2:.4f})")
