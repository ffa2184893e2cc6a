"""Run records: appended rows, from which versions and champions follow."""

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.champions import champion_history, current_champions
from meterflow.sources.zones import zone_path

RUN_TYPE = (
    "model string, version bigint, run_name string, algorithm string, params map<string,string>, "
    "metrics map<string,double>, artifacts array<string>, started_at timestamp, ended_at timestamp"
)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(RUN_TYPE).parquet(zone_path(root, "metadata", "model_runs"))
    except AnalysisException:
        return spark.createDataFrame([], RUN_TYPE)


def record_run(spark: SparkSession, root: str, model: str, version: int, run_name: str, algorithm: str,
               params: dict[str, str], metrics: dict[str, float], artifacts: list[str], started_at: datetime) -> DataFrame:
    """Append one finished run. One writer per model is assumed."""
    row = (model, version, run_name, algorithm, params, metrics, artifacts, started_at, datetime.now())
    run = spark.createDataFrame([row], RUN_TYPE)
    run.coalesce(1).write.mode("append").parquet(zone_path(root, "metadata", "model_runs"))
    return run


def next_version(runs: DataFrame, model: str) -> int:
    last = runs.filter(F.col("model") == model).agg(F.max("version").alias("last")).first().last
    return 1 if last is None else last + 1


def judged_runs(runs: DataFrame, metric: str = "val_mae", tolerance: float = 0.0,
                higher_is_better: bool = False) -> DataFrame:
    """Every run with the metric pulled out and whether it was promoted when it arrived."""
    measured = runs.withColumn(metric, F.col("metrics").getItem(metric))
    return champion_history(measured, metric=metric, tolerance=tolerance, higher_is_better=higher_is_better)


def champion_version(runs: DataFrame, model: str, **rule) -> int | None:
    """The version the champion pointer of a model rests on; older champions stay on disk."""
    row = current_champions(judged_runs(runs.filter(F.col("model") == model), **rule)).select("version").first()
    return row.version if row else None
