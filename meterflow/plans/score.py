"""Scoring a request table with the champion, and watching what came in."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.config import DriftSettings, ModelSettings
from meterflow.errors import DataValidationError
from meterflow.models.registry import champion_version, read_runs
from meterflow.models.scoring import score_requests
from meterflow.models.training import load_model
from meterflow.operators.drift import DISTANCE, DURATION, rolling_drift, with_reference
from meterflow.operators.requests import rejected_requests
from meterflow.session import prepare
from meterflow.sources.zones import read_json, zone_path

REFERENCE_TYPE = "buckets array<double>, fractions array<double>, sample_count bigint"


def exported_reference(spark: SparkSession, root: str) -> DataFrame | None:
    return read_json(spark, zone_path(root, "metadata", "reference_distribution"), REFERENCE_TYPE)


def score_job(spark: SparkSession, root: str, requests: DataFrame, as_of: date, out: str,
              settings: ModelSettings = ModelSettings(), drift: DriftSettings = DriftSettings()) -> dict[str, DataFrame]:
    """Write scored and rejected requests, then the rolling drift of the scored ones."""
    prepare(spark)
    runs = read_runs(spark, root)
    version = champion_version(runs, settings.name)
    if version is None:
        raise DataValidationError(f"no champion of {settings.name}")
    run = runs.filter((F.col("model") == settings.name) & (F.col("version") == version)).first()
    model = load_model(root, settings.name, version)
    scored = score_requests(model, requests, as_of, f"v{version}", run.algorithm, run_id=run.run_name,
                            features=settings.features)
    scored.write.mode("overwrite").parquet(f"{out}/scored")
    rejected_requests(requests, as_of).write.mode("overwrite").parquet(f"{out}/rejected")
    done = spark.read.parquet(f"{out}/scored")
    watched = (with_reference(DISTANCE, exported_reference(spark, root)), DURATION)
    return {
        "scored": done,
        "rejected": spark.read.parquet(f"{out}/rejected"),
        "drift": rolling_drift(done, ("pickup_datetime", "trip_id"), watched, drift),
    }
