"""Batch scoring of trip tables of any size."""

from collections.abc import Sequence
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.config import FEATURES, RequestLimits
from meterflow.functions.parsing import lenient_timestamp
from meterflow.functions.trip_time import finished_prediction, plus_minutes
from meterflow.operators.features import scoring_features
from meterflow.operators.requests import valid_requests


def score_requests(model: PipelineModel, requests: DataFrame, as_of: date, version: str, algorithm: str,
                   source: str = "registry", run_id: str | None = None, features: Sequence[str] = FEATURES,
                   keep: Sequence[str] = ("trip_id",), limits: RequestLimits = RequestLimits()) -> DataFrame:
    """Predicted minutes and arrival for every valid request; works on streams as well."""
    valid = valid_requests(requests, as_of, limits)
    pickup = lenient_timestamp(valid, "pickup_datetime")
    valid = valid.withColumn("_pickup", pickup)
    carried = list(dict.fromkeys([*keep, "_pickup"]))
    vectors = scoring_features(valid, features, keep=carried)
    minutes = finished_prediction(F.col("prediction"))
    others = [name for name in ("trip_distance",) if name in features and name not in keep]
    return model.transform(vectors).withColumn("predicted_duration_minutes", minutes).select(
        *keep, *others, "predicted_duration_minutes", F.col("_pickup").alias("pickup_datetime"),
        plus_minutes(F.col("_pickup"), F.col("predicted_duration_minutes")).alias("estimated_dropoff_datetime"),
        F.lit(version).alias("model_version"), F.lit(algorithm).alias("model_algorithm"),
        F.lit(source).alias("model_source"), F.lit(run_id).cast("string").alias("run_id"))
