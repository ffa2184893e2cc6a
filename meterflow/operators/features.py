"""Feature tables: one set of expressions for training and for scoring."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.config import CleaningLimits, DROPOFF, FEATURE_REQUIRED, FEATURES, PICKUP, TARGET
from meterflow.functions.parsing import lenient_timestamp, local_wall_clock, with_canonical_times
from meterflow.functions.trip_time import minutes_between, pickup_features, plausible_speed
from meterflow.operators.validation import require_columns


def timed_trips(df: DataFrame) -> DataFrame:
    """Trips with parsed times and their duration in minutes."""
    df = with_canonical_times(df)
    require_columns(df, FEATURE_REQUIRED)
    df = df.withColumns({name: lenient_timestamp(df, name) for name in (PICKUP, DROPOFF)})
    return df.withColumn(TARGET, minutes_between(F.col(PICKUP), F.col(DROPOFF)))


def training_features(df: DataFrame, keep: Sequence[str] = (), limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    """Features, target and pickup time in one narrow projection, without implausible trips.

    ``keep`` names identifying columns to carry along. The checks live in
    ``operators.validation.validate_target`` and ``validate_feature_matrix``.
    """
    timed = timed_trips(df)
    usable = timed.filter(
        F.col(TARGET).between(limits.min_minutes, limits.max_minutes)
        & plausible_speed(F.col("trip_distance"), F.col(TARGET), limits)
    )
    derived = pickup_features(F.col(PICKUP), F.col("PULocationID"), F.col("DOLocationID"))
    columns = [derived[name].alias(name) if name in derived else F.col(name)
               for name in FEATURES if name in derived or name in usable.columns]
    return usable.select(*keep, *columns, TARGET, F.col(PICKUP).alias("pickup_datetime"))


def scoring_features(df: DataFrame, expected: Sequence[str] = FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """Features of trips not yet driven, in exactly the order a model expects; unknown ones become 0."""
    wall = local_wall_clock(df, "pickup_datetime")
    derived = pickup_features(wall, F.col("PULocationID"), F.col("DOLocationID"))

    def feature(name: str):
        if name in derived:
            return derived[name].alias(name)
        return F.col(name) if name in df.columns else F.lit(0).alias(name)

    return df.select(*keep, *[feature(name) for name in expected])
