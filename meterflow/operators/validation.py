"""Strict validation: every violation count comes out of one aggregate, then the first one raises."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.config import (
    CleaningLimits, DROPOFF, FEATURE_REQUIRED, NON_NEGATIVE, NUMERIC_REQUIRED, PICKUP, RAW_REQUIRED, TARGET,
)
from meterflow.errors import DataValidationError
from meterflow.functions.parsing import is_missing, lenient_number, lenient_timestamp, with_canonical_times
from meterflow.functions.trip_time import minutes_between


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise DataValidationError(f"missing required columns: {absent}")


def null_shares(df: DataFrame, names: Sequence[str] = RAW_REQUIRED) -> DataFrame:
    """Percentage of missing values per column, in one row."""
    df = with_canonical_times(df)
    require_columns(df, names)
    return df.agg(*_null_percentages(df, names))


def _null_percentages(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [(F.avg(is_missing(df, name).cast("int")) * 100).alias(f"null_pct_{name}") for name in names]


def _violations(df: DataFrame, limits: CleaningLimits) -> dict[str, Column]:
    """Row-level conditions in the order in which they are reported."""
    times = {name: lenient_timestamp(df, name) for name in (PICKUP, DROPOFF)}
    numbers = {name: lenient_number(df, name) for name in {*NUMERIC_REQUIRED, *NON_NEGATIVE} & set(df.columns)}
    passengers = numbers["passenger_count"]
    listed = {f"invalid_{name}": value.isNull() for name, value in times.items()}
    for name in NUMERIC_REQUIRED:
        listed[f"non_numeric_{name}"] = numbers[name].isNull() | is_missing(df, name)
    for name in NON_NEGATIVE:
        if name in df.columns:
            listed[f"negative_{name}"] = numbers[name] < 0
    listed["bad_passenger_count"] = (passengers <= 0) | (passengers > limits.max_passengers)
    listed["bad_trip_distance"] = numbers["trip_distance"] <= 0
    listed["dropoff_not_after_pickup"] = times[DROPOFF] <= times[PICKUP]
    return listed


def violation_counts(df: DataFrame, limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    """Row count, null percentages and all strict rule violations, in one row from one scan."""
    df = with_canonical_times(df)
    require_columns(df, RAW_REQUIRED)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *_null_percentages(df, RAW_REQUIRED),
        *[F.count_if(bad).alias(name) for name, bad in _violations(df, limits).items()],
    )


def validate_trips(df: DataFrame, limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    """The trips with canonical time columns, or an error naming the first broken rule."""
    found = violation_counts(df, limits).first().asDict()
    if found.pop("total_rows") == 0:
        raise DataValidationError("the trip table is empty")
    shares = {name: found.pop(f"null_pct_{name}") for name in RAW_REQUIRED}
    sparse = {name: round(share, 2) for name, share in shares.items() if share > limits.max_null_pct}
    if sparse:
        raise DataValidationError(f"more than {limits.max_null_pct}% missing: {sparse}")
    _raise_first(found)
    return with_canonical_times(df)


def _raise_first(counts: dict[str, int]) -> None:
    for name, count in counts.items():
        if count:
            raise DataValidationError(f"{name}: {count} rows")


def check_null_shares(df: DataFrame, limits: CleaningLimits = CleaningLimits()) -> None:
    """Structure checks shared with cleaning: not empty, columns present, not mostly missing."""
    df = with_canonical_times(df)
    require_columns(df, RAW_REQUIRED)
    row = df.agg(F.count(F.lit(1)).alias("total_rows"), *_null_percentages(df, RAW_REQUIRED)).first().asDict()
    if row.pop("total_rows") == 0:
        raise DataValidationError("the trip table is empty")
    sparse = {name: round(share, 2) for name, share in row.items() if share > limits.max_null_pct}
    if sparse:
        raise DataValidationError(f"more than {limits.max_null_pct}% missing: {sparse}")


def target_counts(df: DataFrame, limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    """Violations of feature input and target, counted before any speed filter."""
    df = with_canonical_times(df)
    require_columns(df, FEATURE_REQUIRED)
    pickup, dropoff = lenient_timestamp(df, PICKUP), lenient_timestamp(df, DROPOFF)
    minutes = minutes_between(pickup, dropoff)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(pickup.isNull() | dropoff.isNull()).alias("invalid_times"),
        F.count_if(minutes.isNull()).alias("null_target"),
        F.count_if(minutes <= 0).alias("non_positive_target"),
        F.count_if(minutes > limits.max_minutes).alias("target_over_limit"),
    )


def validate_target(df: DataFrame, limits: CleaningLimits = CleaningLimits()) -> None:
    found = target_counts(df, limits).first().asDict()
    if found.pop("total_rows") == 0:
        raise DataValidationError("cannot create features from an empty table")
    _raise_first(found)


def missing_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(is_missing(df, name)).alias(f"missing_{name}") for name in names])


def validate_feature_matrix(df: DataFrame, names: Sequence[str]) -> None:
    """No rows lost to nulls later, and nothing in it that is only known after the trip."""
    leaked = [name for name in names if name in (DROPOFF, "dropoff_datetime", "lpep_dropoff_datetime")]
    if leaked:
        raise DataValidationError(f"drop-off time among the features: {leaked}")
    found = missing_counts(df, names).first().asDict()
    if found.pop("total_rows") == 0:
        raise DataValidationError("the feature table is empty")
    _raise_first(found)


def validate_training_table(df: DataFrame, features: Sequence[str], categorical: Sequence[str],
                            target: str = TARGET) -> None:
    require_columns(df, [*features, target])
    unusable = [
        name for name in features
        if not isinstance(df.schema[name].dataType, T.NumericType)
        and not (name in categorical and isinstance(df.schema[name].dataType, T.StringType))
    ]
    if unusable:
        raise DataValidationError(f"features must be numeric or categorical: {unusable}")
    validate_evaluation_table(df, features, target)


def validate_evaluation_table(df: DataFrame, features: Sequence[str], target: str = TARGET) -> None:
    require_columns(df, [*features, target])
    validate_feature_matrix(df, [*features, target])
