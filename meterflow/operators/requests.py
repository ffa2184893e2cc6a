"""Scoring-request checks: defaults for absent fields, and all reasons for a rejection."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.config import RequestLimits
from meterflow.errors import DataValidationError
from meterflow.functions.parsing import is_missing, lenient_timestamp


def _with_defaults(df: DataFrame, limits: RequestLimits) -> DataFrame:
    defaults = {
        "VendorID": limits.default_vendor,
        "passenger_count": limits.default_passengers,
        "PULocationID": limits.default_pickup_zone,
        "DOLocationID": limits.default_dropoff_zone,
    }
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    })


def checked_requests(df: DataFrame, as_of: date, limits: RequestLimits = RequestLimits()) -> DataFrame:
    """Requests with defaults filled in and an array of rejection reasons, empty when valid."""
    absent = sorted({"pickup_datetime", "trip_distance"} - set(df.columns))
    if absent:
        raise DataValidationError(f"missing required request columns: {absent}")
    filled = _with_defaults(df, limits)
    year = F.year(lenient_timestamp(filled, "pickup_datetime"))
    last_year = max(as_of.year + 1, limits.min_last_year)
    good: dict[str, Column] = {
        "vendor": F.col("VendorID").between(*limits.vendors),
        "pickup": year.between(limits.min_year, last_year),
        "passengers": F.col("passenger_count").between(*limits.passengers),
        "distance": (F.col("trip_distance") > 0) & (F.col("trip_distance") <= limits.max_distance)
        & ~is_missing(filled, "trip_distance"),
        "pickup_zone": F.col("PULocationID").between(*limits.zones),
        "dropoff_zone": F.col("DOLocationID").between(*limits.zones),
    }
    reasons = F.array_compact(F.array(*[
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in good.items()
    ]))
    return filled.withColumn("reject_reasons", reasons)


def valid_requests(df: DataFrame, as_of: date, limits: RequestLimits = RequestLimits()) -> DataFrame:
    return checked_requests(df, as_of, limits).filter(F.size("reject_reasons") == 0).drop("reject_reasons")


def rejected_requests(df: DataFrame, as_of: date, limits: RequestLimits = RequestLimits()) -> DataFrame:
    return checked_requests(df, as_of, limits).filter(F.size("reject_reasons") > 0)
