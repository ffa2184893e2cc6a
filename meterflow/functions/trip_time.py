"""Pickup-time feature expressions, shared by training, scoring and streams."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.config import CleaningLimits, RUSH_HOURS


def minutes_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(6e7)


def plausible_speed(distance: Column, minutes: Column, limits: CleaningLimits) -> Column:
    mph = distance / (minutes / F.lit(60.0))
    return (mph <= limits.max_mph) & ((minutes <= limits.slow_trip_minutes) | (mph >= limits.min_mph))


def pickup_features(pickup: Column, pickup_zone: Column, dropoff_zone: Column) -> dict[str, Column]:
    hour, day_of_week = F.hour(pickup), F.weekday(pickup)
    angle = hour * F.lit(2 * math.pi) / F.lit(24.0)
    weekend = day_of_week >= 5
    return {
        "pickup_hour": hour,
        "pickup_day_of_week": day_of_week,
        "pickup_month": F.month(pickup),
        "pickup_day": F.dayofmonth(pickup),
        "is_weekend": weekend.cast("int"),
        "pickup_hour_sin": F.sin(angle),
        "pickup_hour_cos": F.cos(angle),
        "is_rush_hour": (~weekend & hour.isin(*RUSH_HOURS)).cast("int"),
        # concat, unlike concat_ws, keeps a missing zone visible as a null pair
        "PU_DO_pair": F.concat(pickup_zone.cast("string"), F.lit("_"), dropoff_zone.cast("string")),
    }


def finished_prediction(minutes: Column) -> Column:
    return F.greatest(F.lit(1.0), F.round(minutes, 2))


def plus_minutes(start: Column, minutes: Column) -> Column:
    micros = F.round(minutes * F.lit(6e7)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, start)
