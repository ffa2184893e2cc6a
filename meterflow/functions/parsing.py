"""Lenient parsing: what cannot be read becomes null, never an error."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.config import DROPOFF, DROPOFF_ALIASES, LOCAL_ZONE, PICKUP, PICKUP_ALIASES

_ZONED_TEXT = r"(Z|[+-]\d{2}:?\d{2})$"


def with_canonical_times(df: DataFrame) -> DataFrame:
    """Add the canonical pickup and drop-off columns from the first alias present."""
    added = {}
    for name, aliases in ((PICKUP, PICKUP_ALIASES), (DROPOFF, DROPOFF_ALIASES)):
        found = [alias for alias in aliases if alias in df.columns]
        if name not in df.columns and found:
            added[name] = F.col(found[0])
    return df.withColumns(added) if added else df


def lenient_timestamp(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name)
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(name)).cast("timestamp_ntz")
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def lenient_number(df: DataFrame, name: str) -> Column:
    """A numeric column stays bare, because a cast would keep its filters out of the Parquet scan."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name)
    return F.col(name).try_cast("double")


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or not-a-number in a floating column."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def local_wall_clock(df: DataFrame, name: str) -> Column:
    """Zoned times become the local wall clock; times without a zone stay as they are."""
    kind = df.schema[name].dataType
    plain = lenient_timestamp(df, name)
    moved = F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), plain)
    if isinstance(kind, T.TimestampType):
        return moved
    if isinstance(kind, T.StringType):
        return F.when(F.col(name).rlike(_ZONED_TEXT), moved).otherwise(plain)
    return plain
