"""Chronological splits as a ``split`` column, and exact seeded samples."""

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.errors import DataValidationError
from meterflow.functions.parsing import lenient_timestamp
from meterflow.operators.ordering import at_or_before, keys_at_ranks

SPLITS = ("train", "validation", "test")


def chronological(df: DataFrame, order: Sequence[str] = ("pickup_datetime", "trip_id")) -> DataFrame:
    """Globally sorted rows; name enough columns to leave no ties."""
    return df.orderBy(*order)


def check_ratios(ratios: Sequence[float]) -> None:
    if any(ratio <= 0 for ratio in ratios):
        raise DataValidationError("all split ratios must be greater than zero")
    if not abs(sum(ratios) - 1.0) < 1e-9:
        raise DataValidationError("split ratios must sum to 1")


def split_by_ratio(df: DataFrame, ratios: Sequence[float] = (0.70, 0.15, 0.15),
                   order: Sequence[str] = ("pickup_datetime", "trip_id")) -> DataFrame:
    """First rows to train, next to validation, rest to test.

    Only the two keys at the cuts are looked up; the split itself is a comparison in the row's own
    task, with no sort or shuffle of the table.
    """
    check_ratios(ratios)

    def cuts(total: int) -> tuple[int, int]:
        train_end = int(total * ratios[0])
        validation_end = train_end + int(total * ratios[1])
        if train_end == 0 or validation_end == train_end or validation_end == total:
            raise DataValidationError(f"{total} rows leave a split part empty")
        return train_end, validation_end

    train_key, validation_key = keys_at_ranks(df, order, cuts)
    part = (F.when(at_or_before(train_key, df), "train")
            .when(at_or_before(validation_key, df), "validation").otherwise("test"))
    return df.withColumn("split", part)


def split_by_date(df: DataFrame, validation_from: datetime, test_from: datetime,
                  time: str = "pickup_datetime") -> DataFrame:
    """Calendar split; a row without a time belongs to no part and gets a null."""
    if validation_from >= test_from:
        raise DataValidationError(f"validation must start before test: {validation_from}, {test_from}")
    at = lenient_timestamp(df, time)
    first, second = (F.lit(cut).cast("timestamp_ntz") for cut in (validation_from, test_from))
    part = F.when(at < first, "train").when(at < second, "validation").when(at >= second, "test")
    return df.withColumn("split", part)


def split_trips(df: DataFrame, ratios: Sequence[float] = (0.70, 0.15, 0.15),
                validation_from: datetime | None = None, test_from: datetime | None = None,
                time: str = "pickup_datetime", order: Sequence[str] = ("pickup_datetime", "trip_id")) -> DataFrame:
    """By calendar when both cut-offs and the time column are there, else by ratio."""
    if validation_from is not None and test_from is not None and time in df.columns:
        return split_by_date(df, validation_from, test_from, time)
    return split_by_ratio(df, ratios, order)


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def check_split(split: DataFrame) -> dict[str, int]:
    """No row without a part, no part without a row."""
    sizes = {row.split: row.rows for row in split_sizes(split).collect()}  # at most four rows
    lost = sizes.pop(None, 0)
    if lost:
        raise DataValidationError(f"splitting lost {lost} rows")
    empty = [name for name in SPLITS if not sizes.get(name)]
    if empty:
        raise DataValidationError(f"empty split parts: {empty}")
    return sizes


def seeded_subsample(df: DataFrame, rows: int, seed: int, key: str = "trip_id") -> DataFrame:
    """Exactly ``rows`` rows, the same ones for the same seed and rows; all rows when there are fewer.

    The rows with the smallest hashes are the sample. The last of them is found by counting, so the sample
    is a filter. Rows that repeat an id are told apart by a hash of their other columns; of rows equal in
    all columns the missing number is one row repeated.
    """
    other = [f.name for f in df.schema if f.name != key and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    hashed = df.withColumns({
        "_hash": F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 1),
        "_rest": F.xxhash64(F.lit(seed), *other),
    })
    order = ("_hash", key, "_rest")
    cut = keys_at_ranks(hashed, order, lambda total: [rows] if total > rows else [])
    if not cut:
        return df
    upto = at_or_before(cut[0], hashed)
    last = reduce(and_, [F.col(name) == F.lit(value).cast(hashed.schema[name].dataType) for name, value in cut[0].items()])
    taken = hashed.agg(F.count_if(upto & ~last).alias("before"), F.count_if(last).alias("tied")).first()
    missing = rows - taken.before
    if missing == taken.tied:
        return hashed.filter(upto).select(*df.columns)
    equal = hashed.filter(last).limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(missing))))
    return hashed.filter(upto & ~last).select(*df.columns).unionByName(equal.select(*df.columns))


def head_rows(df: DataFrame, rows: int, order: Sequence[str] = ("pickup_datetime", "trip_id")) -> DataFrame:
    return df.orderBy(*order).limit(rows)
