"""Positions in a global order, without ever putting the table, or one hot key of it, in one task."""

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.errors import DataValidationError
from meterflow.session import materialise, range_partitions

_EPOCH = datetime(1970, 1, 1)
_BINS = 1024
_FEW_ROWS = 10_000


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index",
                   partitions: int | None = None) -> DataFrame:
    """Add a 1-based position in the order of ``order``.

    Rows are range-partitioned on all order columns together, so many rows sharing one time still
    spread over partitions. The sorted rows are written once, because range bounds come from a sample
    and a second run might cut elsewhere. Only the partition sizes are summed up: one row per
    partition. Select the columns you need before calling: all of them are written.
    """
    parts = partitions or range_partitions(df.sparkSession)
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    placed = materialise(placed, "ordered").withColumn("_part", F.shiftright("_slot", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    # at most one row per partition, so this side never grows with the data
    indexed = placed.join(F.broadcast(offsets), "_part")
    position = F.col("_before") + F.col("_slot").bitwiseAND((1 << 33) - 1) + 1
    return indexed.select(*df.columns, position.alias(name))


def trailing_counts(df: DataFrame, position: str, counters: Sequence[str], width: int,
                    chunk_rows: int = 50_000, following: Sequence[str] = ()) -> DataFrame:
    """Replace each counter by its sum over the last ``width`` positions, gapless positions given.

    Positions are cut into equal chunks, each with the ``width`` rows before it copied in, so the work
    per task is fixed. A running sum minus the running sum ``width`` rows earlier costs the same for
    any width, unlike a sliding frame. ``following`` adds ``next_*`` columns with the next row's values.
    """
    chunk_rows = max(chunk_rows, width)
    zero_based = F.col(position) - 1
    own, inside = F.call_function("div", zero_based, F.lit(chunk_rows)), zero_based % chunk_rows
    homes = F.array_compact(F.array(
        own,
        F.when(inside >= chunk_rows - width, own + 1),
        F.when((inside == 0) & (own > 0), own - 1) if following else F.lit(None),
    ))
    spread = df.withColumn("_own", own).withColumn("_chunk", F.explode(homes))
    ordered = Window.partitionBy("_chunk").orderBy(position)
    running = spread.withColumns({
        **{f"_run_{c}": F.sum(c).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) for c in counters},
        **{f"next_{c}": F.lead(c).over(ordered) for c in following},
    })
    trailing = running.withColumns({
        c: F.col(f"_run_{c}") - F.lag(f"_run_{c}", width, 0).over(ordered) for c in counters
    })
    return (trailing.filter(F.col("_chunk") == F.col("_own"))
            .select(*df.columns, *[f"next_{c}" for c in following]))


def keys_at_ranks(df: DataFrame, order: Sequence[str], pick: Callable[[int], Sequence[int]]) -> list[dict[str, Any]]:
    """Order-key values of the rows at some 1-based ranks, by counting instead of sorting.

    ``pick`` maps the row count to the wanted ranks. Each pass counts the rows in at most some 1024 ranges
    of the first column that still varies and goes on with the range that holds the rank, between the
    least and greatest value seen there. Numbers, times, dates, flags, text and bytes are all counted; a
    range of few rows is finished by a top-k, which finds the same row in fewer jobs. Filters on stored
    columns reach the scan, so later passes read little. The first two passes serve all ranks.
    """
    scope = df.select(*order)
    kinds = [_kind(scope, name) for name in order]
    whole = scope.agg(F.count(F.lit(1)).alias("rows"), *[F.count(name).alias(f"keyed_{i}") for i, name in enumerate(order)],
                      F.min(kinds[0].key).alias("lo"), F.max(kinds[0].key).alias("hi")).first()
    for i, name in enumerate(order):
        if whole[f"keyed_{i}"] < whole.rows:
            raise DataValidationError(f"order column {name} holds missing values")
    ranks = pick(whole.rows)
    if any(not 1 <= rank <= whole.rows for rank in ranks):
        raise DataValidationError(f"no row at one of the ranks {list(ranks)} of {whole.rows}")
    first = None
    if ranks and whole.rows > _FEW_ROWS and not _same(whole.lo, whole.hi):
        first = _range_counts(scope, kinds[0], whole.lo, whole.hi)
    return [_key_at_rank(scope, kinds, rank, whole, first) for rank in ranks]


def key_at_rank(df: DataFrame, order: Sequence[str], rank: int) -> dict[str, Any]:
    return keys_at_ranks(df, order, lambda _: [rank])[0]


def _key_at_rank(scope: DataFrame, kinds: list["_Kind"], rank: int, whole: Row, counts: list[Row] | None):
    order, found = [kind.name for kind in kinds], {}
    for i, kind in enumerate(kinds):
        if i:
            whole = scope.agg(F.count(F.lit(1)).alias("rows"), F.min(kind.key).alias("lo"), F.max(kind.key).alias("hi")).first()
        part = whole
        while part.rows > _FEW_ROWS and not _same(part.lo, part.hi):
            for row in counts or _range_counts(scope, kind, part.lo, part.hi):
                if rank <= row.rows:
                    part = row
                    break
                rank -= row.rows
            counts = None
            scope = scope.filter(kind.stored.between(kind.literal(part.lo), kind.literal(part.hi)))
        if part.rows <= _FEW_ROWS:
            rest = [k.key.alias(k.name) for k in kinds[i:]]
            last = scope.orderBy(*order).offset(rank - 1).limit(1).select(*rest).first()
            return found | {k.name: k.value(last[k.name]) for k in kinds[i:]}
        found[kind.name] = kind.value(part.lo)  # this column is pinned to one value
        counts = None
    return found


def _same(lo: Any, hi: Any) -> bool:
    return lo == hi or (lo != lo and hi != hi)  # not-a-number is one value


def _range_counts(scope: DataFrame, kind: "_Kind", lo: Any, hi: Any) -> list[Row]:
    """Rows, least and greatest value of each range that is not empty, in order."""
    inside = scope.filter(kind.stored.between(kind.literal(lo), kind.literal(hi)))
    counts = inside.groupBy(kind.bins(lo, hi).alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(kind.key).alias("lo"), F.max(kind.key).alias("hi"))
    return counts.orderBy("bin").collect()


@dataclass(frozen=True)
class _Kind:
    """How a column is counted: ``key`` is collected, ``bins`` never falls as it rises and tells ``lo`` from ``hi``."""

    name: str
    stored: Column
    key: Column
    bins: Callable[[Any, Any], Column]
    value: Callable[[Any], Any] = lambda v: v
    literal: Callable[[Any], Column] = F.lit


def _kind(df: DataFrame, name: str) -> _Kind:
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.IntegralType):
        return _Kind(name, col, col.cast("bigint"), _whole_bins(col.cast("bigint")))
    if isinstance(kind, T.BooleanType):
        return _Kind(name, col.cast("bigint"), col.cast("bigint"), _whole_bins(col.cast("bigint")), bool)
    if isinstance(kind, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), col)
        at = lambda v: _EPOCH + timedelta(microseconds=v)
        return _Kind(name, col, micros, _whole_bins(micros), at, lambda v: F.lit(at(v)).cast("timestamp_ntz"))
    if isinstance(kind, T.TimestampType):
        at = lambda v: _EPOCH.replace(tzinfo=timezone.utc) + timedelta(microseconds=v)
        return _Kind(name, col, F.unix_micros(col), _whole_bins(F.unix_micros(col)), at, lambda v: F.timestamp_micros(F.lit(v)))
    if isinstance(kind, T.DateType):
        at = lambda v: _EPOCH.date() + timedelta(days=v)
        return _Kind(name, col, F.unix_date(col), _whole_bins(F.unix_date(col).cast("bigint")), at, lambda v: F.lit(at(v)))
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return _Kind(name, col, col, lambda lo, hi: _real_bins(col, kind, lo, hi))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return _Kind(name, col, col, lambda lo, hi: _byte_bins(col.cast("binary"), lo, hi))
    raise DataValidationError(f"order column {name} of type {kind.simpleString()} has no order")


def _whole_bins(key: Column) -> Callable[[int, int], Column]:
    return lambda lo, hi: F.call_function("div", key, F.lit(-(-(hi - lo + 1) // _BINS)))


def _real_bins(key: Column, kind: T.DataType, lo: Any, hi: Any) -> Column:
    if isinstance(kind, T.DecimalType):
        offset, span = (key - F.lit(lo)).cast("double"), float(hi - lo)
    elif not (math.isfinite(lo) and math.isfinite(hi)):
        key = key.cast("double")
        return (F.when(F.isnan(key), 3).when(key == float("inf"), 2).when(key == float("-inf"), 0).otherwise(1))
    else:
        scale = 1.0 if math.isfinite(hi - lo) else 0.5  # the widest spans overflow
        offset, span = key.cast("double") * scale - lo * scale, hi * scale - lo * scale
    return F.least(F.floor(offset / span * _BINS), F.lit(_BINS - 1))


def _byte_bins(key: Column, lo: Any, hi: Any) -> Column:
    """By the two bytes after what the least and the greatest value have in common; a missing byte comes first."""
    lo, hi = (v.encode() if isinstance(v, str) else bytes(v) for v in (lo, hi))
    shared = next((i for i, (a, b) in enumerate(zip(lo, hi)) if a != b), min(len(lo), len(hi)))
    place = lambda v: sum((v[shared + i] + 1 if shared + i < len(v) else 0) * w for i, w in enumerate((257, 1)))

    def byte(i: int) -> Column:
        return F.coalesce(F.conv(F.hex(F.substring(key, shared + 1 + i, 1)), 16, 10).try_cast("bigint") + 1, F.lit(0))

    return F.call_function("div", byte(0) * 257 + byte(1), F.lit(-(-(place(hi) - place(lo) + 1) // _BINS)))


def at_or_before(key: dict[str, Any], df: DataFrame) -> Column:
    """True for rows whose order key is not after ``key``, compared column by column."""
    values = {name: F.lit(value).cast(df.schema[name].dataType) for name, value in key.items()}
    names = list(values)
    branches = []
    for depth, name in enumerate(names):
        last = depth == len(names) - 1
        step = F.col(name) <= values[name] if last else F.col(name) < values[name]
        for equal in names[:depth]:
            step = (F.col(equal) == values[equal]) & step
        branches.append(step)
    return reduce(or_, branches)
