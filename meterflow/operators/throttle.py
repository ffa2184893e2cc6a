"""Marks on a request log: which requests a per-client sliding limit would have admitted.

A decision depends on earlier decisions, so it is no window function. But most requests can be decided
alone: with fewer than ``limit`` earlier requests in the window, admitted or not, a request is admitted.
Only requests around the others are walked in order, with the last ``limit`` admitted times as state.

Those walks are speculative: a client's time slices are all walked at once, each from an empty window. What a
slice hands on, the times admitted in its last window, is then held against what the next one started from. Only
slices that started from something else are walked again, from what they were handed; most soon decide as before
and hand on the same, which settles all that follows. A chain that stays unsettled is walked in runs of 2, 4, 8, ...
slices, so even a client whose windows never forget their start takes a number of rounds that grows with the logarithm
of its slices.
"""

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.session import materialise

_MICROS = 1_000_000


def admit_in_order(times: np.ndarray, recent: deque, limit: int, window: int) -> np.ndarray:
    """Decide ordered times; ``recent`` holds the last ``limit`` admitted times and is updated.

    A time exactly ``window`` old still counts. Denied runs are skipped by binary search.
    """
    admitted = np.zeros(len(times), dtype=bool)
    at = 0
    while at < len(times):
        if len(recent) == limit:
            at = max(at, int(np.searchsorted(times, recent[0] + window, side="right")))
            if at == len(times):
                break
            recent.popleft()
        recent.append(int(times[at]))
        admitted[at] = True
        at += 1
    return admitted


def throttle_marks(df: DataFrame, client: str, time: str, request_id: str, limit: int = 60,
                   window_seconds: int = 60, slice_windows: int = 60) -> DataFrame:
    """Add ``admitted``. Requests of a client are ordered by time, then id; one without a time has no decision (null)."""
    if limit < 1 or slice_windows < 2:
        raise ValueError("limit must be at least 1, and a slice at least two windows long")
    window = window_seconds * _MICROS
    untimed = df.filter(F.col(time).isNull()).select("*", F.lit(None).cast("boolean").alias("admitted"))
    # both kinds of rows come from the same three ordered passes: run those once
    flagged = materialise(_flagged(df, client, time, request_id, limit, window, window * slice_windows), "throttle")
    free = flagged.filter(~F.col("_contested")).select(*df.columns, F.lit(True).alias("admitted"))
    contested = flagged.filter("_contested").select(*df.columns, "_t", "_slice", F.to_json(F.struct(client)).alias("_who"))
    walked = _settled(contested, request_id, limit, window, window * slice_windows)
    return free.unionByName(walked.select(*df.columns, "admitted")).unionByName(untimed)


def _settled(contested: DataFrame, request_id: str, limit: int, window: int, slice_micros: int) -> DataFrame:
    """Walk all slices from empty windows, then again those that start from another window than was handed on."""
    marks = [materialise(_walked(contested, None, request_id, limit, window, 0), "throttle-marks")]
    handed = [_handed_on(marks[0], window, slice_micros)]
    # a row per client and contested slice
    slices = materialise(marks[0].groupBy("_who", "_slice").agg(
        F.lit(0).alias("_round"), F.lit(None).cast("string").alias("_assumed"), F.lit(False).alias("_follows")), "throttle-slices")
    while True:
        latest = slices.select("_who", (F.col("_slice") + 1).alias("_slice"), "_round")
        carry = _union([h.withColumn("_round", F.lit(i)) for i, h in enumerate(handed)]).join(latest, ["_who", "_slice", "_round"], "left_semi")
        digest = carry.groupBy("_who", "_slice").agg(
            F.concat_ws(",", F.count(F.lit(1)), F.sum(F.xxhash64("_t").cast("decimal(20,0)"))).alias("_given"))
        judged = slices.join(digest, ["_who", "_slice"], "left")
        # a slice walked right behind its predecessor cannot differ: whatever walks the one again walks the other
        due = ~F.col("_follows") & ~F.col("_assumed").eqNullSafe(F.col("_given"))
        run = Window.partitionBy("_who", F.shiftright("_slice", len(marks) - 1))
        judged = materialise(judged.withColumn("_first", F.min(F.when(due, F.col("_slice"))).over(run)), "throttle-slices")
        if judged.filter("_first IS NOT NULL").isEmpty():
            break
        again = judged.filter("_slice >= _first").select("_who", "_slice")
        starts = carry.drop("_round").join(judged.filter("_slice = _first").select("_who", "_slice"), ["_who", "_slice"], "left_semi")
        rows = contested.join(again, ["_who", "_slice"], "left_semi")
        marks.append(materialise(_walked(rows, starts, request_id, limit, window, len(marks) - 1), "throttle-marks"))
        handed.append(_handed_on(marks[-1], window, slice_micros))
        redone = F.coalesce(F.col("_slice") >= F.col("_first"), F.lit(False))
        slices = judged.select(
            "_who", "_slice", F.when(redone, len(marks) - 1).otherwise(F.col("_round")).alias("_round"),
            F.when(redone, F.col("_given")).otherwise(F.col("_assumed")).alias("_assumed"),
            F.when(redone, F.col("_slice") > F.col("_first")).otherwise(F.col("_follows")).alias("_follows"))
    if len(marks) == 1:
        return marks[0]
    return _union([m.join(slices.filter(F.col("_round") == i), ["_who", "_slice"], "left_semi") for i, m in enumerate(marks)])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _handed_on(marks: DataFrame, window: int, slice_micros: int) -> DataFrame:
    """The admitted times that still count when the next slice begins, ``limit`` at most."""
    still = F.col("admitted") & (F.col("_t") >= (F.col("_slice") + 1) * slice_micros - window)
    return marks.filter(still).select("_who", (F.col("_slice") + 1).alias("_slice"), "_t")


def _walked(rows: DataFrame, starts: DataFrame | None, request_id: str, limit: int, window: int, shift: int) -> DataFrame:
    """Walk runs of 2 ** shift slices in order. ``starts`` are times that count at a run's first slice; they come first."""
    columns = rows.columns
    both = rows.withColumn("_start", F.lit(False))
    if starts is not None:
        both = both.unionByName(starts.withColumn("_start", F.lit(True)), allowMissingColumns=True)
    both = (both.withColumn("_run", F.shiftright("_slice", shift)).repartition("_who", "_run")
            .sortWithinPartitions("_who", "_run", "_t", request_id))
    schema = T.StructType([*rows.schema.fields, T.StructField("admitted", T.BooleanType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, recent = None, deque()
        for batch in batches:
            if not batch.num_rows:
                continue
            who, run = batch.column("_who"), batch.column("_run")
            fresh = pc.or_(pc.not_equal(who[1:], who[:-1]), pc.not_equal(run[1:], run[:-1])).to_numpy(zero_copy_only=False)
            begins = np.concatenate(([0], np.flatnonzero(fresh) + 1))
            times = batch.column("_t").to_numpy()
            start = batch.column("_start").to_numpy(zero_copy_only=False)
            marks = np.zeros(len(times), bool)
            for a, b in zip(begins, [*begins[1:], len(times)]):
                key = (who[a].as_py(), run[a].as_py())
                if key != current:
                    current, recent = key, deque(maxlen=limit)
                known = a + int(start[a:b].sum())
                recent.extend(times[a:known].tolist())
                marks[known:b] = admit_in_order(times[known:b], recent, limit, window)
            real = batch.select(columns).append_column("admitted", pa.array(marks))
            yield real.filter(pa.array(~start))

    return both.mapInArrow(walk, schema)


def _flagged(df: DataFrame, client: str, time: str, request_id: str, limit: int, window: int,
             slice_micros: int) -> DataFrame:
    """Flag requests that matter to an undecided one.

    A client's requests are cut into time slices, so a busy client is many groups. Each slice also sees
    two windows before it and one after it, which is all its own flags depend on.
    """
    t = F.unix_micros(F.col(time).cast("timestamp"))
    inside = F.pmod(F.col("_t"), F.lit(slice_micros))
    own = F.call_function("div", F.col("_t") - inside, F.lit(slice_micros))
    homes = F.array_compact(F.array(
        own,
        F.when(inside >= slice_micros - 2 * window, own + 1),
        F.when(inside <= window, own - 1),
    ))
    spread = df.withColumn("_t", t).withColumn("_own", own).withColumn("_slice", F.explode(homes))

    forward = Window.partitionBy(client, "_slice").orderBy("_t", request_id)
    backward = Window.partitionBy(client, "_slice").orderBy(F.desc("_t"), F.desc(request_id))
    after = backward.rowsBetween(Window.unboundedPreceding, -1)

    # the request `limit` places earlier is still inside the window
    full = F.coalesce(F.col("_t") - F.lag("_t", limit).over(forward) <= window, F.lit(False))
    spread = spread.withColumn("_full", full)
    to_next = F.min(F.when(F.col("_full"), F.col("_t"))).over(after) - F.col("_t")
    spread = spread.withColumn("_contested", F.col("_full") | F.coalesce(to_next <= window, F.lit(False)))
    return spread.filter(F.col("_slice") == F.col("_own"))
