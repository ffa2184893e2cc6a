"""Counters, rates, histograms, quantiles and alert rules over request and prediction events.

Sliding windows are sums of whole steps: events are first counted per step, and only those counts are
copied into the windows that hold them, so the number of copies does not grow with the events.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.config import KNOWN_ENDPOINTS, LATENCY_BOUNDS
from meterflow.functions.histograms import bound_index, bucket_quantile, running_totals
from meterflow.session import materialise

_MICROS = 1_000_000
_RANGES = 256


def known_endpoint(endpoint: Column) -> Column:
    return F.when(endpoint.isin(*KNOWN_ENDPOINTS), endpoint).otherwise("unmatched")


def request_counts(df: DataFrame) -> DataFrame:
    labelled = df.withColumn("endpoint", known_endpoint(F.col("endpoint")))
    return labelled.groupBy("method", "endpoint", "status").agg(F.count(F.lit(1)).alias("requests"))


def prediction_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("model_version", "status").agg(F.count(F.lit(1)).alias("predictions"))


def batch_summary(df: DataFrame, batch: str = "batch_start") -> DataFrame:
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("trips"), F.avg("predicted_duration_minutes").alias("avg_predicted_minutes"))


def step_start(time: Column, seconds: int) -> Column:
    """Start of the step holding a time, steps counted from the epoch."""
    return F.window(time, f"{seconds} seconds").getField("start")


def rates(df: DataFrame, keys: Sequence[str], time: str = "ts", seconds: int = 60) -> DataFrame:
    """Events per second in each window that has any."""
    counted = df.groupBy(*keys, step_start(F.col(time), seconds).alias("window_start"))
    return counted.agg((F.count(F.lit(1)) / F.lit(float(seconds))).alias("per_second"))


def cumulative_histogram(df: DataFrame, value: str, bounds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """One row per group and bound: how many values are at or below it, with the sum and the count."""
    counts = [F.count_if(F.col(value) <= bound) for bound in bounds]
    buckets = [F.struct(F.lit(str(bound)).alias("le"), F.col(f"_c{i}").alias("cumulative"))
               for i, bound in enumerate(bounds)]
    buckets.append(F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("cumulative")))
    wide = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        *[count.alias(f"_c{i}") for i, count in enumerate(counts)],
        F.count(F.lit(1)).alias("total"), F.sum(value).alias("value_sum"))
    return wide.select(*keys, F.inline(F.array(*buckets)), "value_sum", "total")


def sliding(steps: DataFrame, sums: Sequence[str], keys: Sequence[str] = (), time: str = "step",
            step_seconds: int = 60, window_seconds: int = 300) -> DataFrame:
    """Sums of step rows over every window of ``window_seconds`` ending with a step that it overlaps."""
    if window_seconds % step_seconds:
        raise ValueError("the window must be a whole number of steps")
    shifts = F.sequence(F.lit(0), F.lit(window_seconds // step_seconds - 1))
    spread = steps.withColumn("_shift", F.explode(shifts))
    end = F.timestamp_add("SECOND", (F.col("_shift") + 1) * step_seconds, F.col(time))
    return spread.groupBy(*keys, end.alias("window_end")).agg(*[F.sum(s).alias(s) for s in sums])


def latency_quantiles(df: DataFrame, quantiles: dict[str, float], value: str = "latency_s",
                      bounds: Sequence[float] = LATENCY_BOUNDS, keys: Sequence[str] = ("endpoint",),
                      time: str = "ts", step_seconds: int = 60, window_seconds: int = 300) -> DataFrame:
    """Bucket quantiles over sliding windows."""
    names = [f"_n{i}" for i in range(len(bounds) + 1)]
    bucket = bound_index(F.col(value), bounds)
    steps = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, step_start(F.col(time), step_seconds).alias("step"))
        .agg(*[F.count_if(bucket == i).alias(name) for i, name in enumerate(names)])
    )
    windows = sliding(steps, names, keys, "step", step_seconds, window_seconds)
    counts = [F.col(name) for name in names]
    return windows.select(
        *keys, "window_end", running_totals(counts)[-1].alias("total"),
        *[bucket_quantile(q, counts, bounds).alias(name) for name, q in quantiles.items()],
    )


def exact_quantiles(df: DataFrame, quantiles: dict[str, float], value: str = "latency_s",
                    keys: Sequence[str] = ("endpoint",), time: str = "ts", window_seconds: int = 300,
                    few_rows: int = 10_000) -> DataFrame:
    """Exact interpolated quantiles per tumbling window, for checking the bucket estimates.

    The ranks of all quantiles are selected in all groups at once by counting: a pass counts each group's rows in
    ``_RANGES`` equal ranges between the least and greatest value still possible for a rank, and goes on in the range that
    holds it. Counts are summed before they are shuffled, so no group's values are ever held together, whatever its
    share of the rows; only a range of at most ``few_rows`` is put in order. Values that are null or not a number are
    left out; a group without any has null quantiles.
    """
    group = [f"_k{i}" for i in range(len(keys) + 1)]
    named = [*[F.col(k).alias(g) for k, g in zip(keys, group)], step_start(F.col(time), window_seconds).alias(group[-1])]
    number = F.col(value).cast("double")
    rows = df.select(*named, F.when(~F.isnan(number), number).alias("_v"))
    rows = materialise(rows.withColumn("_group", F.struct(*group)), "quantiles")
    sizes = materialise(rows.groupBy("_group", *group).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "quantiles")
    values = rows.filter("_v IS NOT NULL").select("_group", "_v")
    wanted = [F.struct(F.lit(name).alias("_name"), (F.lit(q) * (F.col("_n") - 1)).alias("_at")) for name, q in quantiles.items()]
    places = sizes.filter("_n > 0").select("_group", "_n", "_lo", "_hi", F.inline(F.array(*wanted)))
    both = F.explode(F.array_distinct(F.array(F.floor("_at") + 1, F.ceil("_at") + 1)))
    # one target per group and rank; ``_left`` is its rank among the rows of its range
    targets = places.select("_group", both.alias("_rank"), F.col("_n").alias("_rows"), "_lo", "_hi").distinct().withColumn("_left", F.col("_rank"))
    known = None
    while True:
        targets = materialise(targets, "quantile-ranges")
        done = targets.filter("_lo = _hi").select("_group", "_rank", F.col("_lo").alias("_value"))
        known = done if known is None else known.unionByName(done)
        small = (F.col("_rows") <= few_rows) & (F.col("_lo") < F.col("_hi"))
        inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
        order = Window.partitionBy("_group", "_rank").orderBy("_v")
        ranked = values.join(targets.filter(small), "_group").filter(inside).withColumn("_place", F.row_number().over(order))
        known = known.unionByName(ranked.filter("_place = _left").select("_group", "_rank", F.col("_v").alias("_value")))
        large = targets.filter(~small & (F.col("_lo") < F.col("_hi")))
        if large.isEmpty():
            break
        # halves, so that the widest spans do not overflow
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        part = F.when(F.col("_v") == F.col("_lo"), -1).when(F.col("_v") == F.col("_hi"), _RANGES).otherwise(
            F.least(F.floor(F.coalesce(share, F.lit(0.0)) * _RANGES), F.lit(_RANGES - 1)))
        counted = values.join(large, "_group").filter(inside).groupBy("_group", "_rank", "_left", part.alias("_part")).agg(
            F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        so_far = Window.partitionBy("_group", "_rank").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_before", F.coalesce(F.sum("_rows").over(so_far), F.lit(0)))
        held = (F.col("_before") < F.col("_left")) & (F.col("_left") <= F.col("_before") + F.col("_rows"))
        targets = counted.filter(held).select("_group", "_rank", (F.col("_left") - F.col("_before")).alias("_left"), "_rows", "_lo", "_hi")
    known = materialise(known, "quantile-values")
    low = known.select("_group", (F.col("_rank") - 1).alias("_floor"), F.col("_value").alias("_below"))
    high = known.select("_group", (F.col("_rank") - 1).alias("_ceil"), F.col("_value").alias("_above"))
    near = places.select("_group", "_name", "_at", F.floor("_at").alias("_floor"), F.ceil("_at").alias("_ceil"))
    near = near.join(low, ["_group", "_floor"]).join(high, ["_group", "_ceil"])
    between = F.col("_below") + (F.col("_above") - F.col("_below")) * (F.col("_at") - F.col("_floor"))
    found = near.groupBy("_group").agg(*[F.max(F.when(F.col("_name") == name, between)).alias(f"_q{i}") for i, name in enumerate(quantiles)])
    return sizes.join(found, "_group", "left").select(
        *[F.col(g).alias(k) for g, k in zip(group, [*keys, "window_start"])], *[F.col(f"_q{i}").alias(name) for i, name in enumerate(quantiles)])


def error_ratio(df: DataFrame, time: str = "ts", step_seconds: int = 60, window_seconds: int = 300) -> DataFrame:
    """Share of server errors over sliding windows."""
    steps = df.groupBy(step_start(F.col(time), step_seconds).alias("step")).agg(
        F.count_if(F.col("status").between(500, 599)).alias("errors"), F.count(F.lit(1)).alias("requests"))
    windows = sliding(steps, ["errors", "requests"], (), "step", step_seconds, window_seconds)
    return windows.withColumn("ratio", F.col("errors") / F.col("requests"))


def sustained(df: DataFrame, condition: Column, for_seconds: int, keys: Sequence[str] = (),
              time: str = "window_end", step_seconds: int = 60) -> DataFrame:
    """Times at which the condition has held at every step for ``for_seconds``.

    A step holds for itself and is copied to the following steps it vouches for; a time fires when all
    its vouchers arrived. A missing step breaks the chain, and no ordered pass over all steps is needed.
    """
    back = for_seconds // step_seconds
    true_steps = df.filter(F.coalesce(condition, F.lit(False))).select(*keys, time).distinct()
    copied = true_steps.withColumn("_shift", F.explode(F.sequence(F.lit(0), F.lit(back))))
    at = F.timestamp_add("SECOND", F.col("_shift") * step_seconds, F.col(time))
    return (copied.groupBy(*keys, at.alias("fires_at")).agg(F.count(F.lit(1)).alias("_held"))
            .filter(F.col("_held") == back + 1).drop("_held"))


def error_rate_alert(df: DataFrame, above: float = 0.05, for_seconds: int = 120, **windows) -> DataFrame:
    step = windows.get("step_seconds", 60)
    return sustained(error_ratio(df, **windows), F.col("ratio") > above, for_seconds, step_seconds=step)


def slow_alert(df: DataFrame, above: float = 2.0, for_seconds: int = 120, **windows) -> DataFrame:
    step = windows.get("step_seconds", 60)
    p95 = latency_quantiles(df, {"p95": 0.95}, keys=(), **windows)
    return sustained(p95, F.col("p95") > above, for_seconds, step_seconds=step)


def drift_alert(alerts: DataFrame, time: str = "ts", for_seconds: int = 60, step_seconds: int = 60,
                window_seconds: int = 600) -> DataFrame:
    """Any HIGH drift row in the window, held for ``for_seconds``."""
    high = alerts.filter(F.col("severity") == "HIGH")
    steps = high.groupBy(step_start(F.col(time), step_seconds).alias("step")).agg(F.count(F.lit(1)).alias("alerts"))
    windows = sliding(steps, ["alerts"], (), "step", step_seconds, window_seconds)
    return sustained(windows, F.col("alerts") > 0, for_seconds, step_seconds=step_seconds)


def alert_totals(alerts: DataFrame) -> DataFrame:
    """Alerts by severity; a severity without alerts shows zero."""
    return alerts.agg(
        F.count_if(F.col("severity") == "HIGH").alias("HIGH"), F.count_if(F.col("severity") == "MEDIUM").alias("MEDIUM"),
    ).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("severity"), F.col(name).alias("alerts")) for name in ("HIGH", "MEDIUM")])))


def heartbeat_gaps(df: DataFrame, source: str, time: str = "ts", min_seconds: int = 60) -> DataFrame:
    """Silences longer than ``min_seconds`` per source.

    Such a silence cannot lie inside one slot of that length, so events shrink to first and last per
    slot before the ordered pass: its size depends on elapsed time, not on traffic.
    """
    slots = df.groupBy(source, step_start(F.col(time), min_seconds).alias("_slot")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"))
    ordered = Window.partitionBy(source).orderBy("_slot")
    gaps = slots.withColumn("silent_until", F.lead("_first").over(ordered))
    length = F.timestamp_diff("MICROSECOND", F.col("_last"), F.col("silent_until"))
    return gaps.filter(length > min_seconds * _MICROS).select(
        source, F.col("_last").alias("silent_from"), "silent_until", (length / F.lit(1e6)).alias("gap_seconds"))


def activity_sessions(df: DataFrame, client: str = "client", time: str = "ts", gap_seconds: int = 60) -> DataFrame:
    """Activity of each client between silences longer than ``gap_seconds``.

    Events in one slot of that length always share a session, so they are counted per slot first.
    """
    slots = df.groupBy(client, step_start(F.col(time), gap_seconds).alias("_slot")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), F.count(F.lit(1)).alias("_events"))
    ordered = Window.partitionBy(client).orderBy("_slot")
    silence = F.timestamp_diff("MICROSECOND", F.lag("_last").over(ordered), F.col("_first"))
    slots = slots.withColumn("_fresh", F.coalesce((silence > gap_seconds * _MICROS).cast("int"), F.lit(1)))
    slots = slots.withColumn("_session", F.sum("_fresh").over(ordered))
    end = F.timestamp_add("SECOND", F.lit(gap_seconds), F.max("_last"))
    return slots.groupBy(client, "_session").agg(
        F.min("_first").alias("session_start"), end.alias("session_end"), F.sum("_events").alias("requests"),
    ).drop("_session")


def status_down(df: DataFrame, flag: Column, keys: Sequence[str] = (), time: str = "ts", for_seconds: int = 60,
                step_seconds: int = 60) -> DataFrame:
    """Times at which the last reported flag of each step was 0 for ``for_seconds``."""
    steps = df.groupBy(*keys, step_start(F.col(time), step_seconds).alias("window_end")).agg(
        F.max_by(flag, F.col(time)).alias("_flag"))
    return sustained(steps, F.col("_flag") == 0, for_seconds, keys, step_seconds=step_seconds)


def current_status(df: DataFrame, flag: str, keys: Sequence[str], time: str = "ts") -> DataFrame:
    """The best last-known flag over all reporters: one row."""
    last = df.groupBy(*keys).agg(F.max_by(flag, time).alias("_flag"))
    return last.agg(F.max("_flag").alias("status"))
