"""Drift of live values against a reference distribution."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.config import DISTANCE_EDGES, DISTANCE_SHARES, DriftSettings, DURATION_EDGES, DURATION_SHARES
from meterflow.functions.histograms import (
    bucket_counts,
    bucket_index,
    floored_shares,
    severity,
    smoothed_shares,
    stability_index,
)
from meterflow.operators.ordering import trailing_counts, with_row_index


@dataclass(frozen=True)
class Monitored:
    """A watched column with its bucket edges and reference shares."""

    column: str
    edges: tuple[float, ...]
    shares: tuple[float, ...]

    @property
    def buckets(self) -> int:
        return len(self.edges) + 1

    @property
    def names(self) -> list[str]:
        return [f"b{i}" for i in range(self.buckets)]


DISTANCE = Monitored("trip_distance", DISTANCE_EDGES, DISTANCE_SHARES)
DURATION = Monitored("predicted_duration_minutes", DURATION_EDGES, DURATION_SHARES)


def bucket_table(df: DataFrame, feature: Monitored, by: Sequence[str] = ()) -> DataFrame:
    """One row per group with a count per bucket; nulls are not counted."""
    bucket = bucket_index(F.col(feature.column), feature.edges)
    return df.groupBy(*by).agg(*bucket_counts(bucket, feature.buckets))


def reference_distribution(df: DataFrame, feature: Monitored = DISTANCE,
                           settings: DriftSettings = DriftSettings()) -> DataFrame:
    """Edges, smoothed shares and sample size of a training table, in one row; no row without samples.

    Values that are null or not a number are no samples.
    """
    df = df.filter(~F.isnan(feature.column))
    counts = [F.col(name) for name in feature.names]
    counted = bucket_table(df, feature).withColumn("sample_count", sum(counts[1:], counts[0]))
    return counted.filter("sample_count > 0").select(
        F.array(*[F.lit(edge) for edge in feature.edges]).alias("buckets"),
        F.array(*smoothed_shares(counts, settings.smoothing)).alias("fractions"),
        "sample_count",
    )


def with_reference(feature: Monitored, reference: DataFrame | None) -> Monitored:
    """The feature with exported shares where there are any, else with its built-in ones.

    Only this single row of about a dozen numbers comes to the driver.
    """
    row = reference.first() if reference is not None else None
    if row is None:
        return feature
    return Monitored(feature.column, tuple(row.buckets), tuple(row.fractions))


def with_drift_index(df: DataFrame, counters: Sequence[str], feature: Monitored, settings: DriftSettings,
                     rows: str, psi: str) -> DataFrame:
    """Add the row count and the stability index of counter columns, shares floored on both sides.

    Arrays keep the plan small: spelled out per bucket, each share would appear in every term again.
    No rows give a null index.
    """
    counts = [F.col(name) for name in counters]
    total = F.when(F.col(rows) > 0, F.col(rows))
    df = df.withColumn(rows, sum(counts[1:], counts[0]))
    df = df.withColumn("_shares", F.transform(F.array(*counts), lambda c: F.greatest(c / total, F.lit(settings.floor))))
    df = df.withColumn("_lifted", F.aggregate("_shares", F.lit(0.0), lambda acc, share: acc + share))
    observed = F.transform("_shares", lambda share: share / F.col("_lifted"))
    expected = floored_shares(feature.shares, feature.buckets, settings.floor)
    index = F.when(F.col(rows) > 0, stability_index(observed, expected, settings.epsilon))
    return df.withColumn(psi, index).drop("_shares", "_lifted")


def period_drift(df: DataFrame, by: Sequence[str], feature: Monitored = DISTANCE,
                 settings: DriftSettings = DriftSettings()) -> DataFrame:
    """Each period (or any other group) against the reference: one aggregate of fixed-size rows."""
    scored = with_drift_index(bucket_table(df, feature, by), feature.names, feature, settings, "rows", "psi")
    return scored.filter("rows > 0").select(
        *by, F.lit(feature.column).alias("feature"), "rows", "psi", severity(F.col("psi"), settings).alias("severity"))


def _counter_names(feature: Monitored) -> list[str]:
    return [f"{feature.column}_{i}" for i in range(feature.buckets)]


def _evaluated(windows: DataFrame, features: Sequence[Monitored], settings: DriftSettings,
               keep: Sequence[str]) -> DataFrame:
    """One result row per window and feature, from the counter columns of all features at once."""
    results = []
    for feature in features:
        rows, psi = f"_rows_{feature.column}", f"_psi_{feature.column}"
        windows = with_drift_index(windows, _counter_names(feature), feature, settings, rows, psi)
        results.append(F.struct(F.lit(feature.column).alias("feature"), F.col(rows).alias("window_rows"),
                                F.col(psi).alias("psi")))
    flat = windows.select(*keep, F.inline(F.array(*results))).filter(F.col("window_rows") >= settings.min_rows)
    return flat.withColumn("severity", severity(F.col("psi"), settings))


def positioned_buckets(df: DataFrame, features: Sequence[Monitored], order: Sequence[str],
                       keep: Sequence[str] = ()) -> DataFrame:
    """Row positions with each feature reduced to its bucket number: a few bytes per row."""
    buckets = [bucket_index(F.col(f.column), f.edges).cast("tinyint").alias(f"_bucket_{f.column}") for f in features]
    needed = list(dict.fromkeys([*order, *keep]))
    return with_row_index(df.select(*needed, *buckets), order).drop(*[c for c in order if c not in keep])


def rolling_drift(df: DataFrame, order: Sequence[str], features: Sequence[Monitored] = (DISTANCE, DURATION),
                  settings: DriftSettings = DriftSettings()) -> DataFrame:
    """Every ``every``-th row, the last ``window_rows`` rows against the reference.

    Window length and evaluation step share the step as a divisor, so rows are first counted into
    blocks of one step; only block counts enter the window. Values must not be null.
    """
    return windows_of_positions(positioned_buckets(df, features, order), features, settings)


def windows_of_positions(placed: DataFrame, features: Sequence[Monitored], settings: DriftSettings) -> DataFrame:
    """Rolling drift of rows that already have gapless positions and bucket numbers."""
    if settings.window_rows % settings.every or settings.min_rows % settings.every:
        raise ValueError("window_rows and min_rows must be multiples of every")
    block = F.call_function("div", F.col("row_index") - 1, F.lit(settings.every)) + 1
    counted = [
        count.alias(name) for f in features
        for count, name in zip(bucket_counts(F.col(f"_bucket_{f.column}"), f.buckets), _counter_names(f))
    ]
    blocks = placed.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("_rows"), *counted)
    counters = [name for f in features for name in _counter_names(f)]
    windows = trailing_counts(blocks, "block", counters, settings.window_rows // settings.every)
    ends = windows.filter(F.col("_rows") == settings.every).withColumn("row_index", F.col("block") * settings.every)
    return _evaluated(ends, features, settings, ["row_index"])


def batch_drift(df: DataFrame, order: Sequence[str], batch: str,
                features: Sequence[Monitored] = (DISTANCE, DURATION),
                settings: DriftSettings = DriftSettings()) -> DataFrame:
    """After each batch, the last ``window_rows`` rows against the reference. Batches follow ``order``."""
    placed = positioned_buckets(df, features, order, keep=[batch])
    ones = [
        (F.col(f"_bucket_{f.column}") == i).cast("bigint").alias(name)
        for f in features for i, name in enumerate(_counter_names(f))
    ]
    counters = [name for f in features for name in _counter_names(f)]
    windows = trailing_counts(placed.select(batch, "row_index", *ones), "row_index", counters,
                              settings.window_rows, following=[batch, "row_index"])
    is_last = F.col("next_row_index").isNull() | ~F.col(batch).eqNullSafe(F.col(f"next_{batch}"))
    return _evaluated(windows.filter(is_last), features, settings, [batch, "row_index"])


def drift_alerts(scored: DataFrame) -> DataFrame:
    """Alert totals by feature and severity."""
    return (scored.filter(F.col("severity") != "NONE").groupBy("feature", "severity")
            .agg(F.count(F.lit(1)).alias("alerts")))
