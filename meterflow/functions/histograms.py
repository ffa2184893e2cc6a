"""Fixed-edge histograms, bucket quantiles and the population stability index.

Two bucket conventions exist and must not be mixed: drift uses ``value < edge``, telemetry uses
``value <= bound`` and cumulative counts.
"""

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.config import DriftSettings


def bucket_index(value: Column, edges: Sequence[float]) -> Column:
    """Index of the first edge above the value; the last bucket is open; null stays null."""
    ladder = F.when(value.isNull(), F.lit(None).cast("int"))
    for index, edge in enumerate(edges):
        ladder = ladder.when(value < edge, F.lit(index))
    return ladder.otherwise(F.lit(len(edges)))


def bucket_counts(bucket: Column, buckets: int, prefix: str = "b") -> list[Column]:
    return [F.count_if(bucket == i).alias(f"{prefix}{i}") for i in range(buckets)]


def smoothed_shares(counts: Sequence[Column], alpha: float) -> list[Column]:
    total = reduce(add, counts) + F.lit(alpha * len(counts))
    return [(count + F.lit(alpha)) / total for count in counts]


def floored_shares(shares: Sequence[float], buckets: int, floor: float) -> list[float]:
    """Pad a reference to the bucket count, lift each share to the floor and make them sum to 1."""
    padded = [*shares, *[floor] * max(0, buckets - len(shares))]
    lifted = [max(share, floor) for share in padded]
    total = math.fsum(lifted)
    return [share / total for share in lifted][:buckets]


def stability_index(observed: Column, expected: Sequence[float], epsilon: float) -> Column:
    """Sum of (o - e) * ln(o / e) over an array of shares, both sides clamped from below.

    Buckets that only one side has are ignored.
    """
    wanted = F.array(*[F.lit(max(share, epsilon)) for share in expected])
    seen = F.transform(observed, lambda share: F.greatest(share, F.lit(epsilon)))
    # the shorter side is padded with nulls, whose terms count nothing
    terms = F.zip_with(seen, wanted, lambda o, e: (o - e) * F.ln(o / e))
    return F.aggregate(terms, F.lit(0.0), lambda acc, term: acc + F.coalesce(term, F.lit(0.0)))


def severity(psi: Column, settings: DriftSettings) -> Column:
    return (F.when(psi >= settings.high, "HIGH").when(psi >= settings.medium, "MEDIUM")
            .otherwise("NONE"))


def bound_index(value: Column, bounds: Sequence[float]) -> Column:
    """Index of the first bound at or above the value; the index after the last is +Inf."""
    ladder = F.when(value.isNull(), F.lit(None).cast("int"))
    for index, bound in enumerate(bounds):
        ladder = ladder.when(value <= bound, F.lit(index))
    return ladder.otherwise(F.lit(len(bounds)))


def running_totals(counts: Sequence[Column]) -> list[Column]:
    return [reduce(add, counts[: i + 1]) for i in range(len(counts))]


def bucket_quantile(q: float, counts: Sequence[Column], bounds: Sequence[float]) -> Column:
    """Quantile interpolated inside its bucket; the +Inf bucket answers with the last finite bound."""
    cumulative = running_totals(counts)
    rank = cumulative[-1] * F.lit(q)
    ladder = F.when(cumulative[-1] == 0, F.lit(None).cast("double"))
    for i, bound in enumerate(bounds):
        low = bounds[i - 1] if i else 0.0
        below = cumulative[i - 1] if i else F.lit(0)
        inside = F.lit(low) + F.lit(bound - low) * F.try_divide(rank - below, counts[i])
        ladder = ladder.when(cumulative[i] >= rank, inside)
    return ladder.otherwise(F.lit(float(bounds[-1])))
