from pyspark.sql import functions as F

from meterflow import fixtures as fx
from meterflow.config import DISTANCE_EDGES, DISTANCE_SHARES, DURATION_EDGES, DURATION_SHARES, DriftSettings, PICKUP
from meterflow.functions.histograms import stability_index
from meterflow.operators.cleaning import clean_trips
from meterflow.operators.drift import (
    DISTANCE, batch_drift, bucket_table, drift_alerts, period_drift, reference_distribution, rolling_drift,
    with_reference,
)
from meterflow.operators.features import training_features
from meterflow.operators.splitting import split_by_date
from meterflow.session import scratch_path
from meterflow.sources.zones import write_small_json, zone_path
from verification import query
from verification.tables import HIST_FEATURES, RAW_CLEAN, TRIPS_RAW

_FLOOR = DriftSettings().floor


def _bucket_sql(value: str, edges) -> str:
    steps = " ".join(f"WHEN {value} < {edge} THEN {i}" for i, edge in enumerate(edges))
    return f"CASE {steps} ELSE {len(edges)} END"


def _values(shares, buckets: int) -> str:
    padded = [*shares, *[_FLOOR] * (buckets - len(shares))]
    return ", ".join(f"({i}, {share}e0)" for i, share in enumerate(padded))


def _reference_sql(name: str, edges, shares) -> str:
    return f"""{name} AS (SELECT b, greatest(s, {_FLOOR}e0) / sum(greatest(s, {_FLOOR}e0)) OVER () AS e
 FROM (VALUES {_values(shares, len(edges) + 1)}) AS t(b, s))"""


def _severity_sql(psi: str) -> str:
    return f"CASE WHEN {psi} >= 0.2 THEN 'HIGH' WHEN {psi} >= 0.1 THEN 'MEDIUM' ELSE 'NONE' END"


def _psi_sql(counts: str, keys: str, reference: str) -> str:
    """Stability index per group from rows (keys, b, c), every bucket present."""
    return f"""(SELECT {keys}, sum(c) AS window_rows, sum((o - e) * ln(o / e)) AS psi FROM (
  SELECT {keys}, b, c, greatest(c / t, {_FLOOR}e0) / sum(greatest(c / t, {_FLOOR}e0)) OVER (PARTITION BY {keys}) AS o
  FROM (SELECT *, sum(c) OVER (PARTITION BY {keys}) AS t FROM {counts})) JOIN {reference} USING (b) GROUP BY {keys})"""


DISTANCE_REF = _reference_sql("distance_ref", DISTANCE_EDGES, DISTANCE_SHARES)
DURATION_REF = _reference_sql("duration_ref", DURATION_EDGES, DURATION_SHARES)


@query("bucket_histogram", f"""{RAW_CLEAN} SELECT g.b AS bucket, count(c.trip_id) AS trips
 FROM range(11) AS g(b) LEFT JOIN cleaned c ON g.b = {_bucket_sql('c.trip_distance', DISTANCE_EDGES)} GROUP BY g.b""")
def bucket_histogram(spark, sf_dir):
    """Trips per distance bucket, empty buckets included."""
    wide = bucket_table(clean_trips(fx.trips_raw(spark, sf_dir)), DISTANCE)
    return wide.select(F.posexplode(F.array(*DISTANCE.names)).alias("bucket", "trips"))


_TRAIN_SHARES = f"""train AS (SELECT {_bucket_sql('trip_distance', DISTANCE_EDGES)} AS b FROM featured
 WHERE pickup_datetime < TIMESTAMP '2000-01-01'),
 shares AS (SELECT g.b, (count(t.b) + 1e-4) / ((SELECT count(*) FROM train) + 1e-4 * 11) AS fraction
 FROM range(11) AS g(b) LEFT JOIN train t USING (b) GROUP BY g.b)"""


def _train(spark, sf_dir):
    from datetime import datetime

    table = training_features(clean_trips(fx.trips_hist(spark, sf_dir)))
    return split_by_date(table, datetime(2000, 1, 1), datetime(2001, 1, 1))


@query("reference_distribution", f"""{HIST_FEATURES}, {_TRAIN_SHARES}
 SELECT b AS bucket, round(fraction, 9) AS fraction, (SELECT count(*) FROM train) AS sample_count FROM shares""")
def reference_distribution_query(spark, sf_dir):
    """Smoothed bucket shares of the training part."""
    reference = reference_distribution(_train(spark, sf_dir).filter("split = 'train'"))
    return reference.select(F.posexplode("fractions").alias("bucket", "fraction"), "sample_count").withColumn(
        "fraction", F.round("fraction", 9))


@query("reference_export", f"""{HIST_FEATURES}, {_TRAIN_SHARES}
 SELECT b AS bucket, round(fraction, 9) AS fraction, (SELECT count(*) FROM train) AS sample_count FROM shares""")
def reference_export(spark, sf_dir):
    """The reference written as JSON and read back by a later job."""
    from meterflow.plans.score import exported_reference

    root = scratch_path(spark, "reference")
    reference = reference_distribution(_train(spark, sf_dir).filter("split = 'train'"))
    write_small_json(reference, zone_path(root, "metadata", "reference_distribution"))
    return exported_reference(spark, root).select(
        F.posexplode("fractions").alias("bucket", "fraction"), "sample_count").withColumn("fraction", F.round("fraction", 9))


@query("period_psi", f"""{HIST_FEATURES}, {_TRAIN_SHARES},
 reference AS (SELECT b, greatest(fraction, {_FLOOR}e0) / sum(greatest(fraction, {_FLOOR}e0)) OVER () AS e FROM shares),
 seen AS (SELECT year(pickup_datetime) AS y, month(pickup_datetime) AS m, {_bucket_sql('trip_distance', DISTANCE_EDGES)} AS b
  FROM featured WHERE pickup_datetime >= TIMESTAMP '2000-01-01'),
 counts AS (SELECT p.y, p.m, g.b, count(s.b) AS c FROM (SELECT DISTINCT y, m FROM seen) p CROSS JOIN range(11) AS g(b)
  LEFT JOIN seen s ON s.y = p.y AND s.m = p.m AND s.b = g.b GROUP BY ALL)
 SELECT y AS year, m AS month, 'trip_distance' AS feature, CAST(window_rows AS BIGINT) AS rows, round(psi, 6) + 0.0e0 AS psi,
 {_severity_sql('psi')} AS severity FROM {_psi_sql('counts', 'y, m', 'reference')}""")
def period_psi(spark, sf_dir):
    """Each month after training against the exported training reference."""
    split = _train(spark, sf_dir)
    watched = with_reference(DISTANCE, reference_distribution(split.filter("split = 'train'")))
    later = split.filter("split <> 'train'").withColumns({
        "year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    scored = period_drift(later, ["year", "month"], watched)
    return scored.withColumn("psi", F.round("psi", 6) + F.lit(0.0))


_ARRIVED = f"""arrived AS (SELECT trip_id, row_number() OVER (ORDER BY tpep_pickup_datetime, trip_id) AS i,
 date_trunc('hour', tpep_pickup_datetime) AS batch,
 {_bucket_sql('trip_distance', DISTANCE_EDGES)} AS d, {_bucket_sql('(3 + 4 * trip_distance)', DURATION_EDGES)} AS t
 FROM trips_raw)"""


def _window_counts(column: str, buckets: int) -> str:
    frame = "OVER (ORDER BY i ROWS BETWEEN 499 PRECEDING AND CURRENT ROW)"
    return " UNION ALL ".join(
        f"SELECT i, batch, {b} AS b, count(*) FILTER ({column} = {b}) {frame} AS c FROM arrived" for b in range(buckets))


def _points(column: str, buckets: int, reference: str, feature: str, keep: str) -> str:
    return f"""SELECT i, '{feature}' AS feature, window_rows, psi FROM
 {_psi_sql(f"(SELECT * FROM ({_window_counts(column, buckets)}) WHERE {keep})", 'i', reference)}"""


def _drift_sql(keep: str) -> str:
    return (_points("d", 11, "distance_ref", "trip_distance", keep) + " UNION ALL "
            + _points("t", 9, "duration_ref", "predicted_duration_minutes", keep))


def arrivals(spark, sf_dir):
    trips = fx.trips_raw(spark, sf_dir)
    return trips.select(
        "trip_id", F.col(PICKUP).alias("arrived_at"), "trip_distance",
        F.date_trunc("HOUR", PICKUP).cast("timestamp_ntz").alias("batch"),
        (3 + 4 * F.col("trip_distance")).alias("predicted_duration_minutes"))


ROLLING_SQL = f"""WITH {TRIPS_RAW}, {DISTANCE_REF}, {DURATION_REF}, {_ARRIVED}, points AS ({_drift_sql('i % 10 = 0 AND i >= 100')})
 SELECT i AS row_index, feature, CAST(window_rows AS BIGINT) AS window_rows, round(psi, 6) + 0.0e0 AS psi,
 {_severity_sql('psi')} AS severity FROM points"""


@query("rolling_psi", ROLLING_SQL)
def rolling_psi(spark, sf_dir):
    """Every tenth arrival: the last 500 distances and predictions against the built-in references."""
    points = rolling_drift(arrivals(spark, sf_dir), ("arrived_at", "trip_id"))
    return points.withColumn("psi", F.round("psi", 6) + F.lit(0.0))


@query("batch_psi", f"""WITH {TRIPS_RAW}, {DISTANCE_REF}, {DURATION_REF}, {_ARRIVED},
 ends AS (SELECT batch, max(i) AS i FROM arrived GROUP BY batch),
 points AS ({_drift_sql('i >= 100 AND i IN (SELECT i FROM ends)')})
 SELECT batch, i AS row_index, feature, CAST(window_rows AS BIGINT) AS window_rows, round(psi, 6) + 0.0e0 AS psi,
 {_severity_sql('psi')} AS severity FROM points JOIN ends USING (i)""")
def batch_psi(spark, sf_dir):
    """After every hourly batch: the last 500 rows against the built-in references."""
    points = batch_drift(arrivals(spark, sf_dir), ("arrived_at", "trip_id"), "batch")
    return points.withColumn("psi", F.round("psi", 6) + F.lit(0.0))


@query("drift_alert_counts", f"""WITH {TRIPS_RAW}, {DISTANCE_REF}, {DURATION_REF}, {_ARRIVED},
 points AS ({_drift_sql('i % 10 = 0 AND i >= 100')}), rated AS (SELECT feature, {_severity_sql('psi')} AS severity FROM points)
 SELECT feature, severity, count(*) AS alerts FROM rated WHERE severity <> 'NONE' GROUP BY ALL""")
def drift_alert_counts(spark, sf_dir):
    """Alerts by feature and severity."""
    return drift_alerts(rolling_drift(arrivals(spark, sf_dir), ("arrived_at", "trip_id")))


@query("plain_psi", f"""{HIST_FEATURES}, seen AS (SELECT year(pickup_datetime) AS year,
 {_bucket_sql('trip_distance', DISTANCE_EDGES)} AS b FROM featured),
 counts AS (SELECT p.year, g.b, count(s.b) AS c FROM (SELECT DISTINCT year FROM seen) p CROSS JOIN range(11) AS g(b)
  LEFT JOIN seen s ON s.year = p.year AND s.b = g.b GROUP BY ALL),
 shares AS (SELECT year, b, greatest(c / sum(c) OVER (PARTITION BY year), 1e-4) AS o FROM counts),
 reference AS (SELECT b, greatest(s, 1e-4) AS e FROM (VALUES {_values(DISTANCE_SHARES, 11)}) AS t(b, s))
 SELECT year, round(sum((o - e) * ln(o / e)), 6) + 0.0e0 AS psi FROM shares JOIN reference USING (b) GROUP BY year""")
def plain_psi(spark, sf_dir):
    """The bare stability index, with clamping but without the common floor."""
    table = training_features(clean_trips(fx.trips_hist(spark, sf_dir))).withColumn("year", F.year("pickup_datetime"))
    counts = bucket_table(table, DISTANCE, ["year"])
    total = sum((F.col(n) for n in DISTANCE.names[1:]), F.col(DISTANCE.names[0]))
    psi = stability_index(F.array(*[F.col(n) / total for n in DISTANCE.names]), DISTANCE.shares, DriftSettings().epsilon)
    return counts.select("year", (F.round(psi, 6) + F.lit(0.0)).alias("psi"))
