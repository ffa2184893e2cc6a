from datetime import datetime

from meterflow import fixtures as fx
from meterflow.operators.champions import champion_history, current_champions
from meterflow.operators.cleaning import clean_trips
from meterflow.operators.features import training_features
from meterflow.operators.ordering import with_row_index
from meterflow.operators.splitting import (
    chronological, head_rows, seeded_subsample, split_by_date, split_by_ratio, split_sizes,
)
from verification import query
from verification.tables import HIST_FEATURES, MODEL_RUNS, RAW_FEATURES, TRIPS_HIST

_HIST_ORDER = ("pickup_datetime", "trip_id", "trip_distance", "total_amount")
_ROW = "row_number() OVER (ORDER BY pickup_datetime, trip_id, trip_distance, total_amount)"


def _history(spark, sf_dir):
    return training_features(clean_trips(fx.trips_hist(spark, sf_dir)), keep=["trip_id", "total_amount"])


@query("row_index", f"""WITH {TRIPS_HIST} SELECT trip_id, trip_distance, total_amount, {_ROW} AS row_index
 FROM trips_hist""")
def row_index(spark, sf_dir):
    """Position of every trip in the global pickup order."""
    trips = fx.trips_hist(spark, sf_dir).select(*_HIST_ORDER)
    return with_row_index(trips, _HIST_ORDER).drop("pickup_datetime")


_RATIO = f"""placed AS (SELECT *, {_ROW} AS rn, count(*) OVER () AS n FROM featured),
 parts AS (SELECT *, CASE WHEN rn <= floor(n * 0.7e0) THEN 'train'
 WHEN rn <= floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'validation' ELSE 'test' END AS split FROM placed)"""


@query("split_ratio", f"{HIST_FEATURES}, {_RATIO} SELECT trip_id, total_amount, trip_distance, split FROM parts")
def split_ratio(spark, sf_dir):
    """Chronological split by row position."""
    return split_by_ratio(_history(spark, sf_dir), order=_HIST_ORDER).select(
        "trip_id", "total_amount", "trip_distance", "split")


@query("split_ratio_counts", f"{HIST_FEATURES}, {_RATIO} SELECT split, count(*) AS rows FROM parts GROUP BY split")
def split_ratio_counts(spark, sf_dir):
    """Sizes of the ratio split."""
    return split_sizes(split_by_ratio(_history(spark, sf_dir), order=_HIST_ORDER))


@query("split_date_counts", f"""{HIST_FEATURES} SELECT CASE WHEN pickup_datetime < TIMESTAMP '2000-01-01' THEN 'train'
 WHEN pickup_datetime < TIMESTAMP '2001-01-01' THEN 'validation' ELSE 'test' END AS split, count(*) AS rows
 FROM featured GROUP BY ALL""")
def split_date_counts(spark, sf_dir):
    """Sizes of the calendar split."""
    return split_sizes(split_by_date(_history(spark, sf_dir), datetime(2000, 1, 1), datetime(2001, 1, 1)))


@query("chronological_order", f"""{RAW_FEATURES} SELECT trip_id, pickup_datetime, trip_distance FROM featured
 ORDER BY pickup_datetime, trip_id""")
def chronological_order(spark, sf_dir):
    """All features in pickup order."""
    table = training_features(clean_trips(fx.trips_raw(spark, sf_dir)), keep=["trip_id"])
    return chronological(table).select("trip_id", "pickup_datetime", "trip_distance")


@query("head_sample", f"""{RAW_FEATURES} SELECT trip_id, pickup_datetime, trip_distance FROM featured
 ORDER BY pickup_datetime, trip_id LIMIT 1000""")
def head_sample(spark, sf_dir):
    """The first thousand rows in pickup order."""
    table = training_features(clean_trips(fx.trips_raw(spark, sf_dir)), keep=["trip_id"])
    return head_rows(table, 1000).select("trip_id", "pickup_datetime", "trip_distance")


@query("subsample")
def subsample(spark, sf_dir):
    """Exactly 5000 seeded rows of the history."""
    return seeded_subsample(fx.trips_hist(spark, sf_dir), 5000, seed=42)


@query("champion_history", f"""WITH {MODEL_RUNS}, best AS (SELECT *, min(val_mae) OVER
 (PARTITION BY model ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM model_runs)
 SELECT model, version, val_mae, val_r2, before IS NULL OR val_mae <= before AS promoted FROM best""")
def champion_history_query(spark, sf_dir):
    """Runs that became champion, the lowest error winning."""
    return champion_history(fx.model_runs(spark, sf_dir))


@query("champion_history_r2", f"""WITH {MODEL_RUNS}, best AS (SELECT *, max(val_r2) OVER
 (PARTITION BY model ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM model_runs)
 SELECT model, version, val_r2, before IS NULL OR val_r2 >= before AS promoted FROM best""")
def champion_history_r2(spark, sf_dir):
    """Runs that became champion, the highest R2 winning."""
    history = champion_history(fx.model_runs(spark, sf_dir), metric="val_r2", higher_is_better=True)
    return history.select("model", "version", "val_r2", "promoted")


@query("champion_tolerance", f"""WITH RECURSIVE {MODEL_RUNS},
 numbered AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY version) AS rn FROM model_runs),
 walk AS (SELECT model, version, rn, val_mae AS champion, true AS promoted FROM numbered WHERE rn = 1
  UNION ALL SELECT n.model, n.version, n.rn,
   CASE WHEN n.val_mae <= w.champion * (1.0e0 - 0.05e0) THEN n.val_mae ELSE w.champion END,
   n.val_mae <= w.champion * (1.0e0 - 0.05e0)
  FROM walk w JOIN numbered n ON n.model = w.model AND n.rn = w.rn + 1)
 SELECT model, version, promoted FROM walk""")
def champion_tolerance(spark, sf_dir):
    """Champions that had to be five per cent better."""
    return champion_history(fx.model_runs(spark, sf_dir), tolerance=0.05).select("model", "version", "promoted")


# One model with a run per line of an order, ever better but for a little noise, and a small one beside it.
_STEADY = """SELECT CASE WHEN l_linenumber = 7 THEN 'few' ELSE 'steady' END AS model, l_orderkey * 10 + l_linenumber AS version,
 100 / (1 + l_orderkey / 6000.0e0) + min(l_partkey % 7) * 0.01e0 AS val_mae FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""


@query("champion_tolerance_steady", f"""WITH RECURSIVE runs AS ({_STEADY.format(lineitem="lineitem")}),
 walk AS (SELECT model, min(version) AS version, arg_min(val_mae, version) AS champion FROM runs GROUP BY model
  UNION ALL SELECT w.model, min(r.version), arg_min(r.val_mae, r.version) FROM walk w JOIN runs r
   ON r.model = w.model AND r.version > w.version AND r.val_mae <= w.champion * (1.0e0 - 0.01e0) GROUP BY w.model)
 SELECT r.model, r.version, r.val_mae, w.version IS NOT NULL AS promoted FROM runs r
  LEFT JOIN walk w ON w.model = r.model AND w.version = r.version""")
def champion_tolerance_steady(spark, sf_dir):
    """Champions that had to be one per cent better, in one long line of ever better runs."""
    runs = spark.sql(_STEADY.format(lineitem=f"parquet.`{sf_dir}/lineitem.parquet`"))
    return champion_history(runs, tolerance=0.01)


@query("current_champions", f"""WITH {MODEL_RUNS}, best AS (SELECT *, min(val_mae) OVER
 (PARTITION BY model ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM model_runs),
 won AS (SELECT * FROM best WHERE before IS NULL OR val_mae <= before)
 SELECT model, max(version) AS version, arg_max(val_mae, version) AS val_mae, arg_max(val_r2, version) AS val_r2
 FROM won GROUP BY model""")
def current_champions_query(spark, sf_dir):
    """The reigning champion of each model."""
    return current_champions(champion_history(fx.model_runs(spark, sf_dir)))
