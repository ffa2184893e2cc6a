from dataclasses import replace
from datetime import date

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from meterflow import fixtures as fx
from meterflow.config import CATEGORICAL, CleaningLimits, ModelSettings, TARGET
from meterflow.models.encoding import choose_categories, coded_name, encoding_stages, index_name, to_log
from meterflow.models.scoring import score_requests
from meterflow.models.training import permutation_importance, predict, train_model, tree_importance
from meterflow.operators.cleaning import clean_trips
from meterflow.operators.evaluation import regression_metrics
from meterflow.operators.features import training_features
from meterflow.operators.splitting import split_by_ratio
from meterflow.plans.etl import etl_job
from meterflow.plans.train import load_history, train_job
from meterflow.session import materialise, scratch_path
from meterflow.sources import manifest as mf
from meterflow.sources.zones import monthly_name, write_zone, zone_path
from verification import query
from verification.tables import HIST_FEATURES, KEPT, TRIPS_HIST, featured, flagged

# few trees keep the check short; every row is still trained on
_SMALL = ModelSettings(trees=3, max_depth=5, subsample_rows=None)
_ORDER = ("pickup_datetime", "trip_id", "trip_distance", "total_amount")


def _split(spark, sf_dir):
    table = training_features(clean_trips(fx.trips_hist(spark, sf_dir)), keep=["trip_id", "total_amount"])
    return materialise(split_by_ratio(table, order=_ORDER), "split")


def _trained(spark, sf_dir, settings):
    split = _split(spark, sf_dir)
    return split, train_model(split.filter("split = 'train'"), settings)


@query("category_codes", f"""{HIST_FEATURES} SELECT DISTINCT PU_DO_pair, CAST(dense_rank() OVER (ORDER BY PU_DO_pair) - 1 AS DOUBLE) AS code
 FROM featured""")
def category_codes(spark, sf_dir):
    """Ordinal code of each zone pair, in the order of its text."""
    table = training_features(clean_trips(fx.trips_hist(spark, sf_dir)))
    stages = encoding_stages(table, ["PU_DO_pair", "trip_distance"])
    coded = Pipeline(stages=stages[:-1]).fit(table).transform(table)
    return coded.select("PU_DO_pair", F.col(coded_name("PU_DO_pair")).alias("code")).distinct()


_VALUES = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, CAST({name} AS VARCHAR) AS label, trip_duration_minutes AS y FROM featured" for name in CATEGORICAL)


@query("category_kinds", f"""{HIST_FEATURES}, vals AS ({_VALUES}),
 means AS (SELECT feature, label, round(avg(ln(1 + y)), 9) AS mean FROM vals GROUP BY ALL),
 sized AS (SELECT *, count(*) OVER (PARTITION BY feature) AS size FROM means)
 SELECT feature, label, CASE WHEN size <= 255 THEN 'nominal' ELSE 'ordered' END AS kind,
 CAST(row_number() OVER (PARTITION BY feature ORDER BY CASE WHEN size <= 255 THEN 0e0 ELSE mean END, label) - 1 AS DOUBLE) AS code
 FROM sized""")
def category_kinds(spark, sf_dir):
    """Every value of every categorical feature: split as a set member, or by its code in the order of mean log minutes."""
    table = materialise(training_features(clean_trips(fx.trips_hist(spark, sf_dir))).withColumn("log_minutes", to_log(F.col(TARGET))),
                        "categories")
    categories = choose_categories(table, CATEGORICAL, ModelSettings().max_categories)
    stages = encoding_stages(table, CATEGORICAL, categories, "log_minutes")
    coded = Pipeline(stages=stages[:-1]).fit(table).transform(table)
    # codes before the values: one row per value leaves each task, not four per trip
    values = F.array(*[F.struct(
        F.lit(name).alias("feature"), F.col(name).cast("string").alias("label"),
        F.lit("nominal" if name in categories.nominal else "ordered").alias("kind"),
        F.col(index_name(name) if name in categories.nominal else coded_name(name)).alias("code")) for name in CATEGORICAL])
    return coded.select(F.inline(values)).distinct()


@query("train_forest")
def train_forest(spark, sf_dir):
    """Forest on the log target: metrics of each split part."""
    split, model = _trained(spark, sf_dir, replace(_SMALL, algorithm="forest"))
    return regression_metrics(predict(model, split), by=["split"])


@query("train_boosting")
def train_boosting(spark, sf_dir):
    """Boosted trees on the log target: metrics of each split part."""
    split, model = _trained(spark, sf_dir, _SMALL)
    return regression_metrics(predict(model, split), by=["split"])


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Importance of each feature in a forest, highest first."""
    _, model = _trained(spark, sf_dir, replace(_SMALL, algorithm="forest"))
    return tree_importance(model, spark, _SMALL.features)


@query("permutation_importance")
def permutation_importance_query(spark, sf_dir):
    """Loss of R2 when a feature is shuffled, on the first validation rows."""
    split, model = _trained(spark, sf_dir, replace(_SMALL, algorithm="forest"))
    return permutation_importance(model, split.filter("split = 'validation'"), _SMALL)


@query("batch_scoring")
def batch_scoring(spark, sf_dir):
    """Every valid request scored with a fitted model."""
    _, model = _trained(spark, sf_dir, replace(_SMALL, algorithm="forest"))
    asked = fx.trips_raw(spark, sf_dir).withColumnRenamed("tpep_pickup_datetime", "pickup_datetime")
    return score_requests(model, asked, date(2026, 1, 1), "v1", "forest")


def land(spark, sf_dir, root):
    """The history as monthly files in the raw zone."""
    trips = fx.trips_hist(spark, sf_dir)
    named = trips.withColumn("filename", monthly_name(F.col("dataset"), F.col("pickup_datetime"))).drop("dataset")
    write_zone(named.hint("rebalance", "filename"), root, "raw", partition_by=["filename"])


_LIMITS = CleaningLimits(max_loss_pct=20.0)


def run_etl(spark, sf_dir):
    root = scratch_path(spark, "etl")
    land(spark, sf_dir, root)
    for dataset in ("yellow", "green"):
        etl_job(spark, root, dataset, limits=_LIMITS, stop_on_failure=False)
    return root


_ETL = f"""WITH {TRIPS_HIST}, {flagged('trips_hist', 'pickup_datetime', 'dropoff_datetime')},
 named AS (SELECT *, dataset || '_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS filename FROM flagged),
 report AS (SELECT dataset, filename, count(*) AS initial_rows, count(*) FILTER ({KEPT}) AS cleaned_rows FROM named GROUP BY ALL),
 good AS (SELECT * FROM report WHERE (initial_rows - cleaned_rows) * 100.0e0 / initial_rows <= 20),
 cleaned AS (SELECT * FROM named WHERE {KEPT} AND filename IN (SELECT filename FROM good)),
 {featured('pickup_datetime')}"""


@query("etl_states", f"""{_ETL} SELECT dataset, filename, 'PROCESSED' AS status, initial_rows, cleaned_rows FROM good
 UNION ALL SELECT dataset, filename, 'FAILED', -1, -1 FROM report WHERE filename NOT IN (SELECT filename FROM good)""")
def etl_states(spark, sf_dir):
    """Landed months through ingestion, audit and cleaning: the state of every file."""
    states = mf.file_states(mf.read_events(spark, run_etl(spark, sf_dir))).filter("stage = 'ingestion'")
    return states.select("dataset", "filename", "status",
                         F.coalesce("report.initial_rows", F.lit(-1)).alias("initial_rows"),
                         F.coalesce("report.cleaned_rows", F.lit(-1)).alias("cleaned_rows"))


# months whose files are damaged before the run, and how
_GARBLED, _NARROW, _KEYLESS = ("1995-03", "1997-08"), ("1996-05",), ("1994-07", "1996-11")


def run_damaged_etl(spark, sf_dir):
    root = scratch_path(spark, "etl")
    month = F.date_format("pickup_datetime", "yyyy-MM")
    trips = fx.trips_hist(spark, sf_dir).withColumn("filename", monthly_name(F.col("dataset"), F.col("pickup_datetime")))
    trips = materialise(trips.withColumn(
        "VendorID", F.when(month.isin(*_KEYLESS) & (F.col("trip_id") % 3 == 0), None).otherwise(F.col("VendorID"))), "landed")
    sound = trips.filter(~month.isin(*_GARBLED, *_NARROW)).drop("dataset")
    write_zone(sound.hint("rebalance", "filename"), root, "raw", partition_by=["filename"])
    narrow = trips.filter(month.isin(*_NARROW)).drop("dataset", "trip_distance")
    narrow.write.mode("append").partitionBy("filename").parquet(zone_path(root, "raw"))
    for row in trips.filter(month.isin(*_GARBLED)).select("filename").distinct().collect():  # a few names
        text = trips.filter(F.col("filename") == row.filename).select(F.to_json(F.struct("*")))
        text.write.text(f"{zone_path(root, 'raw')}/{row.filename}")
    for dataset in ("yellow", "green"):
        etl_job(spark, root, dataset, limits=CleaningLimits(max_loss_pct=100.0), stop_on_failure=False)
    return root


def _months(names):
    return ", ".join(f"'{name}'" for name in names)


@query("etl_bad_files", f"""WITH {TRIPS_HIST}, {flagged('trips_hist', 'pickup_datetime', 'dropoff_datetime')},
 named AS (SELECT *, strftime(pickup_datetime, '%Y-%m') AS m FROM flagged),
 files AS (SELECT dataset, m, dataset || '_tripdata_' || m || '.parquet' AS filename, count(*) FILTER ({KEPT}) AS kept,
  count(*) FILTER ({KEPT} AND trip_id % 3 = 0 AND m IN ({_months(_KEYLESS)})) AS keyless FROM named GROUP BY ALL),
 told AS (SELECT *, CASE WHEN m IN ({_months(_GARBLED)}) THEN 'the file cannot be read'
  WHEN m IN ({_months(_NARROW)}) THEN 'a required column is 100.00% missing, more than 50.0%'
  WHEN keyless > 0 THEN keyless || ' clean trips lack a vendor or zone' ELSE '' END AS message FROM files)
 SELECT dataset, filename, CASE WHEN message = '' THEN 'PROCESSED' ELSE 'FAILED' END AS status, message,
 CASE WHEN message = '' THEN kept ELSE 0 END AS published FROM told""")
def etl_bad_files(spark, sf_dir):
    """Files that are no Parquet, lack a column or lack vendors fail with a reason each; the other months are published."""
    root = run_damaged_etl(spark, sf_dir)
    states = mf.file_states(mf.read_events(spark, root)).filter("stage = 'ingestion'")
    name = F.format_string("%s_tripdata_%04d-%02d.parquet", "dataset", "year", "month")
    rows = spark.read.parquet(zone_path(root, "processed")).groupBy("dataset", "year", "month").agg(F.count(F.lit(1)).alias("published"))
    return states.join(rows.select(name.alias("filename"), "published"), "filename", "left").select(
        "dataset", "filename", "status", F.coalesce("error", F.lit("")).alias("message"),
        F.coalesce("published", F.lit(0)).cast("bigint").alias("published"))


@query("etl_features", f"""{_ETL} SELECT CASE WHEN trip_id IS NULL THEN '' ELSE 'features' END AS zone, count(*) AS rows,
 round(sum(trip_duration_minutes), 3) AS minutes, count(DISTINCT PU_DO_pair) AS pairs FROM featured GROUP BY ALL""")
def etl_features(spark, sf_dir):
    """What the pipeline published as features."""
    table = spark.read.parquet(zone_path(run_etl(spark, sf_dir), "features"))
    return table.agg(F.lit("features").alias("zone"), F.count(F.lit(1)).alias("rows"),
                     F.round(F.sum("trip_duration_minutes"), 3).alias("minutes"),
                     F.count_distinct("PU_DO_pair").alias("pairs"))


@query("history_months", f"""{_ETL}, months AS (SELECT DISTINCT dataset, month FROM (SELECT f.*, g.dataset,
  date_trunc('month', f.pickup_datetime) AS month FROM featured f JOIN cleaned g USING (trip_id))),
 newest AS (SELECT dataset, month, dense_rank() OVER (PARTITION BY dataset ORDER BY month DESC) AS r FROM months),
 rows AS (SELECT g.dataset, date_trunc('month', f.pickup_datetime) AS month, f.trip_duration_minutes AS y
  FROM featured f JOIN cleaned g USING (trip_id))
 SELECT strftime(month, '%Y-%m') AS month, count(*) AS rows, round(sum(y), 3) AS minutes
 FROM rows JOIN (SELECT * FROM newest WHERE r <= 12) USING (dataset, month) GROUP BY ALL""")
def history_months(spark, sf_dir):
    """Rolling history of published features, chosen from the manifest."""
    table = load_history(spark, run_etl(spark, sf_dir))
    return table.groupBy(F.date_format("pickup_datetime", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("trip_duration_minutes"), 3).alias("minutes"))


@query("train_run")
def train_run(spark, sf_dir):
    """Pipeline from landed files to a recorded model: the run record."""
    from meterflow.models.registry import judged_runs, read_runs

    root = run_etl(spark, sf_dir)
    train_job(spark, root, replace(_SMALL, trees=2), gated=False)
    runs = judged_runs(read_runs(spark, root))
    return runs.select("model", "version", "algorithm", "val_mae", "promoted", F.map_keys("metrics").alias("metric_names"))
