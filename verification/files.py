from datetime import date

from pyspark.sql import functions as F

from meterflow import fixtures as fx
from meterflow.session import scratch_path
from meterflow.sources import manifest as mf
from meterflow.sources import planning as pl
from meterflow.sources import zones as zn
from verification import query
from verification.tables import TRIPS_HIST, TRIPS_RAW

_LANDING = """landing AS (SELECT dataset, year(pickup_datetime) AS y, month(pickup_datetime) AS m,
 dataset || '_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS filename FROM trips_hist GROUP BY ALL)"""


def landing(spark, sf_dir):
    """Monthly file names as the history would have landed."""
    trips = fx.trips_hist(spark, sf_dir)
    months = trips.select("dataset", F.trunc("pickup_datetime", "month").alias("month_start")).distinct()
    return months.select("dataset", zn.monthly_name(F.col("dataset"), F.col("month_start")).alias("filename"),
                         F.year("month_start").alias("y"), F.month("month_start").alias("m"))


# (stage, status, offset within the month's marks, condition); the same text serves both engines
_MARKS = (
    ("ingestion", "DOWNLOADED", 1, "(y * 12 + m) % 7 <> 0"),
    ("ingestion", "PROCESSED", 2, "m % 5 <> 0"),
    ("ingestion", "FAILED", 3, "m % 5 = 0"),
    ("ingestion", "PROCESSED", 4, "m % 2 = 0"),
    ("ingestion", "DOWNLOADED", 5, "m % 3 = 0"),
    ("ingestion", "FAILED", 6, "m = 10"),
    ("ingestion", "PROCESSED", 7, "m >= 10"),
    ("processed", "PROCESSED", 3, "m % 5 <> 0 AND y < 2001"),
    ("processed", "PROCESSED", 4, "m % 5 <> 0 AND m % 2 = 0"),
    ("features", "FEATURES_GENERATED", 8, "m % 4 <> 0"),
)
_EVENTS = "events_log AS (" + " UNION ALL ".join(
    f"""SELECT '{stage}' AS stage, dataset, filename, '{status}' AS status,
 CAST((y * 12 + m) * 10 + {offset} AS BIGINT) AS seq FROM landing WHERE {when}""" for stage, status, offset, when in _MARKS) + ")"


def events(spark, sf_dir):
    files = landing(spark, sf_dir)
    choices = F.array_compact(F.array(*[
        F.when(F.expr(when), F.struct(F.lit(stage).alias("stage"), F.lit(status).alias("status"), F.lit(offset).alias("at")))
        for stage, status, offset, when in _MARKS]))
    return files.select("dataset", "filename", "y", "m", F.inline(choices)).select(
        "stage", "dataset", "filename", "status", ((F.col("y") * 12 + F.col("m")) * 10 + F.col("at")).cast("bigint").alias("seq"))


_STATES = f"""WITH {TRIPS_HIST}, {_LANDING}, {_EVENTS},
 once AS (SELECT *, min(seq) FILTER (status = 'DOWNLOADED') OVER (PARTITION BY stage, filename) AS first_d FROM events_log),
 counted AS (SELECT *, CASE WHEN status IS NOT DISTINCT FROM lag(status) OVER (PARTITION BY stage, filename ORDER BY seq)
  THEN 0 ELSE 1 END AS fresh FROM once WHERE status <> 'DOWNLOADED' OR seq = first_d),
 runs AS (SELECT *, sum(fresh) OVER (PARTITION BY stage, filename ORDER BY seq) AS run FROM counted),
 tail AS (SELECT *, max(run) OVER (PARTITION BY stage, filename) AS last_run FROM runs),
 states AS (SELECT stage, dataset, filename, status, CASE WHEN status = 'FAILED' THEN max(seq) ELSE min(seq) END AS seq
  FROM tail WHERE run = last_run GROUP BY stage, dataset, filename, status)"""


@query("manifest_state", f"{_STATES} SELECT stage, dataset, filename, status, seq FROM states")
def manifest_state(spark, sf_dir):
    """The record in force for each stage and file."""
    return mf.file_states(events(spark, sf_dir))


@query("manifest_lookups", f"""{_STATES} SELECT stage, status, count(*) AS files, min(filename) AS first_file FROM states GROUP BY ALL""")
def manifest_lookups(spark, sf_dir):
    """Files by stage and current status."""
    return mf.file_states(events(spark, sf_dir)).groupBy("stage", "status").agg(
        F.count(F.lit(1)).alias("files"), F.min("filename").alias("first_file"))


@query("manifest_latest", f"""WITH {TRIPS_HIST}, {_LANDING}, {_EVENTS},
 first AS (SELECT stage, dataset, filename, min(seq) AS seq FROM events_log WHERE (stage, status) IN
  (('ingestion', 'DOWNLOADED'), ('processed', 'PROCESSED'), ('features', 'FEATURES_GENERATED')) GROUP BY ALL)
 SELECT stage, dataset, arg_max(filename, (seq, filename)) AS latest_file, count(*) AS files, max(seq) AS last_seq
 FROM first GROUP BY ALL""")
def manifest_latest(spark, sf_dir):
    """The file marked last in each stage."""
    return mf.latest_files(events(spark, sf_dir))


@query("recorded_files", f"""WITH {TRIPS_HIST}, {_LANDING}, {_EVENTS} SELECT dataset, filename, min(seq) AS first_seq
 FROM events_log WHERE stage = 'ingestion' AND status = 'DOWNLOADED' GROUP BY ALL""")
def recorded_files(spark, sf_dir):
    """Files ever downloaded."""
    return mf.recorded_files(events(spark, sf_dir), "ingestion")


@query("pending_files", f"""{_STATES} SELECT filename FROM landing WHERE dataset = 'yellow' AND filename NOT IN
 (SELECT filename FROM states WHERE stage = 'processed' AND status = 'PROCESSED') ORDER BY filename""")
def pending_files(spark, sf_dir):
    """Yellow files not processed yet."""
    return pl.pending_files(landing(spark, sf_dir).select("filename"), events(spark, sf_dir), "yellow")


@query("latest_month", f"""WITH {TRIPS_HIST}, {_LANDING} SELECT strftime(max(make_date(y, m, 1)), '%Y-%m-%d') AS month_start
 FROM landing WHERE dataset = 'green' AND make_date(y, m, 1) >= DATE '1996-01-01'""")
def latest_month(spark, sf_dir):
    """Newest landed green month."""
    newest = pl.latest_month(landing(spark, sf_dir).select("filename"), "green", date(1996, 1, 1))
    return newest.select(F.col("month_start").cast("string"))


def _early_marks(df):
    """Marks up to 1998, so that months stay open."""
    return df.filter(F.col("seq") < (1998 * 12 + 4) * 10)


@query("pending_months", f"""WITH {TRIPS_HIST}, {_LANDING}, {_EVENTS},
 early AS (SELECT * FROM events_log WHERE stage = 'ingestion' AND status = 'DOWNLOADED' AND seq < (1998 * 12 + 4) * 10),
 own AS (SELECT arg_max(filename, (seq, filename)) AS f FROM (SELECT filename, min(seq) AS seq FROM early
  WHERE dataset = 'yellow' GROUP BY filename)),
 bounds AS (SELECT greatest(DATE '1996-01-01', CAST(strptime(regexp_extract(f, '_(\\d{{4}}-\\d{{2}})', 1) || '-01', '%Y-%m-%d')
  + INTERVAL 1 MONTH AS DATE)) AS a, (SELECT max(make_date(y, m, 1)) FROM landing WHERE dataset = 'yellow') AS b FROM own),
 months AS (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS d FROM bounds)
 SELECT filename, dataset, month_start FROM (SELECT 'yellow_tripdata_' || strftime(d, '%Y-%m') || '.parquet' AS filename,
  'yellow' AS dataset, strftime(d, '%Y-%m-%d') AS month_start FROM months)
 WHERE filename NOT IN (SELECT filename FROM early)""")
def pending_months(spark, sf_dir):
    """Yellow months still to ingest."""
    months = pl.pending_months(spark, landing(spark, sf_dir).select("filename"), _early_marks(events(spark, sf_dir)),
                               "yellow", date(1996, 1, 1))
    return months.withColumn("month_start", F.col("month_start").cast("string"))


@query("existing_files", f"""WITH {TRIPS_HIST}, {_LANDING} SELECT filename FROM landing
 WHERE dataset = 'green' AND y = 1999 AND m IN (1, 2, 12)""")
def existing_files(spark, sf_dir):
    """Green files of some months of a year."""
    return pl.existing_files(landing(spark, sf_dir).select("filename"), "green", 1999, [1, 2, 12])


@query("select_work", f"""{_STATES} SELECT filename FROM landing WHERE dataset = 'green' AND filename NOT IN
 (SELECT filename FROM states WHERE stage = 'processed' AND status = 'PROCESSED')""")
def select_work(spark, sf_dir):
    """Nothing new, so the pending files are the work."""
    files = landing(spark, sf_dir).select("filename")
    return pl.select_work(files.filter(F.lit(False)), files, events(spark, sf_dir), "green", force=True)


@query("rolling_history", f"""WITH {TRIPS_HIST}, {_LANDING} SELECT dataset, filename FROM
 (SELECT *, dense_rank() OVER (PARTITION BY dataset ORDER BY make_date(y, m, 1) DESC) AS r FROM landing) WHERE r <= 12""")
def rolling_history(spark, sf_dir):
    """The newest twelve months of each dataset."""
    return pl.rolling_history(landing(spark, sf_dir).select("filename")).select("dataset", "filename")


@query("rolling_history_mixed", f"""WITH {TRIPS_HIST}, {_LANDING} SELECT filename FROM landing ORDER BY filename DESC LIMIT 12""")
def rolling_history_mixed(spark, sf_dir):
    """The last twelve file names, datasets mixed."""
    return pl.rolling_history(landing(spark, sf_dir).select("filename"), mix_datasets=True).select("filename")


@query("file_names", f"""WITH {TRIPS_HIST}, {_LANDING} SELECT filename, dataset, y AS year, m AS month FROM landing
 UNION ALL SELECT 'notes' || y || m || dataset, 'yellow', -1, -1 FROM landing WHERE m = 1""")
def file_names(spark, sf_dir):
    """Dataset and month parsed from file names; other names have no month."""
    files = landing(spark, sf_dir)
    other = files.filter("m = 1").select(F.concat(F.lit("notes"), "y", "m", "dataset").alias("filename"))
    parsed = zn.with_name_parts(files.select("filename").unionByName(other))
    return parsed.select("filename", "dataset", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("year", "month")])


@query("zone_roundtrip", f"WITH {TRIPS_RAW} SELECT trip_id, trip_distance, tpep_pickup_datetime FROM trips_raw")
def zone_roundtrip(spark, sf_dir):
    """Written to a zone, replaced, and read back with a column projection."""
    root = scratch_path(spark, "zones")
    trips = fx.trips_raw(spark, sf_dir)
    zn.write_zone(trips.filter("trip_id < 0"), root, "raw", "yellow_tripdata_2024-01.parquet")
    zn.write_zone(trips, root, "raw", "yellow_tripdata_2024-01.parquet")
    return zn.read_zone(spark, root, "raw", "yellow_tripdata_2024-01.parquet",
                        ["trip_id", "trip_distance", "tpep_pickup_datetime"])


def monthly_zone(spark, sf_dir, root, zone="raw"):
    trips = fx.trips_hist(spark, sf_dir).withColumns({
        "year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    # many small months share tasks, and a big month is cut, before each month's files are written
    spread = trips.hint("rebalance", *zn.MONTH_KEYS)
    return zn.write_zone(spread, root, zone, partition_by=zn.MONTH_KEYS)


@query("partition_overwrite", f"""WITH {TRIPS_HIST} SELECT dataset, year(pickup_datetime) AS year,
 month(pickup_datetime) AS month, count(*) AS trips, round(sum(CASE WHEN dataset = 'green' AND year(pickup_datetime) = 2000
 THEN 2 * trip_distance ELSE trip_distance END), 4) AS distance FROM trips_hist GROUP BY ALL""")
def partition_overwrite(spark, sf_dir):
    """One year of one dataset replaced; the other partitions stay."""
    root = scratch_path(spark, "zones")
    monthly_zone(spark, sf_dir, root)
    table = zn.read_zone(spark, root, "raw")
    redone = (table.filter((F.col("dataset") == "green") & (F.col("year") == 2000))
              .withColumn("trip_distance", F.col("trip_distance") * 2).hint("rebalance", *zn.MONTH_KEYS))
    zn.write_zone(redone, root, "raw", partition_by=zn.MONTH_KEYS)
    return zn.read_zone(spark, root, "raw").groupBy(*zn.MONTH_KEYS).agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("trip_distance"), 4).alias("distance"))


@query("zone_listing")
def zone_listing(spark, sf_dir):
    """Files of one written partition, without hidden ones; names differ from run to run."""
    root = scratch_path(spark, "zones")
    monthly_zone(spark, sf_dir, root)
    return zn.list_zone(spark, root, "raw", "dataset=green/year=2000/month=1").select("filename", "length")


@query("history_union", f"""WITH {TRIPS_HIST} SELECT trip_id, trip_distance, total_amount,
 CASE WHEN dataset = 'green' THEN VendorID ELSE -1 END AS vendor FROM trips_hist""")
def history_union(spark, sf_dir):
    """Datasets with different columns united by name."""
    trips = fx.trips_hist(spark, sf_dir)
    green = trips.filter("dataset = 'green'").select("trip_id", "VendorID", "trip_distance", "total_amount")
    yellow = trips.filter("dataset = 'yellow'").select("total_amount", "trip_id", "trip_distance")
    whole = zn.union_by_name([green, yellow])
    return whole.select("trip_id", "trip_distance", "total_amount", F.coalesce("VendorID", F.lit(-1)).alias("vendor"))


@query("monthly_files", f"""WITH {TRIPS_HIST} SELECT dataset, count(*) AS trips, round(sum(trip_distance), 4) AS distance
 FROM trips_hist GROUP BY dataset""")
def monthly_files(spark, sf_dir):
    """Several folders with different schemas read as one table."""
    trips = fx.trips_hist(spark, sf_dir)
    root = scratch_path(spark, "zones")
    paths = [zn.write_zone(trips.filter("dataset = 'green'"), root, "raw", "green"),
             zn.write_zone(trips.filter("dataset = 'yellow'").drop("VendorID"), root, "raw", "yellow")]
    return zn.read_monthly_files(spark, paths).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("trip_distance"), 4).alias("distance"))


@query("jsonl_roundtrip", f"WITH {TRIPS_RAW} SELECT trip_id, trip_distance, PULocationID FROM trips_raw")
def jsonl_roundtrip(spark, sf_dir):
    """JSON lines written and read back."""
    path = scratch_path(spark, "jsonl")
    rows = fx.trips_raw(spark, sf_dir).select("trip_id", "trip_distance", "PULocationID")
    zn.write_jsonl(rows, path)
    return zn.read_json(spark, path, rows.schema)


@query("trip_file_cleaned", f"""WITH {TRIPS_RAW} SELECT count(*) AS trips FROM trips_raw
 WHERE date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) BETWEEN 60 AND 10800 AND trip_distance > 0
 AND trip_distance <= 100 AND passenger_count BETWEEN 1 AND 9 AND fare_amount > 0 AND total_amount > 0""")
def trip_file_cleaned(spark, sf_dir):
    """One trip file read, audited and cleaned."""
    path = zn.write_zone(fx.trips_raw(spark, sf_dir), scratch_path(spark, "zones"), "raw", "yellow_tripdata_2024-01.parquet")
    return zn.read_trip_file(spark, path, clean=True).agg(F.count(F.lit(1)).alias("trips"))
