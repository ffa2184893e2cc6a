"""Which files and months still need work."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.errors import DataValidationError
from meterflow.sources.manifest import PROCESSED, latest_files, recorded_files, with_status
from meterflow.sources.zones import monthly_name, name_parts, with_name_parts


def pending_files(listing: DataFrame, events: DataFrame, dataset: str = "yellow") -> DataFrame:
    """Monthly raw files of a dataset that are not processed yet, by name."""
    own = listing.filter(F.col("filename").startswith(f"{dataset}_tripdata_") & F.col("filename").endswith(".parquet"))
    done = with_status(events, "processed", PROCESSED).filter(F.col("dataset") == dataset).select("filename")
    return own.join(done, "filename", "left_anti").orderBy("filename")


def latest_month(listing: DataFrame, dataset: str, start: date) -> DataFrame:
    """The newest landed month of a dataset that is not before ``start``; null when there is none."""
    months = with_name_parts(listing).filter((F.col("dataset") == dataset) & (F.col("month_start") >= F.lit(start)))
    return months.agg(F.max("month_start").alias("month_start"))


def pending_months(spark: SparkSession, listing: DataFrame, events: DataFrame, dataset: str, start: date) -> DataFrame:
    """Months to ingest, up to the newest landed one.

    They resume after the file marked *last*, even if an earlier month was skipped, but never before
    ``start``. Files any dataset recorded are left out.
    """
    last = latest_files(events).filter((F.col("stage") == "ingestion") & (F.col("dataset") == dataset))
    resume = last.agg(F.max(F.add_months(name_parts(F.col("latest_file"))["month_start"], 1)).alias("resume"))
    newest = latest_month(listing, dataset, start)
    # both sides are single aggregate rows
    begin, end = resume.first().resume, newest.first().month_start
    if end is None:
        return spark.createDataFrame([], "dataset string, month_start date, filename string")
    begin = max(start.replace(day=1), begin) if begin else start.replace(day=1)
    if begin > end:
        return spark.createDataFrame([], "dataset string, month_start date, filename string")
    months = spark.range(1).select(
        F.lit(dataset).alias("dataset"),
        F.explode(F.sequence(F.lit(begin), F.lit(end), F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    named = months.withColumn("filename", monthly_name(F.col("dataset"), F.col("month_start")))
    return named.join(recorded_files(events, "ingestion").select("filename").distinct(), "filename", "left_anti")


def existing_files(listing: DataFrame, dataset: str, year: int | None = None,
                   months: Sequence[int] | None = None) -> DataFrame:
    """Raw files of a dataset, optionally only of a year and some of its months."""
    files = with_name_parts(listing).filter((F.col("dataset") == dataset) & F.col("month_start").isNotNull())
    if year is not None:
        files = files.filter(F.col("year") == year)
    if months:
        files = files.filter(F.col("month").isin(*months))
    return files.select(*listing.columns).orderBy("filename")


def select_work(new_files: DataFrame | None, listing: DataFrame, events: DataFrame, dataset: str, force: bool = False,
                year: int | None = None, months: Sequence[int] | None = None) -> DataFrame:
    """New files, else pending ones, else (only when forced) existing ones."""
    if new_files is not None and not new_files.isEmpty():
        return new_files
    pending = pending_files(listing, events, dataset)
    if not force or not pending.isEmpty():
        return pending
    return existing_files(listing, dataset, year, months)


def rolling_history(listing: DataFrame, months: int = 12, mix_datasets: bool = False) -> DataFrame:
    """The newest months of each dataset, ranked on the file listing, never on rows of the files.

    ``mix_datasets`` ranks all file names together instead.
    """
    if months < 1:
        raise DataValidationError("history must span at least one month")
    files = with_name_parts(listing).filter(F.col("month_start").isNotNull())
    if mix_datasets:
        return files.orderBy(F.desc("filename")).limit(months)
    newest = Window.partitionBy("dataset").orderBy(F.desc("month_start"))
    return files.withColumn("_rank", F.dense_rank().over(newest)).filter(F.col("_rank") <= months).drop("_rank")
