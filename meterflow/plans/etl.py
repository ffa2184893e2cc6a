"""From landed monthly files to cleaned trips and features, all files of a run in one pass each."""

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterflow.config import CleaningLimits, FEATURES, PICKUP, RAW_REQUIRED
from meterflow.errors import DataValidationError
from meterflow.operators.cleaning import audit_message, clean_trips, cleaning_report
from meterflow.operators.features import training_features
from meterflow.operators.validation import validate_target
from meterflow.functions.parsing import is_missing, with_canonical_times
from meterflow.session import broadcast_if_small, materialise, prepare
from meterflow.sources import manifest as mf
from meterflow.sources.isolation import isolate
from meterflow.sources.planning import select_work
from meterflow.sources.zones import (
    MONTH_KEYS, NAME_PATTERN, file_table, list_zone, read_monthly_files, union_by_name, with_name_parts, write_zone, zone_path,
)


@dataclass(frozen=True)
class EtlResult:
    processed: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)


def ingest(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Mark raw files that no run has seen yet; returns them."""
    names = list_zone(spark, root, "raw").select("filename")
    own = names.filter(F.col("filename").startswith(f"{dataset}_tripdata_"))
    seen = mf.recorded_files(mf.read_events(spark, root), "ingestion").select("filename")
    fresh = materialise(own.join(seen, "filename", "left_anti").withColumn("dataset", F.lit(dataset)), "fresh")
    if not fresh.isEmpty():
        mf.append_marks(mf.marks(fresh, "ingestion", mf.DOWNLOADED), root)
    return fresh


def raw_trips(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Raw rows of some files, with their file name and month, and an id for rows that have none.

    Names are parsed once per file and joined to the rows, not parsed for each row.
    """
    paths = [row.data_path for row in files.select("data_path").distinct().collect()]  # one per monthly file
    trips = read_monthly_files(spark, paths)
    named = with_name_parts(files.select("source_path", "filename")).drop("month_start")
    trips = trips.join(broadcast_if_small(named), "source_path").drop("source_path")
    if "trip_id" not in trips.columns:
        trips = with_canonical_times(trips)
        known = [c for c in RAW_REQUIRED if c in trips.columns]
        trips = trips.withColumn("trip_id", F.xxhash64("filename", *known))
    return trips


def clean_files(spark: SparkSession, root: str, work: DataFrame, limits: CleaningLimits = CleaningLimits()) -> EtlResult:
    """Audit and clean files: one narrow scan for the reports, one for the rows of files that pass.

    A file that is gone, cannot be read, lacks columns, fails its audit or has trips without vendor or zone is marked with
    the reason, and the others are published. Each scan is one job over all files unless one of them breaks it.
    """
    files = materialise(file_table(spark, root, "raw").join(work.select("filename"), "filename", "left_semi"), "work")
    found = sorted(row.filename for row in files.select("filename").distinct().collect())  # one per monthly file
    gone = work.select("filename").distinct().join(files.select("filename"), "filename", "left_anti")
    reasons = {row.filename: "the file is gone" for row in gone.collect()}

    def of(names: Sequence[str]) -> DataFrame:
        return files.filter(F.col("filename").isin(list(names)))

    def footers(names: Sequence[str]) -> list[str]:
        raw_trips(spark, of(names))
        return list(names)

    def report_of(names: Sequence[str]) -> DataFrame:
        return materialise(cleaning_report(raw_trips(spark, of(names)), ["filename"], limits, keys=True), "reports")

    def publish(names: Sequence[str]) -> list[str]:
        kept = clean_trips(raw_trips(spark, of(names)), limits).drop("filename")
        # months of any size become well-sized files: small ones share a task, big ones are cut
        write_zone(kept.hint("rebalance", *MONTH_KEYS).sortWithinPartitions(*MONTH_KEYS, PICKUP), root, "processed",
                   partition_by=MONTH_KEYS)
        return list(names)

    # footers are cheap: files that cannot be opened are found before any row is read
    readable, broken = isolate(found, footers)
    reports, unread = isolate([name for group in readable for name in group], report_of)
    reasons |= broken | unread
    passed = []
    if reports:
        # a file without rows has no group of its own
        every = of([name for name in found if name not in reasons]).select("filename").distinct()
        every = every.join(union_by_name(reports), "filename", "left").fillna(
            0, ["initial_rows", "cleaned_rows", "dropped_rows", "loss_percentage", "max_null_pct", "keyless_rows"]).fillna(
            True, ["over_limit"])
        message = F.when(F.col("over_limit"), audit_message(limits)).when(
            F.col("keyless_rows") > 0, F.format_string("%d clean trips lack a vendor or zone", "keyless_rows"))
        report = materialise(with_name_parts(every).withColumn("message", message), "report")
        verdicts = {row.filename: row.message for row in report.select("filename", "message").collect()}
        reasons |= {name: message for name, message in verdicts.items() if message is not None}
        published, unwritten = isolate(sorted(set(verdicts) - set(reasons)), publish)
        reasons |= unwritten
        passed = sorted(name for group in published for name in group)
    if passed:
        good = report.filter(F.col("filename").isin(passed))
        audit = F.struct("initial_rows", "cleaned_rows", "dropped_rows", "loss_percentage", "dropped_details")
        where = F.lit(zone_path(root, "processed"))
        marks = mf.marks(good, "ingestion", mf.PROCESSED, report=audit).unionByName(
            mf.marks(good, "processed", mf.PROCESSED, report=audit, path=where, row_count=F.col("cleaned_rows")))
        mf.append_marks(marks, root)
    _mark_failed(spark, root, "ingestion", reasons)
    return EtlResult(passed, sorted(reasons))


def _mark_failed(spark: SparkSession, root: str, stage: str, reasons: dict[str, str]) -> None:
    if reasons:
        bad = with_name_parts(spark.createDataFrame(sorted(reasons.items()), "filename string, message string"))
        mf.append_marks(mf.marks(bad, stage, mf.FAILED, error=F.col("message")), root)


def _months_of(spark: SparkSession, root: str, zone: str, filenames: Sequence[str]) -> DataFrame:
    """The partitions of a zone that stand for some monthly files; a static filter, so others are not listed."""
    table = spark.read.parquet(zone_path(root, zone))
    names = F.format_string("%s_tripdata_%04d-%02d.parquet", "dataset", "year", "month")
    return table.filter(names.isin(list(filenames)))


def _month_is(filename: str) -> Column:
    year, month = map(int, re.search(NAME_PATTERN, filename).groups())
    return (F.col("dataset") == filename.split("_")[0]) & (F.col("year") == year) & (F.col("month") == month)


def _complete(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows as they are; the first one with a missing feature ends the job, before its commit publishes anything."""
    gap = F.concat_ws(", ", *[F.when(is_missing(df, name), F.lit(name)) for name in names])
    told = F.concat(F.format_string("%s_tripdata_%04d-%02d.parquet", *MONTH_KEYS), F.lit(" lacks "), gap)
    return df.withColumn(names[0], F.when(gap != "", F.raise_error(told).cast(df.schema[names[0]].dataType)).otherwise(F.col(names[0])))


def feature_files(spark: SparkSession, root: str, filenames: Sequence[str],
                  limits: CleaningLimits = CleaningLimits()) -> EtlResult:
    """Features of processed files, published by month.

    One scan derives, checks, counts and writes: a gap fails the write, whose commit alone shows a month in the zone. A month with gaps, or
    without any usable trip, is marked with the reason and what the zone held of it before stays; the others are published.
    """
    def publish(names: Sequence[str]) -> list[str]:
        processed = _months_of(spark, root, "processed", names)
        validate_target(processed, limits)
        table = training_features(processed, keep=["trip_id", *MONTH_KEYS], limits=limits)
        whole = _complete(table, [name for name in FEATURES if name in table.columns])
        usable = Observation()
        placed = whole.hint("rebalance", *MONTH_KEYS).sortWithinPartitions(*MONTH_KEYS, "pickup_datetime")
        # counted on top: below the exchange an adaptive plan without rows would drop the counters
        counted = placed.observe(usable, *[F.count_if(_month_is(name)).alias(f"n{at}") for at, name in enumerate(names)])
        write_zone(counted, root, "features", partition_by=MONTH_KEYS)
        return [name for at, name in enumerate(names) if usable.get[f"n{at}"]]

    done, reasons = isolate(sorted(filenames), publish)
    published = [name for group in done for name in group]
    reasons |= {name: "no trip is usable for features" for name in set(filenames) - set(published) - set(reasons)}
    if published:
        written = _months_of(spark, root, "features", published)
        width = sum(name in written.columns for name in FEATURES)
        # partition columns only: rows are counted from the footers, and named once per month
        counts = written.groupBy(*MONTH_KEYS).agg(F.count(F.lit(1)).alias("row_count"))
        named = counts.withColumn("filename", F.format_string("%s_tripdata_%04d-%02d.parquet", *MONTH_KEYS))
        counts = materialise(named.drop("year", "month"), "feature-counts")
        mf.append_marks(mf.marks(counts, "features", mf.GENERATED, path=F.lit(zone_path(root, "features")),
                                 row_count=F.col("row_count"), feature_count=F.lit(width)), root)
    _mark_failed(spark, root, "features", reasons)
    return EtlResult(sorted(set(filenames) - set(reasons)), sorted(reasons))


def etl_job(spark: SparkSession, root: str, dataset: str = "yellow", year: int | None = None,
            months: Sequence[int] | None = None, force: bool = False, limits: CleaningLimits = CleaningLimits(),
            stop_on_failure: bool = True, then=None) -> EtlResult:
    """Ingest, select work, clean, derive features; ``then`` (such as a training job) runs after success.

    Files that cannot be read, fail their audit or leave gaps are marked and left out; the others are published before the error.
    """
    prepare(spark)
    new = ingest(spark, root, dataset)
    listing = list_zone(spark, root, "raw").select("filename")
    work = select_work(new.select("filename"), listing, mf.read_events(spark, root), dataset, force, year, months)
    if work.isEmpty():
        return EtlResult()
    result = clean_files(spark, root, work, limits)
    if result.processed:
        featured = feature_files(spark, root, result.processed, limits)
        result = EtlResult(featured.processed, sorted({*result.failed, *featured.failed}))
    if result.failed and stop_on_failure:
        raise DataValidationError(f"files failed: {result.failed}")
    if then is not None:
        then()
    return result
