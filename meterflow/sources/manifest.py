"""What happened to each file: an append-only event table, and current states derived from it.

A stage is ``ingestion``, ``processed`` or ``features``. Marks are ordered by ``seq`` within a file.
"""

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from meterflow.sources.zones import zone_path

# --- Fixed values: stages, statuses and the event layout --------------------------------------
DOWNLOADED, PROCESSED, FAILED, GENERATED = "DOWNLOADED", "PROCESSED", "FAILED", "FEATURES_GENERATED"
STAGE_SUCCESS = {"ingestion": DOWNLOADED, "processed": PROCESSED, "features": GENERATED}
KEYS = ("stage", "dataset", "filename")
REPORT_TYPE = (
    "struct<initial_rows: bigint, cleaned_rows: bigint, dropped_rows: bigint, loss_percentage: double, "
    "dropped_details: struct<invalid_timestamps: bigint, invalid_duration: bigint, invalid_distance: bigint, "
    "invalid_passengers: bigint, invalid_monetary: bigint>>"
)
DETAIL_TYPES = {
    "path": "string", "error": "string", "row_count": "bigint", "feature_count": "int", "report": REPORT_TYPE,
}


def marks(files: DataFrame, stage: str | Column, status: str | Column, **details: Column) -> DataFrame:
    """Events for a table of ``dataset`` and ``filename``, stamped with the current time."""
    values = {name: details.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in DETAIL_TYPES.items()}
    stage, status = (F.lit(v) if isinstance(v, str) else v for v in (stage, status))
    return files.select(
        stage.alias("stage"), "dataset", "filename", status.alias("status"),
        F.lit(time.time_ns() // 1000).alias("seq"), F.current_timestamp().cast("timestamp_ntz").alias("marked_at"),
        *values.values())


def append_marks(events: DataFrame, root: str) -> None:
    events.write.mode("append").parquet(zone_path(root, "metadata", "manifest"))


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """All events so far; an empty table before the first mark."""
    try:
        return spark.read.parquet(zone_path(root, "metadata", "manifest"))
    except AnalysisException:
        details = ", ".join(f"{name} {kind}" for name, kind in DETAIL_TYPES.items())
        return spark.createDataFrame(
            [], f"stage string, dataset string, filename string, status string, seq bigint, marked_at timestamp_ntz, {details}")


def file_states(events: DataFrame) -> DataFrame:
    """The record in force for each stage and file.

    Repeating a success keeps its first record; a failure always replaces; a success after something
    else replaces; a download counts only once per file, whatever came between. Two aggregates with
    partial sums find it, so a file with very many events is no hot window.
    """
    def at(status: str, pick) -> Column:
        return pick(F.when(F.col("status") == status, F.col("seq")))

    ends = events.groupBy(*KEYS).agg(
        at(DOWNLOADED, F.min).alias(DOWNLOADED), at(PROCESSED, F.max).alias(PROCESSED),
        at(FAILED, F.max).alias(FAILED), at(GENERATED, F.max).alias(GENERATED))
    statuses = (DOWNLOADED, PROCESSED, FAILED, GENERATED)
    ends = ends.withColumn("_last", F.greatest(*statuses))
    ends = ends.withColumn("_status", F.coalesce(*[F.when(F.col(s) == F.col("_last"), s) for s in statuses]))
    others = F.greatest(*[F.when(F.col("_status") != s, F.col(s)) for s in statuses])
    after = F.when(F.col("_status") == FAILED, F.col("_last") - 1).otherwise(F.coalesce(others, F.lit(-1)))
    after = F.when(F.col("_status") == DOWNLOADED, F.col("_last") - 1).otherwise(after)
    bounds = ends.select(*KEYS, "_status", after.alias("_after"))
    rest = [c for c in events.columns if c not in KEYS]
    standing = events.join(bounds, list(KEYS)).filter(
        (F.col("status") == F.col("_status")) & (F.col("seq") > F.col("_after")))
    kept = standing.groupBy(*KEYS).agg(F.min_by(F.struct(*rest), F.col("seq")).alias("_kept"))
    return kept.select(*KEYS, "_kept.*")


def recorded_files(events: DataFrame, stage: str) -> DataFrame:
    """Files that ever succeeded in a stage, with the time of their first success."""
    done = events.filter((F.col("stage") == stage) & (F.col("status") == STAGE_SUCCESS[stage]))
    return done.groupBy("dataset", "filename").agg(F.min("seq").alias("first_seq"))


def latest_files(events: DataFrame) -> DataFrame:
    """Per stage and dataset: the file marked last (not the greatest name), how many there are, and when.

    Only success marks are looked at, so each file counts from its first one.
    """
    success = F.create_map(*[F.lit(v) for pair in STAGE_SUCCESS.items() for v in pair])
    good = file_states(events.filter(F.col("status") == success[F.col("stage")]))
    return good.groupBy("stage", "dataset").agg(
        F.max_by("filename", F.struct("seq", "filename")).alias("latest_file"),
        F.count(F.lit(1)).alias("files"), F.max("seq").alias("last_seq"))


def is_downloaded(events: DataFrame, filename: str) -> bool:
    """Whether any dataset recorded the file as downloaded."""
    done = recorded_files(events, "ingestion").filter(F.col("filename") == filename)
    return not done.isEmpty()


def file_status(events: DataFrame, filename: str, dataset: str = "yellow", stage: str = "ingestion") -> str | None:
    own = events.filter((F.col("stage") == stage) & (F.col("dataset") == dataset) & (F.col("filename") == filename))
    row = file_states(own).select("status").first()
    return row.status if row else None


def is_processed(events: DataFrame, filename: str, dataset: str = "yellow") -> bool:
    return file_status(events, filename, dataset, "processed") == PROCESSED


def has_features(events: DataFrame, filename: str, dataset: str = "yellow") -> bool:
    return file_status(events, filename, dataset, "features") == GENERATED


def with_status(events: DataFrame, stage: str, status: str) -> DataFrame:
    """Files whose record in force in a stage has a status."""
    return file_states(events.filter(F.col("stage") == stage)).filter(F.col("status") == status).drop("stage")
