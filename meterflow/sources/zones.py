"""Storage zones under one base folder of any Hadoop file system, and the files in them."""

import re
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.config import CleaningLimits
from meterflow.errors import DataValidationError
from meterflow.operators.cleaning import check_loss, clean_trips, cleaning_report
from meterflow.operators.validation import validate_trips
from meterflow.session import broadcast_if_small

# --- Fixed values: zone names and the file name pattern ---------------------------------------
ZONES = ("raw", "processed", "features", "models", "metadata", "tmp")
NAME_PATTERN = r"_(\d{4})-(\d{2})\.parquet$"
DEFAULT_DATASET = "yellow"
MONTH_KEYS = ("dataset", "year", "month")
_VERSION = "v-[0-9]+-[0-9a-f]+"
_POINTER_TYPE = "zone string, name string, version string, seq bigint"


def zone_path(root: str, zone: str, name: str = "") -> str:
    if zone not in ZONES:
        raise DataValidationError(f"unknown zone {zone!r}, expected one of {ZONES}")
    return "/".join(part for part in (root.rstrip("/"), zone, name) if part)


def _pointers(spark: SparkSession, root: str) -> DataFrame | None:
    """Which version of each replaced table is in force: the newest row of a log that is only appended to."""
    try:
        log = spark.read.schema(_POINTER_TYPE).parquet(zone_path(root, "metadata", "versions"))
    except AnalysisException:
        return None
    return log.groupBy("zone", "name").agg(F.max_by("version", F.struct("seq", "version")).alias("version"))


def current_path(spark: SparkSession, root: str, zone: str, name: str = "") -> str:
    """The folder that a table's readers have to follow; its own path if it was never replaced through ``write_zone``."""
    pointers = _pointers(spark, root)
    own = None if pointers is None else pointers.filter((F.col("zone") == zone) & (F.col("name") == name)).first()
    return "/".join([zone_path(root, zone, name), own.version]) if own else zone_path(root, zone, name)


def read_zone(spark: SparkSession, root: str, zone: str, name: str = "",
              columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet file or table of a zone, in the version in force now, reading only the columns asked for.

    The table keeps to that version even if a later one is put in its place while it is read.
    """
    path = current_path(spark, root, zone, name)
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        raise DataValidationError(f"no readable Parquet data at {path}: {error.getCondition()}") from error
    return table.select(*columns) if columns else table


def write_zone(df: DataFrame, root: str, zone: str, name: str = "", partition_by: Sequence[str] = ()) -> str:
    """Replace a table, or only the partitions present in ``df``; returns the folder that holds the rows.

    A whole table is written as a new version beside the old one. Then one row is appended to the log of versions, as one small
    file whose commit is the moment of the swap. A write that fails leaves no row, so the old version stays in force.
    Partitions are staged by the job and put in place by its commit; months are replaced one by one.
    """
    path = zone_path(root, zone, name)
    if partition_by:
        (df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))
        return path
    version = f"v-{time.time_ns()}-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(f"{path}/{version}")
    pointer = df.sparkSession.createDataFrame([(zone, name, version, time.time_ns())], _POINTER_TYPE)
    pointer.coalesce(1).write.mode("append").parquet(zone_path(root, "metadata", "versions"))
    return f"{path}/{version}"


def drop_old_versions(spark: SparkSession, root: str, zone: str, name: str) -> int:
    """Delete the versions of a table that are not in force, unfinished ones too; returns how many.

    To be run while nobody writes the table or reads an old version of it.
    """
    path, current = zone_path(root, zone, name), current_path(spark, root, zone, name)
    if current == path:
        return 0
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [entry.getPath() for entry in files.listStatus(hadoop_path(path))
           if entry.isDirectory() and re.match(_VERSION + "$", entry.getPath().getName())
           and entry.getPath().getName() != current.rsplit("/", 1)[1]]
    return sum(files.delete(folder, True) for folder in old)


def file_table(spark: SparkSession, root: str, zone: str, name: str = "") -> DataFrame:
    """One row per data file directly in a zone; contents are not read.

    A monthly file is a single Parquet file or a folder of part files, of which a replaced one holds versions: only the files of the
    version in force are listed. Its ``filename`` is its own name, without a ``key=`` prefix left by a partitioned write.
    Hidden, temporary and nested files are left out.
    """
    path = zone_path(root, zone, name)
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException:
        return spark.createDataFrame([], "source_path string, data_path string, filename string, length bigint")
    below = re.escape("/" + re.sub(r"^[a-z0-9]+:/+[^/]*", "", path).strip("/") + "/")
    whole = rf"^(.*{below}(?:[^/=]+=)?([^/._][^/]*\.parquet)(?:/({_VERSION})(?=/))?)(?:/[^/._][^/]*)?$"
    source = F.col("_metadata.file_path")
    plain = F.url_decode(F.replace(source, F.lit("+"), F.lit("%2B")))  # the metadata encode blanks and the like
    files = found.select(
        source.alias("source_path"), F.regexp_extract(plain, whole, 1).alias("data_path"),
        F.regexp_extract(plain, whole, 2).alias("filename"), F.regexp_extract(plain, whole, 3).alias("_version"),
        "length").filter("filename <> ''")
    pointers = _pointers(spark, root)
    if pointers is None:
        return files.filter("_version = ''").drop("_version")
    prefix = f"{name}/" if name else ""
    own = pointers.filter((F.col("zone") == zone) & F.col("name").startswith(prefix)).select(
        F.substring("name", len(prefix) + 1, 1 << 20).alias("filename"), F.col("version").alias("_current"))
    chosen = files.join(broadcast_if_small(own), "filename", "left")
    return chosen.filter(F.col("_version") == F.coalesce("_current", F.lit(""))).select(
        "source_path", "data_path", "filename", "length")


def list_zone(spark: SparkSession, root: str, zone: str, name: str = "") -> DataFrame:
    """Names and sizes of the data files in a zone."""
    return file_table(spark, root, zone, name).groupBy("filename").agg(F.sum("length").alias("length"))


def name_parts(filename: Column) -> dict[str, Column]:
    """Dataset, year and month of a monthly file name; year and month are null for other names."""
    def number(group: int) -> Column:
        return F.regexp_extract(filename, NAME_PATTERN, group).try_cast("int")

    dataset = F.when(filename.contains("_"), F.split_part(filename, F.lit("_"), F.lit(1))).otherwise(DEFAULT_DATASET)
    month = F.when(number(2).between(1, 12), number(2))
    return {"dataset": dataset, "year": number(1), "month": month, "month_start": F.make_date(number(1), month, F.lit(1))}


def with_name_parts(listing: DataFrame) -> DataFrame:
    return listing.withColumns(name_parts(F.col("filename")))


def monthly_name(dataset: Column, month_start: Column) -> Column:
    return F.concat(dataset, F.lit("_tripdata_"), F.date_format(month_start, "yyyy-MM"), F.lit(".parquet"))


def read_trip_file(spark: SparkSession, path: str, clean: bool = False,
                   limits: CleaningLimits = CleaningLimits()) -> DataFrame:
    """One trip file, or one version of it, either strictly validated or cleaned and audited."""
    if not re.search(rf"\.parquet(/{_VERSION})?$", path.lower()):
        raise DataValidationError(f"expected a Parquet file: {path}")
    try:
        trips = spark.read.parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        missing = "PATH_NOT_FOUND" in str(error)
        reason = "data file does not exist" if missing else "unable to read Parquet file"
        raise DataValidationError(f"{reason}: {path}") from error
    if not clean:
        return validate_trips(trips, limits)
    check_loss(cleaning_report(trips, limits=limits), limits)
    return clean_trips(trips, limits)


def read_monthly_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Many monthly files as one table, columns matched by name, each row knowing its file's path.

    Months may disagree on a column's type. Then files are read in groups of one schema, and the union
    widens the types.
    """
    if not paths:
        raise DataValidationError("no files to read")

    def read(group: Sequence[str]) -> DataFrame:
        table = spark.read.option("mergeSchema", "true").parquet(*group)
        return table.withColumn("source_path", F.col("_metadata.file_path"))

    try:
        return read(paths)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    return union_by_name([read(group) for group in groups.values()])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames with different columns in one table; what a frame lacks is null."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_small_json(df: DataFrame, path: str) -> None:
    """A result of a few rows as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """JSON lines, or None where nothing was written yet."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.json(path)
    except AnalysisException:
        return None
