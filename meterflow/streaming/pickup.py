"""Landed files, each picked up exactly once."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType


def landed_stream(spark: SparkSession, folder: str, schema: StructType, **options: str) -> DataFrame:
    """New Parquet files of a folder; what was read before is remembered by the query's checkpoint."""
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that has landed, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_files(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder whose log makes each batch visible once."""
    return drain(stream.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``work`` per batch. It may be repeated after a failure, so it must write by batch number."""
    return drain(stream.writeStream.foreachBatch(work), checkpoint)
