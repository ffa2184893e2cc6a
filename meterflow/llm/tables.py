"""Reading, writing and slicing of corpus tables, shared by the operators of this package."""

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from meterflow.session import shared_folder

#: Rows handed to a Python worker at once, and bytes of text worked on at once; a longer text is a slice of its own.
ROWS_AT_ONCE = 1000
BYTES_AT_ONCE = 1 << 19


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tuned(spark: SparkSession) -> SparkSession:
    """Keep the batches of long texts that go to Python small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/corpus/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, and a lost executor costs nothing."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A sort-merge join: neither side passes through the driver, and skewed keys are split at run time."""
    return left.join(right.hint("merge"), on, how)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold about ``most`` bytes; one text is never cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8, null as empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total, dtype=np.int64)
