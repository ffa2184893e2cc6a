"""A job over many files that a few bad ones cannot stop."""

import re
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException

from meterflow.errors import DataValidationError

# --- Fixed values: how the engine words faults that lie in a file, not in the cluster ----------
_FILE_FAULTS = ("FAILED_READ_FILE", "CANNOT_MERGE", "UNABLE_TO_INFER_SCHEMA", "PARQUET_", "USER_RAISED_EXCEPTION",
                "is not a Parquet file", "ParquetFileReader", "ParquetDecodingException", "FileNotFoundException")


def file_fault(error: Exception) -> str | None:
    """What to tell about a fault of the data; None for any other error."""
    if isinstance(error, DataValidationError):
        return str(error)
    if isinstance(error, AnalysisException):
        return f"the file cannot be used: {error.getCondition()}"
    if isinstance(error, (PySparkException, Py4JJavaError)) and any(mark in str(error) for mark in _FILE_FAULTS):
        told = re.search(r"\[USER_RAISED_EXCEPTION\] (.*?)(?: SQLSTATE|\n|$)", str(error))
        return told[1].strip() if told else "the file cannot be read"
    return None


def isolate[T](names: Sequence[str], attempt: Callable[[Sequence[str]], T]) -> tuple[list[T], dict[str, str]]:
    """``attempt`` on all names at once; where it fails for its data, on both halves, down to the bad names.

    One attempt if all are sound, and about twice the logarithm of their number for each bad one. Returns what the attempts
    returned, and a reason for each bad name. ``attempt`` has to run its job to the end, and to publish all of it or nothing.
    Errors that do not lie in the data, such as a lost cluster, are raised, so sound files are never marked for them.
    """
    done, broken, left = [], {}, [list(names)] if names else []
    while left:
        group = left.pop()
        try:
            done.append(attempt(group))
        except (DataValidationError, PySparkException, Py4JJavaError) as error:
            reason = file_fault(error)
            if reason is None:
                raise
            if len(group) == 1:
                broken[group[0]] = reason
            else:
                half = len(group) // 2
                left += [group[half:], group[:half]]
    return done, broken
