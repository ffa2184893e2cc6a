"""The per-client sliding limit on a stream: the last admitted times of each client are its state."""

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterflow.operators.throttle import admit_in_order

# --- Fixed value: the state store that keeps state out of the heap ----------------------------
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# a name with a leading underscore would reach the processor renamed
_MICROS = "event_micros"


class _SlidingLimit(StatefulProcessor):
    """At most ``limit`` times per client, dropped by an event-time timer once they no longer count."""

    def __init__(self, columns: list[str], request_id: str, limit: int, window: int):
        self._columns, self._id, self._limit, self._window = columns, request_id, limit, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._recent = handle.getListState("recent", "t bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # only times and ids are put in order; the rows stay in the frames that they came in
        frames = list(rows)
        keys = pd.concat([frame[[_MICROS, self._id]] for frame in frames], ignore_index=True).sort_values([_MICROS, self._id])
        recent = deque(row[0] for row in self._recent.get())
        marks = np.zeros(len(keys), dtype=bool)
        marks[keys.index] = admit_in_order(keys[_MICROS].to_numpy(), recent, self._limit, self._window)
        self._recent.put([(t,) for t in recent])
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        if recent:
            self._handle.registerTimer((recent[-1] + self._window) // 1000 + 1)
        start = 0
        while frames:
            frame = frames.pop(0)
            yield frame[self._columns].assign(admitted=marks[start:start + len(frame)])
            start += len(frame)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._recent.clear()
        return iter([])

    def close(self) -> None:
        pass


def throttle_stream(stream: DataFrame, client: str, time: str, request_id: str, limit: int = 60,
                    window_seconds: int = 60, watermark: str = "10 minutes") -> DataFrame:
    """Add ``admitted``. A client's requests of one batch are ordered by time and id.

    Limit the batch (``maxFilesPerTrigger``) so that one client's share of it fits a task; the state
    itself never exceeds ``limit`` numbers per client. Requests later than the watermark are dropped.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    columns = stream.columns
    timed = stream.withColumn(_MICROS, F.unix_micros(F.col(time).cast("timestamp"))).withWatermark(time, watermark)
    schema = T.StructType([*stream.schema.fields, T.StructField("admitted", T.BooleanType())])
    processor = _SlidingLimit(columns, request_id, limit, window_seconds * 1_000_000)
    return timed.groupBy(client).transformWithStateInPandas(processor, schema, "Append", "EventTime")
