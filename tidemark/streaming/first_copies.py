"""Keyed stream state: the first copy of every timestamp, and what came too late.

State is one value per (keys, timestamp) with an event-time timer at that timestamp: once the
watermark has passed it the value is dropped, so state holds what the watermark leaves open
and no more. Later copies of a closed timestamp are late rows and come out as such.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRICE, LATE = "price", "late"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OPEN = T.StructType([T.StructField("open", T.BooleanType())])


class FirstCopies(StatefulProcessor):
    """Passes rows with `aside` on; of the others the first of a timestamp, or all of a closed one as late.

    Copies of one batch are ordered by the columns `arrival`; an earlier batch comes first.
    """

    def __init__(self, n_keys: int, columns: Sequence[str], arrival: Sequence[str]):
        self.n_keys, self.columns, self.arrival = n_keys, tuple(columns), tuple(arrival)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", OPEN)

    def _as(self, row: Row, kind: str) -> Row:
        return Row(**{c: kind if c == "kind" else row[c] for c in self.columns})

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        micros, aside = key[self.n_keys], key[self.n_keys + 1]
        if aside is not None:
            for row in rows:
                yield self._as(row, row["kind"])
            return
        if micros // 1000 <= timerValues.getCurrentWatermarkInMs():
            for row in rows:
                yield self._as(row, LATE)
            return
        first = min(rows, key=lambda r: tuple(r[c] for c in self.arrival))
        if not self.seen.exists():
            self.seen.update((True,))
            self.handle.registerTimer(micros // 1000)
            yield self._as(first, PRICE)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:  # noqa: N802, N803
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_copies(rows: DataFrame, keys: Sequence[str], ts: str, arrival: Sequence[str], watermark: str, columns: Sequence[str]) -> DataFrame:
    """`columns` of `rows`, with `kind` set to `price` or `late` where `kind` was null.

    Rows that have a kind already are passed on unchanged; they are dealt by `arrival`, not by
    key. A timestamp at or behind the watermark, and any before 1970, is late.
    """
    aside = F.when(F.col("kind").isNotNull(), F.concat_ws(":", *arrival))
    micros = F.when(F.col("kind").isNull(), F.unix_micros(ts))
    placed = rows.withColumns({"_micros": micros, "_aside": aside, "_event_time": F.when(F.col("kind").isNull(), F.col(ts))})
    # The watermark column itself is left behind, or late rows would vanish before the state sees them.
    watched = placed.withWatermark("_event_time", watermark).drop("_event_time")
    out = T.StructType([rows.schema[c] for c in columns])
    processor = FirstCopies(len(keys), columns, arrival)
    return watched.groupBy(*keys, "_micros", "_aside").transformWithState(processor, out, "Append", "EventTime")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which keyed state needs; the setting stays with the query."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
