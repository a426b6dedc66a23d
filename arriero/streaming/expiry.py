"""Latest state per key that expires by itself: event-time timers over the state store."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Columns that travel with a key's newest row: whether it still holds, its time and the first time since the silence before (both in
#: microseconds, which no time zone bends), and the records since then.
ADDED = StructType([StructField("vigente", BooleanType()), StructField("momento_us", LongType()), StructField("desde_us", LongType()), StructField("registros", LongType())])


class _Latest(StatefulProcessor):
    """One value and one timer per key: the newest row, and the moment at which it has been silent for too long."""

    def __init__(self, names: Sequence[str], schema: StructType, order: Sequence[str], silence: timedelta) -> None:
        self.names, self.schema, self.order = list(names), schema, list(order)
        self.silence = silence // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("vigente", self.schema)

    def _rank(self, row) -> tuple:
        return (row["momento_us"], *((row[c] is not None, row[c]) for c in self.order))

    def _held(self) -> dict | None:
        return dict(zip(self.schema.names, self.state.get())) if self.state.exists() else None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._held()
        before = held and held["momento_us"]
        for row in sorted(rows, key=self._rank):  # a key's rows of one batch
            at = row["momento_us"]
            if held and at >= held["momento_us"] + self.silence:
                yield Row(**{**held, "vigente": False})  # the silence ended within this batch, before its timer could fire
                held = None
            if held is None:
                held = {**{n: row[n] for n in self.names}, "vigente": True, "momento_us": at, "desde_us": at, "registros": 0}
            elif self._rank(row) >= self._rank(held):
                held = {**held, **{n: row[n] for n in self.names}, "momento_us": at}
            held = {**held, "desde_us": min(held["desde_us"], at), "registros": held["registros"] + 1}
        if held is None:
            return
        self.state.update(tuple(held[n] for n in self.schema.names))
        if before != held["momento_us"]:
            if before is not None:
                self.handle.deleteTimer(self._due(before))
            self.handle.registerTimer(self._due(held["momento_us"]))
        yield Row(**held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        if held and self._due(held["momento_us"]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
            yield Row(**{**held, "vigente": False})

    def _due(self, at: int) -> int:
        return -(-(at + self.silence) // 1000)  # milliseconds, rounded up: never before the silence is over

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, on the executors' disks; the session's setting comes back afterwards."""
    before = spark.conf.get(PROVIDER_SETTING, None)
    spark.conf.set(PROVIDER_SETTING, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_SETTING)
        else:
            spark.conf.set(PROVIDER_SETTING, before)


def expiring_latest(stream: DataFrame, keys: Sequence[str], at: str, order: Sequence[str], silence: timedelta,
                    delay: str = "0 seconds") -> DataFrame:
    """The newest row per key while the key reports, as changes (update mode; start it within ``rocksdb``).

    A batch emits each key it touches once with ``vigente`` true. A key without a record for ``silence`` of event time is emitted
    with ``vigente`` false and its state is removed, by a timer, so that it needs no further record; the watermark, ``delay`` behind
    the newest event, is its clock. State therefore holds only keys that reported within ``silence`` and ``delay``. Rows later than
    the watermark are dropped; older rows than the newest count but do not replace it; rows without a time are left out. ``vence``
    is the end of the silence, ``desde`` the first of the records since the silence before, ``registros`` their number.
    """
    names = stream.columns
    timed = stream.where(F.col(at).isNotNull()).withColumn("momento_us", F.unix_micros(F.col(at).cast("timestamp"))).withWatermark(at, delay)
    schema = StructType([*stream.schema.fields, *ADDED.fields])
    out = timed.groupBy(*keys).transformWithState(_Latest(names, schema, order, silence), schema, "update", "eventTime")
    micros = silence // timedelta(microseconds=1)
    return out.select(*names, "vigente", F.timestamp_micros(F.col("momento_us") + micros).alias("vence"), F.timestamp_micros("desde_us").alias("desde"), "registros")
