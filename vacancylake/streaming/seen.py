"""A set of seen keys that forgets by its own rule, not by the stream's watermark.

Every key has a value state, the moment until which it counts as seen, and an event-time timer at that moment that removes it.
The watermark only drives the timers: however far it moves, a repeat before the key's own expiry is dropped, over restarts as
well, as the state lies in the stream's checkpoint. Needs the RocksDB state store, which ``seen_until`` sets for the session.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vacancylake.functions import dates
from vacancylake.session import ship_package

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _millis(stamp: dt.datetime) -> int:
    return round(stamp.timestamp() * 1000)


class _SeenUntil(StatefulProcessor):
    def __init__(self, moment: str, keep_ms: int, order: list[str]):
        self.moment, self.keep_ms, self.order = moment, keep_ms, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "until bigint")

    def _place(self, row: Row) -> tuple:
        return tuple((row[c] is not None, row[c]) for c in [self.moment, *self.order])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        """Of a batch's rows of a key, the earliest that is not within the time the key counts as seen; at most one."""
        until = self.until.get()[0] if self.until.exists() else None
        first = None
        for row in rows:
            if row[self.moment] is None:
                continue
            if until is not None and _millis(row[self.moment]) < until:
                continue
            if first is None or self._place(row) < self._place(first):
                first = row
        if first is not None:
            if until is not None:
                self.handle.deleteTimer(until)
            until = _millis(first[self.moment]) + self.keep_ms
            self.until.update((until,))
            self.handle.registerTimer(until)
            yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def seen_until(stream: DataFrame, key: list[str], moment: str, keep: dt.timedelta, delay: str = "0 seconds", order: list[str] | None = None) -> DataFrame:
    """The first row of each key, and again the first one ``keep`` or more after it.

    ``moment`` is a timestamp without a zone. ``delay`` is how late rows of a new key may come; ``order`` breaks ties of the
    moment. Rows without a moment are dropped; NULL is a key like any other. One row of a key passes in a batch at most.
    """
    spark = stream.sparkSession
    ship_package(spark)
    spark.conf.set(_PROVIDER, _ROCKS)
    timed = stream.withColumn(moment, dates.as_instant(F.col(moment))).withWatermark(moment, delay)
    processor = _SeenUntil(moment, round(keep.total_seconds() * 1000), order or [])
    once = timed.groupBy(*key).transformWithState(processor, timed.schema, "Append", "EventTime")
    return once.withColumn(moment, dates.from_instant(F.col(moment)))
