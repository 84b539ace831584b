"""Keyed state as stateful processors: the newest version of each path, and retries with back-off by timer.

State lives in the state store, one small value per path, and is read and written for the paths of a micro-batch
only. Rows carry ``path, ts, seq, failed`` and payload columns; positions (ts, seq) decide, not arrival. Processors
see times as microseconds since 1970, which no time zone changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIRST_DELAY = timedelta(hours=1)
LONGEST_DELAY = timedelta(days=7)
LATENESS = "1 hour"

_DUE = "path string, attempt int, at long, seq long, due long"
_AT = "_at"


def _millis(micros: int) -> int:
    """Rounded up: timers have no finer time."""
    return -(-micros // 1000)


class NewestVersion(StatefulProcessor):
    """Emits a row of a path if it is newer than all before; repeated and late ones change nothing.

    With ``kept``, a path is forgotten when the watermark is so many microseconds past its newest row.
    """

    def __init__(self, kept: int | None) -> None:
        self.kept = kept

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.position = handle.getValueState("position", "at long, seq long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest = max(rows, key=lambda r: (r[_AT], r["seq"]))
        held = self.position.get()
        if held is None or (newest[_AT], newest["seq"]) > (held[0], held[1]):
            if self.kept is not None:
                if held is not None:
                    self.handle.deleteTimer(_millis(held[0] + self.kept))
                self.handle.registerTimer(_millis(newest[_AT] + self.kept))
            self.position.update((newest[_AT], newest["seq"]))
            yield newest

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.position.clear()
        return iter(())


class Backoff(StatefulProcessor):
    """Tells when a failed read is due again: after a first delay that doubles with each failure in a row.

    A newer event of the path, good or bad, calls the retry off that was waiting. One that arrives behind the newest
    is left out.
    """

    def __init__(self, first: timedelta, longest: timedelta) -> None:
        self.first, self.longest = (d // timedelta(microseconds=1) for d in (first, longest))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, seq long, failures int, timer long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.last.get()
        at, seq, failures, timer = held if held is not None else (None, None, 0, None)
        registered = timer
        for row in sorted(rows, key=lambda r: (r[_AT], r["seq"])):
            if at is not None and (row[_AT], row["seq"]) <= (at, seq):
                continue
            if timer is not None and timer <= _millis(row[_AT]):
                # It fell due before this event, whether the watermark has shown it or not.
                yield self._due(key, at, seq, failures)
            at, seq = row[_AT], row["seq"]
            failures = failures + 1 if row["failed"] else 0
            timer = _millis(self._when(at, failures)) if failures else None
        if timer != registered:
            if registered is not None:
                self.handle.deleteTimer(registered)
            if timer is not None:
                self.handle.registerTimer(timer)
        if at is not None:
            self.last.update((at, seq, failures, timer))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        at, seq, failures, timer = self.last.get()
        if timer == expiredTimerInfo.getExpiryTimeInMs():
            self.last.update((at, seq, failures, None))
            yield self._due(key, at, seq, failures)

    def _when(self, at: int, failures: int) -> int:
        return at + min(self.first * 2 ** min(failures - 1, 40), self.longest)

    def _due(self, key: Any, at: int, seq: int, failures: int) -> Row:
        return Row(path=key[0], attempt=failures, at=at, seq=seq, due=self._when(at, failures))


def _keep_state(rows: DataFrame) -> None:
    """Stateful processors need a store that can be asked for single values."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def newest_versions(rows: DataFrame, ttl: timedelta | None = None, lateness: str = LATENESS) -> DataFrame:
    """The rows of a stream that are the newest of their ``path`` so far.

    With ``ttl`` a path is forgotten that was silent so long by the watermark, ``lateness`` behind the newest
    row; rows from before the watermark are then left out, so nothing forgotten can come back as new.
    """
    _keep_state(rows)
    placed = rows.withColumn(_AT, F.unix_micros("ts"))
    if ttl is None:
        return placed.groupBy("path").transformWithState(NewestVersion(None), StructType(placed.schema.fields), "Append", "None").drop(_AT)
    kept = ttl // timedelta(microseconds=1)
    marked = placed.withWatermark("ts", lateness)
    return marked.groupBy("path").transformWithState(NewestVersion(kept), StructType(placed.schema.fields), "Append", "EventTime").drop(_AT)


def due_retries(
    rows: DataFrame, first: timedelta = FIRST_DELAY, longest: timedelta = LONGEST_DELAY, lateness: str = LATENESS,
) -> DataFrame:
    """``path, attempt, failed_at, seq, due_at``: one row for each failed read that nothing newer came after until it was due.

    ``attempt`` counts failures in a row. A retry is told once the watermark, ``lateness`` behind the newest event, has
    passed its time, or a newer event of its path shows that it was due before.
    """
    _keep_state(rows)
    marked = rows.select("path", "ts", F.unix_micros("ts").alias(_AT), "seq", "failed").withWatermark("ts", lateness)
    due = marked.groupBy("path").transformWithState(Backoff(first, longest), _DUE, "Append", "EventTime")
    return due.select(
        "path", "attempt", F.timestamp_micros("at").alias("failed_at"), "seq", F.timestamp_micros("due").alias("due_at"))


def write_rows(rows: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to ``output``, each micro-batch once, until all that has arrived is processed."""
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", output).trigger(availableNow=True).start()


def newest_rows(written: DataFrame) -> DataFrame:
    """The last row of each path in what ``newest_versions`` wrote."""
    others = [c for c in written.columns if c not in ("path", "ts", "seq")]
    best = written.groupBy("path").agg(F.max(F.struct("ts", "seq", *others)).alias("last"))
    return best.select("path", "last.*")
