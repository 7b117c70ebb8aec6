"""T6 for M3/M4: alerts about what did not happen, from a stream.

A log that fell silent brings no rows, so neither does a window over it close. Each watched
event has a timer instead, set to its last occurrence plus its window; an occurrence sets it
anew. A timer that runs out raises one alert, then waits for the next occurrence. Timers run on
the clock (`timeMode` ProcessingTime), so the micro-batches that fire them need no rows.

An event that was never logged is watched too, from `since` on: the watch list is the initial
state. State is one time an event; both live in the checkpoint, so a restarted stream neither
repeats nor loses an alert.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ingestry.operators.alerts import with_event

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = "event string, last long, due long"
SHIPPED = {"M3": ("trigger.csv_finished", 26.0), "M4": ("trigger.api_finished", 2.0)}  # hours


class Silence(StatefulProcessor):
    def __init__(self, windows_ms: Mapping[str, int]) -> None:
        self._windows = dict(windows_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "at long")

    def _seen(self, key, at: int) -> None:
        if self._last.exists() and self._last.get()[0] >= at:
            return
        for timer in list(self._handle.listTimers()):  # read to the end, then deleted
            self._handle.deleteTimer(timer)
        self._last.update((at,))
        self._handle.registerTimer(at + self._windows[key[0]])

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._seen(key, int(initialState["at"].max()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._seen(key, max(int(part["at"].max()) for part in rows))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, last = expiredTimerInfo.getExpiryTimeInMs(), self._last.get()[0]
        if due == last + self._windows[key[0]]:  # not set anew in this very batch
            yield pd.DataFrame([(key[0], last, due)], columns=["event", "last", "due"])

    def close(self) -> None:
        pass


def missed_runs_stream(logs: DataFrame, *, window_hours: Mapping[str, float], since_sql: str = "current_timestamp()") -> DataFrame:
    """event, last_seen, window_end: one row each time that an event of `window_hours` stayed
    away for its window after its last occurrence (or after `since_sql`, before any)."""
    spark = logs.sparkSession
    windows = {event: int(hours * 3_600_000) for event, hours in window_hours.items()}
    rows = with_event(logs).filter(F.col("event").isin(*windows)).filter("timestamp IS NOT NULL")
    watched = spark.createDataFrame([(e,) for e in windows], "event string").selectExpr("event", f"unix_millis({since_sql}) AS at")
    found = rows.selectExpr("event", "unix_millis(timestamp) AS at").groupBy("event").transformWithStateInPandas(
        Silence(windows), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime",
        initialState=watched.groupBy("event"),
    )
    return found.selectExpr("event", "timestamp_millis(last) AS last_seen", "timestamp_millis(due) AS window_end")
