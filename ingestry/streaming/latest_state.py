"""T5: the merge as keyed state in a stream (optional path after foreachBatch).

`transformWithState` keeps, per `student_id`, the time of the newest row and its ordinal in the
state store (RocksDB: state beyond memory spills to disk). A micro-batch is a chunk of the
merge: of a key's rows the newest counts (ties: the larger ordinal), it is inserted, updated
or skipped by the strictly-newer rule, and the batch yields one row a key with the number of
rows submitted. A key's rows are folded one by one as Spark hands them over, so a key that holds a
third of a micro-batch costs two numbers, and one that holds a single row no frame of its own.

The state may start from the stored table (`initial`), and lives on in the checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "at long, place long"
OUTPUT = "student_id string, at long, place long, action string, submitted long"


class NewestPerKey(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self._stored = handle.getValueState("stored", STATE)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._stored.update((initialState["at"], initialState["place"]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best, submitted = None, 0
        for row in rows:
            submitted += 1
            found = (row["at"], row["place"])
            if None not in found and (best is None or found > best):
                best = found
        if best is None:
            raise ValueError(f"no row of {key[0]!r} has a time and a place")
        stored = self._stored.get() if self._stored.exists() else None
        action = "inserted" if stored is None else "updated" if best[0] > stored[0] else "skipped"
        if action != "skipped":
            self._stored.update(best)
        yield Row(student_id=key[0], at=best[0], place=best[1], action=action, submitted=submitted)

    def close(self) -> None:
        pass


def _narrow(rows: DataFrame, order: str) -> DataFrame:
    return rows.selectExpr("student_id", "unix_micros(updated_at) AS at", f"CAST({order} AS BIGINT) AS place")


def latest_actions(students: DataFrame, *, order: str, initial: DataFrame | None = None) -> DataFrame:
    """Streaming canonical rows -> student_id, updated_at, place (ordinal of the newest row),
    action and submitted, one row for each key of a micro-batch. `initial` is the stored table
    (unique by key); it counts when the stream starts without a checkpoint."""
    stored = None if initial is None else _narrow(initial, "-1").groupBy("student_id")
    found = _narrow(students, f"`{order}`").groupBy("student_id").transformWithState(
        NewestPerKey(), outputStructType=OUTPUT, outputMode="Append", timeMode="None", initialState=stored
    )
    return found.selectExpr("student_id", "timestamp_micros(at) AS updated_at", "place", "action", "submitted")
