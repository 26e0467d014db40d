"""Bracket runs of a stream of frames: keyed state, event-time timers, closed by their contents."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sievewright.shipping import ship

FRAME = "micros long, name string, value double"


def closed(frames: list[tuple], until: int, gap: int, most: int) -> tuple[list[list[tuple]], list[tuple]]:
    """Runs of ``frames`` (micros, name, value) that no frame to come can change, and the frames that are kept.

    No frame up to ``until`` is still to come. A run is closed by the frame that begins the
    next one, by its length, or once ``until`` is as far behind its last frame as a gap.
    """
    settled = sorted((f for f in frames if f[0] <= until), key=lambda f: (f[0], f[1] is not None, f[1] or "", f[2] is not None, f[2] or 0.0))
    runs: list[list[tuple]] = []
    for f in settled:
        run = runs[-1] if runs else None
        if run and f[0] - run[-1][0] <= gap and len(run) < most and (f[2] is None or f[2] not in [x[2] for x in run]):
            run.append(f)
        else:
            runs.append([f])
    open_ = runs.pop() if runs and len(runs[-1]) < most and until < runs[-1][-1][0] + gap else []
    return runs, open_ + [f for f in frames if f[0] > until]


def holds(run: list[tuple], spread: float) -> bool:
    values = [f[2] for f in run]
    return len(run) > 1 and None not in values and max(values) - min(values) >= spread


class Runs(StatefulProcessor):
    """Keeps a key's frames until their run is closed, with one timer: that of the first kept frame that could close a run."""

    def __init__(self, gap: int, most: int, spread: float):
        self.gap, self.most, self.spread = gap, most, spread

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.frames = handle.getListState("frames", FRAME)
        self.timer = handle.getValueState("timer", "at long")

    def _wake(self, frames: list[tuple], until: int) -> None:
        """One timer, a millisecond beyond the first gap that ends after ``until``."""
        before = self.timer.get()
        if before is not None:
            self.handle.deleteTimer(before[0])
        at = max(min(f[0] for f in frames) + self.gap, until) // 1000 + 1
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def _rows(self, key, run: list[tuple], committed: bool) -> Iterator[Row]:
        for micros, name, _ in run:
            first = run[0] if committed else (micros, name)
            yield Row(key=key[0], name=name, at=_time(micros), run_at=_time(first[0]), run_name=first[1], committed=committed)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = []
        for r in rows:
            if r["micros"] is None:
                yield Row(key=key[0], name=r["name"], at=None, run_at=None, run_name=r["name"], committed=False)
            else:
                new.append((r["micros"], r["name"], r["value"]))
        if new:
            held = self.timer.get()
            self.frames.appendList(new)
            # A timer that is set wakes early enough for older frames; only one that comes before it moves it.
            if held is None or min(f[0] for f in new) + self.gap < held[0] * 1000:
                self._wake(new, -(2**62))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        runs, kept = closed([tuple(f) for f in self.frames.get()], until, self.gap, self.most)
        self.timer.clear()
        if kept:
            self.frames.put(kept)
            self._wake(kept, until)
        else:
            self.frames.clear()
        for run in runs:
            yield from self._rows(key, run, holds(run, self.spread))

    def close(self) -> None:
        pass


def _time(micros: int | None) -> datetime | None:
    return None if micros is None else datetime.fromtimestamp(micros // 1_000_000, timezone.utc).replace(microsecond=micros % 1_000_000)


def bracket_stream(frames: DataFrame, key: str, at: str, value: str, name: str, gap: float, lateness: str, most: int = 9, spread: float = 0.5) -> DataFrame:
    """key, name, at, run_at, run_name, committed of each frame of a stream, once its run is closed.

    Runs are those of ``operators.runs.bracket_runs``, known by their first frame: (run_at,
    run_name). ``at`` is a timestamp; frames may arrive in any order within ``lateness``,
    later ones are left out and counted (``late``). A run closes when the watermark has
    passed its end; its frames then leave the state, and a key without open frames keeps
    none. Frames without a time are runs of one, at once. A key's open frames are in one
    task: those of the lateness and one run. The state store must be RocksDB's.
    """
    ship(frames.sparkSession)
    rows = frames.select(F.col(key).alias("key"), F.col(name).cast("string").alias("name"), F.col(at).alias("at"), F.unix_micros(F.col(at)).alias("micros"), F.col(value).cast("double").alias("value"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, name string, at timestamp, run_at timestamp, run_name string, committed boolean"
    watched = rows.withWatermark("at", lateness).groupBy("key")
    return watched.transformWithState(Runs(round(gap * 1e6), most, spread), schema, "append", "EventTime").withColumnRenamed("key", key)


def late(query) -> int:
    """Frames that a running or ended query left out as later than its lateness."""
    return sum(operator.get("numRowsDroppedByWatermark", 0) for progress in query.recentProgress for operator in progress["stateOperators"])
