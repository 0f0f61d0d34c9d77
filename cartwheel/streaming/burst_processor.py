"""Stateful processor of the streaming burst detector, for ``transformWithStateInPandas``.

Self-contained (imports only pandas/numpy/pyspark), pickled by value. A key is a customer and a time bucket. State:
* ``pending``: list of event times that are not yet behind the watermark. New events are appended; nothing is read or rewritten for them.
* ``recent``: list of judged times inside the last span.
* ``due``: the one event-time timer that is set.

Only a timer judges. It fires when the watermark is past the earliest pending time; with nothing pending, when the last recent
time leaves the span. Judged times expire one by one, by the time of the last judged event.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor

RUN_DDL = "customer_id STRING, ts_us BIGINT, k BIGINT"
TIMES_DDL = "ts_us BIGINT"
DUE_DDL = "ms BIGINT"


def _rows(times: np.ndarray) -> list[tuple[int]]:
    return [(int(t),) for t in times]


def _times(state) -> np.ndarray:
    return np.sort(np.fromiter((t for t, in state.get()), dtype="int64")) if state.exists() else np.empty(0, "int64")


class BurstProcessor(StatefulProcessor):
    """``floor_ms`` is the watermark of the query whose state this one goes on from: what that one would drop is dropped here too."""

    def __init__(self, min_count: int, span_us: int, bucket_us: int, floor_ms: int = 0):
        self.min_count, self.span_us, self.bucket_us, self.floor_ms = min_count, span_us, bucket_us, floor_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", TIMES_DDL)
        self.recent = handle.getListState("recent", TIMES_DDL)
        self.due = handle.getValueState("due", DUE_DDL)

    def _watermark(self, timers) -> int:
        return max(timers.getCurrentWatermarkInMs(), self.floor_ms, 0)

    def _wake(self, at_us: int, wm_ms: int) -> None:
        """Set the timer for a time, unless it is set for an earlier one. A timer fires once the watermark is past it: one ms before."""
        ms = max(-(-int(at_us) // 1000) - 1, wm_ms)
        due = self.due.get()
        if due is None or ms < due[0]:
            if due is not None:
                self.handle.deleteTimer(due[0])
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        wm_ms = self._watermark(timerValues)
        first = None
        for pdf in rows:
            t = pdf["ts_us"].to_numpy(dtype="int64")
            t = t[t > wm_ms * 1000]                 # at or below the watermark: late
            if key[0] is not None and len(t):       # no customer: not a pattern key
                self.pending.appendList(_rows(t))
                first = int(t.min()) if first is None else min(first, int(t.min()))
        if first is not None:
            self._wake(first, wm_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm_ms = self._watermark(timerValues)
        pending, recent = _times(self.pending), _times(self.recent)
        self.due.clear()
        ready = pending[pending <= wm_ms * 1000]
        out = []
        if len(ready):
            times = np.concatenate([recent, ready])
            k = np.arange(len(recent), len(times)) - np.searchsorted(times, ready - self.span_us, side="right") + 1
            hit = (k >= self.min_count) & (ready >= key[1] * self.bucket_us)    # copies from the bucket before only count
            if hit.any():
                out.append(pd.DataFrame({"customer_id": key[0], "ts_us": ready[hit], "k": k[hit].astype("int64")}))
            recent, pending = times[times > times[-1] - self.span_us], pending[len(ready):]
            self.recent.put(_rows(recent))
            if len(pending):
                self.pending.put(_rows(pending))
            else:
                self.pending.clear()
        if len(pending):
            self._wake(pending[0], wm_ms)
        elif len(recent) and int(recent[-1]) + self.span_us > wm_ms * 1000:
            self._wake(recent[-1] + self.span_us, wm_ms)
        else:
            self.recent.clear()
        return iter(out)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        wm_ms = self._watermark(timerValues)
        for name, state in (("pending", self.pending), ("recent", self.recent)):
            t = initialState.loc[initialState["kind"] == name, "ts_us"].to_numpy(dtype="int64")
            if len(t):
                state.appendList(_rows(t))
                self._wake(t.min() if name == "pending" else t.max() + self.span_us, wm_ms)

    def close(self) -> None:
        pass
