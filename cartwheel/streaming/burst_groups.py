"""State function of the streaming burst detector, for ``applyInPandasWithState``.

Self-contained (imports only pandas/numpy/pyspark), pickled by value. A key is a group of customers and a time bucket, as a call costs
milliseconds whatever it holds. State per key is one row: the customers, and with the place of its customer each pending event
time (not yet behind the watermark) and each recent judged time (inside the span), as arrays of 64-bit integers. Only times are needed: events of equal time share
their detection time, so the order among them cannot change the (time, run length) alerts. The rows of a key and its
state arrive together as Arrow batches, so there are no per-call state round trips. See
``cartwheel.streaming.bursts`` for the semantics.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

STATE_DDL = "customers ARRAY<STRING>, pending_of BINARY, pending BINARY, recent_of BINARY, recent BINARY"
RUN_DDL = "customer_id STRING, ts_us BIGINT, k BIGINT"


def _ceil_ms(us: int) -> int:
    return -((-us) // 1000)


def _run_lengths(of: np.ndarray, ts: np.ndarray, span_us: int) -> np.ndarray:
    """K of each event: events of its customer in (t - span, t] up to itself. The events are sorted by customer and time."""
    times = np.unique(ts)
    place = of * (len(times) + 1)
    lo = np.searchsorted(place + np.searchsorted(times, ts), place + np.searchsorted(times, ts - span_us, side="right"))
    return np.arange(len(ts)) - lo + 1


def make_burst_function(min_count: int, span_us: int, bucket_us: int):
    """Key: group of customers and bucket. Events before the bucket's start are copies from the bucket before: they count, but
    give no row. A row (customer, time, K) for each own event with K >= ``min_count``."""
    def burst_groups(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        wm_ms = state.getCurrentWatermarkMs()
        wm_us = max(wm_ms, 0) * 1000
        names, held = [], [b""] * 4
        if state.exists:
            names, *held = state.get
        names = [np.array(list(names), dtype=object)]
        of, ts, recent_of, recent = (np.frombuffer(bytes(b), "<i8") for b in held)
        known, parts = len(names[0]), [ts]
        if not state.hasTimedOut:
            for pdf in pdfs:
                t = pdf["ts_us"].to_numpy(dtype="int64")
                # at or below the watermark: late; no customer: not a pattern key
                taken = (t > wm_us) & pdf["customer_id"].notna().to_numpy()
                parts.append(t[taken])
                names.append(pdf["customer_id"].to_numpy(dtype=object)[taken])
        ts = np.concatenate(parts)
        places, names = pd.factorize(np.concatenate(names))     # known customers keep their places
        of = np.concatenate([of, places[known:]])
        ready = ts <= wm_us
        out = None
        if ready.any():
            r_of, r_ts = np.concatenate([recent_of, of[ready]]), np.concatenate([recent, ts[ready]])
            order = np.lexsort((r_ts, r_of))
            r_of, r_ts = r_of[order], r_ts[order]
            k = _run_lengths(r_of, r_ts, span_us)
            hit = (order >= len(recent)) & (k >= min_count) & (r_ts >= key[1] * bucket_us)
            if hit.any():
                out = pd.DataFrame({"customer_id": names[r_of[hit]], "ts_us": r_ts[hit], "k": k[hit].astype("int64")})
            recent_of, recent = r_of, r_ts
            of, ts = of[~ready], ts[~ready]
        near = recent > wm_us - span_us         # what is judged later is past the watermark
        recent_of, recent = recent_of[near], recent[near]

        if len(ts) or len(recent):
            used = np.unique(np.concatenate([of, recent_of]))
            arrays = np.searchsorted(used, of), ts, np.searchsorted(used, recent_of), recent
            state.update((names[used].tolist(), *(a.astype("<i8").tobytes() for a in arrays)))
            nxt = int(ts.min()) if len(ts) else int(recent.max()) + span_us
            # timeouts fire once the watermark is past the timestamp: one ms before the event
            state.setTimeoutTimestamp(max(_ceil_ms(nxt) - 1, wm_ms))
        elif state.exists:
            state.remove()
        if out is not None:
            yield out

    return burst_groups
