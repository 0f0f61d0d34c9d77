"""The streaming burst state function driven without Spark: random event orders and batch
splits, compared with the brute-force definition on the events the final watermark covers."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.streaming.burst_groups import make_burst_function

SPAN_US = 300_000_000
BUCKET_US = 360_000_000
DELAY_MS = 10_000


class FakeState:
    """Spark's GroupState as the function uses it (event-time timeout)."""

    def __init__(self):
        self.value, self.timeout, self.wm_ms, self.timed_out = None, None, -1, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)
    hasTimedOut = property(lambda self: self.timed_out)

    def getCurrentWatermarkMs(self):
        return self.wm_ms

    def update(self, v):
        self.value = v

    def remove(self):
        self.value, self.timeout = None, None

    def setTimeoutTimestamp(self, ms):
        assert ms >= self.wm_ms
        self.timeout = ms


def simulate(batches, n):
    fn = make_burst_function(n, SPAN_US, BUCKET_US)
    states, out, wm_ms, max_ms = {}, [], -1, -1
    max_ms = -1
    for events in batches:
        # to the own bucket, and near its end to the next one too
        batch = [((c, b), t) for c, t in events for b in sorted({t // BUCKET_US, (t + SPAN_US - 1) // BUCKET_US})]
        keys = sorted({c for c, _ in batch})
        for c in keys:
            st_ = states.setdefault(c, FakeState())
            st_.wm_ms, st_.timed_out = wm_ms, False
            rows = pd.DataFrame({"customer_id": [k[0] for k, _ in batch if k == c],
                                 "ts_us": [t for k, t in batch if k == c]})
            for df in fn(c, iter([rows]), st_):
                out += [(u, t, m) for u, t, k in zip(df.customer_id, df.ts_us, df.k) for m in range(n, k + 1)]
        for c, st_ in states.items():           # timeouts of keys without data in this batch
            if c not in keys and st_.exists and st_.timeout is not None and st_.timeout < wm_ms:
                st_.wm_ms, st_.timed_out = wm_ms, True
                for df in fn(c, iter([]), st_):
                    out += [(u, t, m) for u, t, k in zip(df.customer_id, df.ts_us, df.k) for m in range(n, k + 1)]
        # the watermark advances between batches: max event time seen minus the delay
        max_ms = max([max_ms] + [t // 1000 for _, t in events])
        wm_ms = max(wm_ms, max_ms - DELAY_MS)
    # one more empty batch at the final watermark (what availableNow runs)
    for c, st_ in states.items():
        if st_.exists and st_.timeout is not None and st_.timeout < wm_ms:
            st_.wm_ms, st_.timed_out = wm_ms, True
            for df in fn(c, iter([]), st_):
                out += [(u, t, m) for u, t, k in zip(df.customer_id, df.ts_us, df.k) for m in range(n, k + 1)]
    return sorted(out), wm_ms


def brute(events, n, wm_us, dropped):
    out = []
    for c in {c for c, _ in events}:
        ts = sorted(t for k, t in events if k == c and (k, t) not in dropped)
        for j in range(len(ts)):
            for i in range(j + 1):
                if j - i + 1 >= n and ts[j] - ts[i] < SPAN_US and ts[j] <= wm_us:
                    out.append((c, ts[j], j - i + 1))
    return sorted(out)


# times on a 1-minute grid over 15 minutes, plus 0 or 1 microsecond: gaps of exactly 5 minutes,
# 1 us under and over it, and ties are all common
events_st = st.lists(st.tuples(st.sampled_from(["a", "b"]),
                               st.tuples(st.integers(0, 15), st.integers(0, 1))
                                 .map(lambda kj: kj[0] * 60_000_000 + 10_000_000 + kj[1])),
                     min_size=3, max_size=25)


@settings(max_examples=300, deadline=None)
@given(events_st, st.lists(st.integers(1, 6), min_size=1, max_size=8), st.integers(2, 4))
def test_state_function_matches_brute_force(events, cuts, n):
    # split the (unordered) events into batches of the given sizes
    batches, i = [], 0
    for c in cuts:
        batches.append(events[i:i + c])
        i += c
    batches.append(events[i:])
    got, wm_ms = simulate(batches, n)
    # rows at or below the watermark of their batch are late and must be ignored
    dropped, wm, mx = set(), -1, -1
    late = []
    for b in batches:
        for e in b:
            if e[1] <= wm * 1000:
                late.append(e)
        mx = max([mx] + [t // 1000 for _, t in b])
        wm = max(wm, mx - DELAY_MS)
    kept = list(events)
    for e in late:
        kept.remove(e)
    assert got == brute(kept, n, wm_ms * 1000, set())


def test_hot_customer_gives_one_row_per_event():
    """20,000 events inside the span: rows and state stay linear, although the alerts would be 200 million."""
    fn = make_burst_function(3, SPAN_US, 8 * SPAN_US)
    state = FakeState()
    rows = pd.DataFrame({"customer_id": "hot", "ts_us": [1_000_000 + i * 10_000 for i in range(20_000)]})
    assert list(fn(("hot", 0), iter([rows]), state)) == []
    state.wm_ms, state.timed_out = 10 ** 6, True
    [out] = fn(("hot", 0), iter([]), state)
    assert len(out) == 19_998 and out.k.tolist() == list(range(3, 20_001)) and out.memory_usage(deep=True).sum() < 4_000_000
