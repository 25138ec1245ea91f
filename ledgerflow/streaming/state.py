"""Per-key state machine for "A followed by B within T" on a stream (``applyInPandasWithState``).

Events of a key are buffered until the watermark passes them, then consumed in (time, arrival)
order, which is what an event-time pattern operator does. Open A's time out when
``time - A.ts >= within`` (checked before each event and against the watermark). Rows arriving
behind the watermark are late and dropped. One key's state holds only its open A's and its not yet
final events.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import types as T

OUTPUT_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("first_seq", T.LongType()),
    T.StructField("first_us", T.LongType()),
    T.StructField("next_seq", T.LongType()),
    T.StructField("next_us", T.LongType()),
    T.StructField("result", T.StringType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("buf_us", T.ArrayType(T.LongType())),
    T.StructField("buf_seq", T.ArrayType(T.LongType())),
    T.StructField("buf_kind", T.ArrayType(T.StringType())),
    T.StructField("open_us", T.ArrayType(T.LongType())),
    T.StructField("open_seq", T.ArrayType(T.LongType())),
])


def pattern_state_fn(first: str, then: str, within_us: int, paid: str, timeout: str,
                     late: str | None = None):
    """``late``: the result label under which rows behind the watermark are reported; without it
    they are dropped."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        k = key[0]
        out = []
        wm_us = state.getCurrentWatermarkMs() * 1000
        if state.exists:
            b_us, b_seq, b_kind, o_us, o_seq = state.get
            buf = list(zip(b_us, b_seq, b_kind))
            open_ = list(zip(o_us, o_seq))
        else:
            buf, open_ = [], []
        if not state.hasTimedOut:
            for pdf in pdfs:
                for us, seq, kind in zip(pdf["us"].tolist(), pdf["seq"].tolist(),
                                         pdf["kind"].tolist()):
                    if wm_us > 0 and us < wm_us:
                        if late:
                            out.append((k, int(seq), int(us), None, None, late))
                        continue
                    buf.append((int(us), int(seq), kind))
        buf.sort()
        ready = [e for e in buf if e[0] <= wm_us]
        pending = [e for e in buf if e[0] > wm_us]

        def expire(now_us):
            nonlocal open_
            keep = []
            for cu, cs in open_:
                if now_us - cu >= within_us:
                    out.append((k, cs, cu, None, None, timeout))
                else:
                    keep.append((cu, cs))
            open_ = keep

        for us, seq, kind in ready:
            expire(us)
            if kind == then:
                out.extend((k, cs, cu, seq, us, paid) for cu, cs in open_)
                open_ = []
            elif kind == first:
                open_.append((us, seq))
        expire(wm_us)

        if pending or open_:
            state.update(([e[0] for e in pending], [e[1] for e in pending],
                          [e[2] for e in pending], [c[0] for c in open_], [c[1] for c in open_]))
            nxt = [e[0] for e in pending] + [c[0] + within_us for c in open_]
            state.setTimeoutTimestamp(max(min(nxt) // 1000, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=[f.name for f in OUTPUT_SCHEMA.fields]).astype(
                {"next_seq": "Int64", "next_us": "Int64"})
    return fn


def _number(integral: bool) -> T.DataType:
    """Sums are kept as units of the input's last decimal place, or as doubles for double input."""
    return T.LongType() if integral else T.DoubleType()


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


def _arrivals(pdfs: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(pdfs), ignore_index=True).sort_values("seq", kind="stable",
                                                                ignore_index=True)


def _keep_until(state, end_us: int) -> None:
    state.setTimeoutTimestamp(max(end_us // 1000, state.getCurrentWatermarkMs() + 1))


def marks_schemas(integral: bool) -> tuple[T.StructType, T.StructType]:
    num = _number(integral)
    return (_fields(("name", T.StringType()), ("seq", T.LongType()), ("total", num),
                    ("count", T.LongType()), ("segment", T.LongType()), ("fire", T.IntegerType())),
            _fields(("total", num), ("count", T.LongType()), ("segment", T.LongType())))


def marks_state_fn(threshold: Fraction | None, expire_ms: int | None = None):
    """Running sum and count per name, one output row per record (in arrival order); with a
    threshold (in the units of the sums), ``fire`` marks records whose running average passes it and
    ``segment`` counts the firings before the record (the purge segment it belongs to). A name that
    was silent for ``expire_ms`` of processing time starts anew."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        total, count, seg = state.get if state.exists else (0, 0, 0)
        rows = _arrivals(pdfs)
        run = total + rows["units"].cumsum()
        n = count + np.arange(1, len(rows) + 1)
        fire = np.zeros(len(rows), dtype="int32")
        if threshold is not None:
            fire = (run.to_numpy() * threshold.denominator > threshold.numerator * n).astype("int32")
        fired = seg + np.cumsum(fire)
        state.update((run.iloc[-1].item(), int(n[-1]), int(fired[-1])))
        if expire_ms:
            state.setTimeoutDuration(expire_ms)
        yield pd.DataFrame({"name": key[0], "seq": rows["seq"], "total": run, "count": n,
                            "segment": fired - fire, "fire": fire})
    return fn


def count_schemas(integral: bool) -> tuple[T.StructType, T.StructType]:
    num = _number(integral)
    return (_fields(("key", T.StringType()), ("window_start_us", T.LongType()),
                    ("fire_no", T.LongType()), ("cum_count", T.LongType()), ("total", num),
                    ("largest", num)),
            _fields(("count", T.LongType()), ("total", num), ("largest", num)))


def count_state_fn(n: int, size_us: int):
    """Count trigger per (key, window): fire (without purging) at every n-th element in arrival
    order, with the running count, sum and max; the state is dropped once the watermark passes
    the window's end (a partial last group does not fire)."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        start_us = int(key[1])
        if state.hasTimedOut:
            state.remove()
            return
        count, total, largest = state.get if state.exists else (0, 0, None)
        units = _arrivals(pdfs)["units"]
        at = count + np.arange(1, len(units) + 1)
        run, most = total + units.cumsum(), units.cummax()
        if largest is not None:
            most = most.clip(lower=largest)
        state.update((int(at[-1]), run.iloc[-1].item(), most.iloc[-1].item()))
        _keep_until(state, start_us + size_us)
        hit = at % n == 0
        if hit.any():
            yield pd.DataFrame({"key": key[0], "window_start_us": start_us, "fire_no": at[hit] // n,
                                "cum_count": at[hit], "total": run[hit].to_numpy(),
                                "largest": most[hit].to_numpy()})
    return fn


CONTENTS_STATE = _fields(("count", T.LongType()))


def contents_state_fn(size_us: int, columns: list[str]):
    """Window contents in long form: each element, unchanged, with its 1-based arrival rank in its
    (key, window); the state is one counter, dropped after the window ends."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        start_us = int(key[1])
        if state.hasTimedOut:
            state.remove()
            return
        (count,) = state.get if state.exists else (0,)
        rows = _arrivals(pdfs)
        state.update((count + len(rows),))
        _keep_until(state, start_us + size_us)
        out = rows[columns].copy()
        out["pos"] = count + np.arange(1, len(rows) + 1)
        yield out
    return fn


UV_OUTPUT = _fields(("window_start_us", T.LongType()), ("bucket", T.IntegerType()),
                    ("seq", T.LongType()), ("user_id", T.StringType()), ("uv", T.LongType()))
UV_STATE = _fields(("uv", T.LongType()))


def uv_counter_fn(size_us: int):
    """Per (window, bucket of users), count first sights in arrival order (the input holds only first
    sights); the counter is the whole state and is dropped after the window ends."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        start_us, bucket = int(key[0]), int(key[1])
        if state.hasTimedOut:
            state.remove()
            return
        (uv,) = state.get if state.exists else (0,)
        rows = _arrivals(pdfs)
        state.update((uv + len(rows),))
        _keep_until(state, start_us + size_us)
        yield pd.DataFrame({"window_start_us": start_us, "bucket": bucket, "seq": rows["seq"],
                            "user_id": rows["user_id"], "uv": uv + np.arange(1, len(rows) + 1)})
    return fn
