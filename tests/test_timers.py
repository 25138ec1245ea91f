"""Streams that keep their own timers, row by row against the batch operators: out-of-order rows, rows
spread over several micro-batches, windows that close one after another."""

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow import streaming as S
from ledgerflow.operators import behavior, triggers
from ledgerflow.sources import tables as tb
from test_streaming import _chunks, _write_files

START = datetime(2024, 1, 1)


def _stream(spark, df, src):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)


def _run(df, name, scratch):
    S.start(df, name, checkpoint=os.path.join(scratch, f"ck_{name}")).awaitTermination()
    return df.sparkSession.table(name)


def _sentinel(df, **values):
    """One row far in the future, which closes every window before it."""
    row = {"ts": F.lit("2030-01-01").cast("timestamp_ntz"), **{k: F.lit(v) for k, v in values.items()}}
    return df.limit(1).select(*[row.get(c, F.col(c)).cast(df.schema[c].dataType).alias(c) for c in df.columns])


def _out_of_order(spark, n, minutes, seed, late=20):
    """Device rows whose times come up to ``late`` minutes out of order, some without a value."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(minutes=minutes * i / n - rnd.uniform(0, late), microseconds=rnd.randrange(10 ** 6))
        value = None if rnd.random() < 0.1 else Decimal(rnd.randrange(-10 ** 6, 10 ** 6)) / 100
        rows.append((f"d{rnd.randrange(3)}", value, at, i))
    return spark.createDataFrame(rows, "id string, value decimal(38,2), ts timestamp_ntz, seq long")


def _fired(df):
    return sorted((r.id, r.window_start, r.window_end, r.fire_time, r.fire_kind, r.cum_count, str(r.cum_sum),
                   str(r.cum_max)) for r in df.where("id <> 'x'").collect())


@pytest.mark.parametrize("size, interval", [("1 hour", "10 minutes"), ("20 minutes", "7 minutes"), ("1 day", "6 hours")])
def test_early_and_final_firing_in_one_query(spark, scratch, size, interval):
    if size == "1 day":
        df = tb.events_as_devices(tb.load_table(spark, SF_SMALL, "events")).select("id", "value", "ts", "seq")
    else:
        df = _out_of_order(spark, 400, 300, 1)
    src = os.path.join(scratch, "dev")
    _write_files([*_chunks(df, "seq", 5), _sentinel(df, id="x", seq=10 ** 9)], src)
    stream = S.early_firing_stream(_stream(spark, df, src), "id", "ts", size, interval, delay="20 minutes")
    name = "early_" + size.replace(" ", "_")
    got = _fired(_run(stream, name, scratch))
    want = _fired(triggers.early_firing(S.event_time(df), "id", "ts", size, interval))
    assert got == want and {r[4] for r in got} == {"early", "final"}


def test_early_firing_gives_ticks_before_the_window_ends(spark, scratch):
    """A tick comes out with the batch whose watermark passes it; a row behind its tick counts later on."""
    at = lambda m: START + timedelta(minutes=m)
    batches = [[("a", Decimal(1), at(5), 1)], [("a", Decimal(2), at(25), 2)],
               [("a", Decimal(4), at(6), 3), ("a", Decimal(8), at(45), 4)], [("a", Decimal(16), at(200), 5)]]
    src = os.path.join(scratch, "ticks")
    frames = [spark.createDataFrame(b, "id string, value decimal(38,0), ts timestamp_ntz, seq long") for b in batches]
    _write_files(frames, src)
    out = S.early_firing_stream(_stream(spark, frames[0], src), "id", "ts", "1 hour", "10 minutes")
    got = [(r.fire_time, r.fire_kind, r.cum_sum) for r in _run(out, "ticks", scratch).orderBy("fire_time").collect()]
    first = S.event_time(frames[0]).select(F.date_trunc("day", "ts").alias("t")).first().t
    minute = lambda m: first + timedelta(minutes=m)
    # the row of minute 6 comes after the tick of minute 10 has fired, so the next tick holds it
    assert got == [(minute(10), "early", 1), (minute(30), "early", 7), (minute(50), "early", 15),
                   (minute(60), "final", 15)]


def test_amounts_beyond_a_long(spark, scratch):
    big = Decimal("123456789012345678901234567890.12")
    rows = [("a", big, START + timedelta(minutes=i), i) for i in range(4)] + [("x", big, START + timedelta(days=9), 9)]
    df = spark.createDataFrame(rows, "id string, value decimal(38,2), ts timestamp_ntz, seq long")
    src = os.path.join(scratch, "big")
    _write_files([df], src)
    got = _run(S.early_firing_stream(_stream(spark, df, src), "id", "ts", "1 hour", "10 minutes"), "big", scratch)
    assert got.where("fire_kind = 'final' AND id = 'a'").first().cum_sum == Decimal("493827156049382715604938271560.48")


@pytest.mark.parametrize("size, slide, delay", [("1 hour", "10 seconds", "0 seconds"), ("30 minutes", "10 minutes", "20 minutes")])
def test_ring_of_panes_equals_batch(spark, scratch, size, slide, delay):
    if delay == "0 seconds":
        m = tb.events_as_marketing(tb.load_table(spark, SF_SMALL, "events")).where("behavior <> 'error'").select(
            "ts", "channel", "behavior", "seq")
    else:
        m = _out_of_order(spark, 500, 400, 2).select("ts", F.col("id").alias("channel"), F.when(
            F.col("seq") % 3 > 0, "click").alias("behavior"), "seq")
    src = os.path.join(scratch, "mk")
    _write_files([*_chunks(m, "seq", 4), _sentinel(m, channel="x", behavior="x", seq=10 ** 9)], src)
    out = S.sliding_ring_stream(_stream(spark, m, src), "ts", size, slide, ["channel", "behavior"], delay)
    got = _run(out, f"ring_{size.split()[0]}", scratch).where("channel <> 'x'")
    want = behavior.sliding_counts(S.event_time(m), "ts", size, slide, ["channel", "behavior"])
    cols = ["window_start", "window_end", "channel", "behavior", "count"]
    assert got.count() == want.count() > 0
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0


def test_ring_holds_only_panes_of_open_windows():
    from ledgerflow.streaming.timers import ring_state_fn
    import pandas as pd

    class State:
        exists = hasTimedOut = False
        mark = 0

        def getCurrentWatermarkMs(self):
            return self.mark

        def update(self, value):
            self.get, self.exists = value, True

        def remove(self):
            self.exists = False

        def setTimeoutTimestamp(self, t):
            assert t > self.mark

    size, slide = 3_600_000_000, 10_000_000
    fn, state, rows = ring_state_fn(size, slide, ["key0", "start_us", "count"]), State(), 0
    for i in range(2000):
        state.mark = (i + 1) * slide // 1000
        for out in fn(("a",), iter([pd.DataFrame({"pane_us": [i * slide], "n": [1]})]), state):
            rows += len(out)
            assert (out["count"] <= 360).all()
        assert len(state.get[1]) <= 360
    assert rows == 2000  # one window closes with each pane


@pytest.mark.parametrize("condition", ["default", "average", "every third"])
def test_segments_with_any_condition(spark, scratch, condition):
    marks = tb.events_as_marks(tb.load_table(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "marks")
    _write_files(_chunks(marks, "seq", 4), src)
    predicate, rule = {
        "default": (None, None),
        "average": ((F.col("avg_mark") < 50) & (F.col("count") > 2),
                    lambda seen: [a is not None and a < 50 and c > 2 for a, c in zip(seen["avg_mark"], seen["count"])]),
        "every third": (F.col("count") % 3 == 0, lambda seen: seen["count"] % 3 == 0)}[condition]
    out = S.purge_segments_stream(_stream(spark, marks, src), threshold=60, condition=rule)
    got = _run(out, "segments_" + condition.replace(" ", "_"), scratch)
    want = behavior.purge_segments(behavior.running_average(marks), threshold=60, condition=predicate)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_distinct_users_after_every_view(spark, scratch):
    e = tb.load_table(spark, SF_SMALL, "events")
    v = e.select("ts", (F.col("user_id") % 7).alias("user_id"), F.col("event_id").alias("seq"))
    src, out = os.path.join(scratch, "views"), os.path.join(scratch, "uv")
    _write_files(_chunks(v, "seq", 4), src)
    q = S.uv_running_sink(_stream(spark, v, src), "ts", "user_id", "1 day", out, delay="400 days",
                          checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = S.read_uv_running(spark, out)
    want = behavior.uv_running(S.event_time(v), "ts", "user_id", "1 day", hashed=True)
    assert got.count() == v.count()  # a row for every view, not only for first sights
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
