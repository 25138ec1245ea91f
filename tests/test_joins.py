from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow.operators import joins
from ledgerflow.sources import tables as tb


def _side(spark, rows):
    df = spark.createDataFrame(rows, "user string, ts_ms long, action string")
    return df.withColumn("ts", F.timestamp_millis("ts_ms"))


def test_interval_join_golden(spark):
    # The reference's interval-join demo literals (ms), range -90 s .. 0 s.
    left = _side(spark, [("user_1", 80_000, "click"), ("user_1", 20_000, "click")])
    right = _side(spark, [("user_1", 4_000, "browse"), ("user_1", 80_000, "browse"),
                          ("user_1", -11_000, "browse")])
    out = joins.interval_join(left, right, "user", "-90 seconds", "0 seconds",
                              lcols=["ts_ms"], rcols=["ts_ms"]).collect()
    assert sorted((r.l_ts_ms // 1000, r.r_ts_ms // 1000) for r in out) == \
        [(20, -11), (20, 4), (80, 4), (80, 80)]


def test_window_join_golden(spark):
    rows = [("a", 1000), ("a", 2000), ("b", 1000), ("b", 2000)]
    s = spark.createDataFrame(rows, "key string, ts_ms long").withColumn(
        "ts", F.timestamp_millis("ts_ms"))
    out = joins.window_join(s, s, "key", "5 seconds").collect()
    assert len(out) == 8
    assert sum(r.key == "a" for r in out) == 4


def test_interval_join_against_brute_force(spark):
    e = tb.load_table(spark, SF_SMALL, "events")
    c = e.where("event_type = 'click'").select("user_id", "ts", "event_id")
    v = e.where("event_type = 'view'").select("user_id", "ts", "event_id")
    for lo, hi, bucket in (("-90 minutes", "0 seconds", None), ("-1 day", "2 hours", None),
                           ("-1 day", "2 hours", "10 minutes"), ("10 minutes", "5 hours", None)):
        got = joins.interval_join(c, v, "user_id", lo, hi, lcols=["event_id"],
                                  rcols=["event_id"], bucket=bucket)
        lo_e, hi_e = F.expr("INTERVAL " + lo), F.expr("INTERVAL " + hi)
        cc, vv = c.alias("c"), v.alias("v")
        want = cc.join(vv, (F.col("c.user_id") == F.col("v.user_id")) &
                       (F.col("v.ts") >= F.col("c.ts") + lo_e) &
                       (F.col("v.ts") <= F.col("c.ts") + hi_e)).select(
            F.col("c.event_id"), F.col("v.event_id"))
        g = sorted((r.l_event_id, r.r_event_id) for r in got.collect())
        w = sorted(tuple(r) for r in want.collect())
        assert g == w, (lo, hi, bucket)


def test_interval_join_zero_width_range(spark):
    rows = [("k", 1000), ("k", 2000), ("k", 2000), ("j", 2000)]
    s = spark.createDataFrame(rows, "key string, ts_ms long").withColumn(
        "ts", F.timestamp_millis("ts_ms"))
    out = joins.interval_join(s, s, "key", "0 seconds", "0 seconds", lcols=["ts_ms"],
                              rcols=["ts_ms"]).collect()
    # equal key and equal time only: 1 pair at 1 s, 2 x 2 pairs at 2 s for k, 1 for j
    assert len(out) == 1 + 4 + 1
    assert all(r.l_ts_ms == r.r_ts_ms for r in out)
