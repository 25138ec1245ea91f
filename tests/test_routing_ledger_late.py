from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow.operators import lateness, ledger, routing
from ledgerflow.sources import tables as tb


def test_split_partitions_every_row(spark):
    act = tb.lineitem_as_act(tb.load_table(spark, SF_SMALL, "lineitem"))
    parts = routing.split(act, {"kpp": F.col("typ") == "kpp", "kqp": F.col("typ") == "kqp"})
    n = {k: v.count() for k, v in parts.items()}
    assert sum(n.values()) == act.count() and n["other"] > 0
    dec = routing.merge(routing.rule_decision(parts["kpp"]), routing.rule_decision(parts["kqp"]))
    acc = dec.where("decision = 'keep'").count()
    rej = dec.where("out_typ = 'del'").count()
    assert acc + rej + n["other"] == act.count()
    bad = dec.where("decision = 'keep' AND NOT ((typ = 'kpp' AND dir = 'D' AND sts = '22' AND "
                    "cod = '95100') OR (typ = 'kqp' AND dir = 'C' AND cod = '95100' AND sts = '20'))")
    assert bad.count() == 0


def test_ledger_never_moves_back(spark):
    b1 = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 3)], "topic string, partition int, offset long")
    replay = spark.createDataFrame([("t", 0, 2), ("t", 2, 7)], "topic string, partition int, offset long")
    l1 = ledger.advance(None, b1)
    l2 = ledger.advance(l1, replay)
    assert sorted(map(tuple, l2.collect())) == [("t", 0, 10), ("t", 1, 4), ("t", 2, 8)]


def test_late_split_is_a_partition_and_matches_definition(spark):
    e = tb.load_table(spark, SF_SMALL, "events")
    d = e.select("event_id", "event_type", F.when(F.col("event_id") % 4 == 0,
                 F.col("ts") - F.expr("INTERVAL 2 HOURS")).otherwise(F.col("ts")).alias("ets"))
    on, late = lateness.late_split(d, "ets", "event_id", "1 hour", block_rows=16, fanout=4)
    assert on.count() + late.count() == d.count()
    # brute force in pandas
    p = d.toPandas().sort_values("event_id")
    prev_max = p["ets"].cummax().shift(1)
    end = p["ets"].dt.floor("1h") + __import__("pandas").Timedelta(hours=1)
    want = set(p.loc[(end <= prev_max).fillna(False), "event_id"])
    assert {r.event_id for r in late.collect()} == want and len(want) > 0


def test_late_split_with_delay_and_sliding(spark):
    rows = [(0, 0), (1, 12_000), (2, 4_000), (3, 9_000), (4, 30_000), (5, 14_000), (6, 5_000)]
    df = spark.createDataFrame(rows, "seq long, ts_ms long").withColumn("ts", F.timestamp_millis("ts_ms"))
    # 10 s tumbling, 2 s bounded delay: row 2 (4 s) arrives when max=12 s -> wm 10 s: late;
    # row 3 (9 s): window end 10 s, 10 s - 1 ms <= 10 s -> late; rows 5 (14 s) and 6 (5 s) come
    # after 30 s (wm 28 s) -> late.
    _, late = lateness.late_split(df, "ts", "seq", "10 seconds", delay="2 seconds")
    assert sorted(r.seq for r in late.collect()) == [2, 3, 5, 6]
    # sliding 20 s / 10 s: a row's latest window ends 20-30 s after its slide bucket; only row 6
    # (latest window [0 s, 20 s)) is behind the 28 s watermark
    _, late2 = lateness.late_split(df, "ts", "seq", "20 seconds", slide="10 seconds",
                                   delay="2 seconds")
    assert sorted(r.seq for r in late2.collect()) == [6]
