"""Batch/stream parity: the same operators on a file-source stream (several files, one per
micro-batch, ``availableNow``) give the batch answer. A far-future sentinel row closes the last
event-time windows where needed (a finished ``availableNow`` run does not flush open windows)."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES, SF_SMALL
from ledgerflow import streaming as S
from ledgerflow.functions.parse import classify_dc, recognised
from ledgerflow.operators import behavior, flows, joins, lateness
from ledgerflow.schemas import ORDER_EVENT
from ledgerflow.sources import tables as tb
from ledgerflow.sources.feeds import read_csv_feed, read_lines


def _chunks(df, order_col, n):
    """Split ``df`` into ``n`` consecutive chunks of ``order_col``."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    step = (hi - lo) // n + 1
    return [df.where((F.col(order_col) >= lo + i * step) & (F.col(order_col) < lo + (i + 1) * step))
            for i in range(n)]


_SEEN: dict[str, list[str]] = {}


def _write_files(chunks, path, fmt="parquet"):
    """Write each chunk as one new file. The file source reads files oldest first, so new files
    get distinct, increasing mtimes in write order: each micro-batch is one chunk, in order."""
    seen = _SEEN.setdefault(path, [])
    for c in chunks:
        getattr(c.coalesce(1).write.mode("append"), fmt)(path)
        for f in sorted(os.listdir(path)):
            full = os.path.join(path, f)
            if f.startswith((".", "_")) or not os.path.isfile(full) or full in seen:
                continue
            seen.append(full)
            t = 1_600_000_000 + len(seen)
            os.utime(full, (t, t))


def test_order_pattern_stream_on_order_log(spark, scratch):
    lines = spark.read.text(os.path.join(FIXTURES, "order_log.csv")).collect()
    src = os.path.join(scratch, "orders")
    os.makedirs(src)
    # four files in arrival order, then a sentinel far in the future that closes everything
    for i in range(4):
        with open(os.path.join(src, f"part-{i}.csv"), "w") as f:
            f.write("\n".join(r.value for r in lines[i * 20:(i + 1) * 20]) + "\n")
    with open(os.path.join(src, "part-9.csv"), "w") as f:
        f.write("-1,create,,1600000000\n")
    for i, name in enumerate(sorted(os.listdir(src))):
        os.utime(os.path.join(src, name), (1_600_000_000 + i, 1_600_000_000 + i))
    raw = read_csv_feed(spark, src, ORDER_EVENT, streaming=True, max_files_per_trigger=1)
    o = raw.select("order_id", "event_type", F.timestamp_seconds("event_time").alias("ts"),
                   (F.col("event_time") * 1000 + F.col("order_id") % 1000).alias("seq"))
    out = S.order_pattern_stream(o, within="15 minutes")
    q = S.start(out, "orders_stream", checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    rows = [r for r in spark.sql("SELECT * FROM orders_stream").collect() if r.order_id != -1]
    paid = [r for r in rows if r.result == "payed successfully"]
    tout = sorted(r.order_id for r in rows if r.result == "timeout")
    assert len(paid) == 37 and tout == [34756, 34767]


def test_dc_statistics_per_batch_sums_add_up(spark, scratch):
    e = tb.load_table(spark, SF_SMALL, "events")
    dc = tb.events_as_dc(e)
    data = F.struct(*[F.col(a).alias(b) for a, b in (
        ("act_nbr", "BTSACTNBR"), ("ccy_cod", "BTSCCYNBR"), ("brn", "BTSBRNGLG"),
        ("reg_tim", "BTSREGTIM"), ("trs_amt", "BTSTRSAMT"), ("code", "BTSTXTC2G"))])
    js = dc.select("seq", F.to_json(F.struct(F.lit("DigitCurrency").alias("type"),
                                             F.col("reg_tim").alias("send_time"),
                                             data.alias("data"))).alias("value"))
    src = os.path.join(scratch, "dc")
    _write_files([c.select("value") for c in _chunks(js, "seq", 3)], src, "text")
    bad = ('{"type":"DigitCurrency","data":{"BTSACTNBR":"1","BTSCCYNBR":"1","BTSBRNGLG":"1",'
           '"BTSREGTIM":"not a time","BTSTRSAMT":"5","BTSTXTC2G":"N7CP"}}')
    _write_files([spark.createDataFrame([(bad,), ("garbage",)], "value string")], src, "text")
    out = os.path.join(scratch, "dc_out")
    q = S.dc_statistics(read_lines(spark, src, streaming=True, max_files_per_trigger=1), out,
                        checkpoint=os.path.join(scratch, "ck"), trigger="availableNow",
                        as_cells=False)
    q.awaitTermination()
    per_batch = spark.read.parquet(out)
    # the fourth batch holds only bad rows: its net flow is empty
    assert per_batch.select("batch_id").distinct().count() == 3
    rejects = spark.read.parquet(os.path.join(out, "_rejects"))
    # every line is booked, rejected with its text, or has a code that is not booked
    assert sorted(r.value for r in rejects.collect()) == sorted(["garbage", bad])
    lines = spark.read.text(src).count()
    booked = classify_dc(dc)
    assert lines == (recognised(booked).count() + booked.where("direction IS NULL").count()
                     + rejects.count())
    got = per_batch.groupBy(*flows.NET_KEYS).agg(F.sum("sum_amt").alias("s"))
    want = flows.dc_net_flow(classify_dc(dc)).select(*flows.NET_KEYS, F.col("sum_amt").alias("s"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_uv_stream_matches_batch_on_closed_windows(spark, scratch):
    v = tb.load_table(spark, SF_SMALL, "events").where("event_type = 'view'").select(
        "ts", "user_id", "event_id")
    src = os.path.join(scratch, "views")
    _write_files(_chunks(v, "event_id", 4), src)
    sentinel = spark.createDataFrame([(10 ** 9, -1)], "event_id long, user_id long").select(
        F.lit("2030-01-01").cast("timestamp_ntz").alias("ts"), "user_id", "event_id")
    _write_files([sentinel], src)
    stream = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.start(S.uv_distinct_stream(stream, "ts", "user_id", "1 hour"), "uv_stream",
                checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = {r.window_start: r.uv for r in spark.sql("SELECT * FROM uv_stream").collect()}
    want = {r.window_start: r.uv for r in behavior.uv_exact(S.event_time(v), "ts", "user_id",
                                                            "1 hour").collect()}
    assert got == want
    stream = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.start(S.uv_bitmap_stream(stream, "ts", "user_id", "1 hour"), "uvb_stream",
                checkpoint=os.path.join(scratch, "ck_bitmap"))
    q.awaitTermination()
    got = {r.window_start: r.uv for r in spark.sql("SELECT * FROM uvb_stream").collect()}
    want = {r.window_start: r.uv for r in behavior.uv_bitmap(S.event_time(v), "ts", "user_id",
                                                             "1 hour").collect()}
    assert got == want


def test_interval_join_stream_matches_batch(spark, scratch):
    e = tb.load_table(spark, SF_SMALL, "events")
    c = e.where("event_type = 'click'").select("user_id", "ts", "event_id")
    v = e.where("event_type = 'view'").select("user_id", "ts", "event_id")
    lsrc, rsrc = os.path.join(scratch, "l"), os.path.join(scratch, "r")
    _write_files(_chunks(c, "event_id", 3), lsrc)
    _write_files(_chunks(v, "event_id", 3), rsrc)
    ls = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(lsrc)
    rs = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 1).parquet(rsrc)
    j = S.interval_join_stream(ls, rs, "user_id", "-1 day", "0 seconds", delay="2 days",
                               lcols=["event_id"], rcols=["event_id"])
    q = S.start(j, "ij_stream", checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = sorted((r.l_event_id, r.r_event_id) for r in spark.sql("SELECT * FROM ij_stream").collect())
    want = sorted((r.l_event_id, r.r_event_id) for r in joins.interval_join(
        c, v, "user_id", "-1 day", "0 seconds", lcols=["event_id"], rcols=["event_id"]).collect())
    assert got == want and len(want) > 0


@pytest.mark.parametrize("ts_type", ["timestamp_ntz", "timestamp"])
def test_late_split_batches_replay_safe(spark, scratch, ts_type):
    e = tb.load_table(spark, SF_SMALL, "events")
    d = e.select("event_id", "event_type", F.when(F.col("event_id") % 4 == 0,
                 F.col("ts") - F.expr("INTERVAL 2 HOURS")).otherwise(F.col("ts"))
                 .cast(ts_type).alias("ets"))
    src = os.path.join(scratch, "late_in")
    _write_files(_chunks(d, "event_id", 4), src)
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(scratch, "late_out")
    q = S.late_split_batches(stream, "ets", "event_id", "1 hour", out,
                             checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = {r.event_id for r in spark.read.parquet(os.path.join(out, "late")).collect()}
    _, late = lateness.late_split(d, "ets", "event_id", "1 hour")
    assert got == {r.event_id for r in late.collect()}
    n_on = spark.read.parquet(os.path.join(out, "on_time")).count()
    assert n_on + len(got) == d.count()


def test_offset_ledger_sink(spark, scratch):
    e = tb.load_table(spark, SF_SMALL, "events").select(
        F.lit("events").alias("topic"), (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"))
    src = os.path.join(scratch, "offs")
    chunks = _chunks(e, "offset", 2)
    _write_files([chunks[0], chunks[1], chunks[0]], src)  # third file replays the first
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(scratch, "ledger")
    S.offset_ledger_sink(stream, out, checkpoint=os.path.join(scratch, "ck")).awaitTermination()
    led = spark.read.parquet(out)
    last = led.agg(F.max("batch_id")).first()[0]
    got = sorted(tuple(r) for r in led.where(F.col("batch_id") == last)
                 .select("topic", "partition", "next_offset").collect())
    want = sorted(tuple(r) for r in e.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("n")).collect())
    assert got == want


def test_running_total_stream_final_state(spark, scratch):
    tx = classify_dc(tb.events_as_dc(tb.load_table(spark, SF_SMALL, "events")))
    keys = ["act_nbr", "ccy_cod", "brn"]
    win = flows.dc_window_inout(tx, "1 hour", time_col="ts", keys=keys)
    src = os.path.join(scratch, "win")
    win.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(win.schema).parquet(src)
    q = S.start(S.running_total_stream(stream, keys), "rt_stream", mode="update",
                checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = {tuple(r[k] for k in keys): r.cum_net for r in spark.sql("SELECT * FROM rt_stream").collect()}
    fin = flows.dc_running_total(win, keys=keys).groupBy(*keys).agg(
        F.max_by("cum_net", "window_end").alias("n"))
    want = {tuple(r[k] for k in keys): r.n for r in fin.collect()}
    assert got == want


def test_fc_statistics_rereads_exclusions_each_batch_and_restarts(spark, scratch):
    """The exclusion list is read inside every micro-batch: a change between runs is seen by the
    next batch, and the second run resumes from the checkpoint (only the new file is processed)."""
    def fc_line(act, ccy, amt, d):
        return ('{"type":"FCData","send_time":"2021-06-03","data":{"ACT_NBR":"%s","CCY_NBR":"%s",'
                '"TRX_AMT":"%s","BOK_DIR":"%s"}}' % (act, ccy, amt, d))
    src, excl_path = os.path.join(scratch, "fc"), os.path.join(scratch, "excl")
    out, ck = os.path.join(scratch, "fc_out"), os.path.join(scratch, "ck")
    lines = [fc_line("a1", "10", "5", "+"), fc_line("a2", "10", "7", "+"), fc_line("a2", "10", "1", "-")]
    _write_files([spark.createDataFrame([(x,) for x in lines], "value string")], src, "text")
    spark.createDataFrame([("a1", "10")], "act_nbr string, ccy_cod string").write.mode(
        "overwrite").parquet(excl_path)

    def run():
        q = S.fc_statistics(read_lines(spark, src, streaming=True, max_files_per_trigger=1),
                            lambda s: s.read.parquet(excl_path), out, checkpoint=ck,
                            trigger="availableNow")
        q.awaitTermination()

    run()
    b0 = {(r.act_nbr, r.dir): r.amt for r in spark.read.parquet(out).where("batch_id = 0").collect()}
    assert ("a1", "+") not in b0 and b0[("a2", "+")] == 7

    spark.createDataFrame([("a2", "10")], "act_nbr string, ccy_cod string").write.mode(
        "overwrite").parquet(excl_path)
    _write_files([spark.createDataFrame([(x,) for x in lines], "value string")], src, "text")
    run()
    res = spark.read.parquet(out)
    assert sorted(r.batch_id for r in res.select("batch_id").distinct().collect()) == [0, 1]
    b1 = {(r.act_nbr, r.dir): r.amt for r in res.where("batch_id = 1").collect()}
    assert b1 == {("a1", "+"): 5}


def test_window_apply_extension_point(spark):
    from ledgerflow.operators.custom import window_apply
    e = tb.load_table(spark, SF_SMALL, "events").select("user_id", "ts", "value")

    def spread(pdf):
        return pdf.groupby(["user_id", "window_start"], as_index=False).agg(
            spread=("value", lambda s: float(s.max() - s.min())))

    got = window_apply(e, ["user_id"], "ts", "1 day", spread,
                       "user_id long, window_start timestamp_ntz, spread double")
    want = e.groupBy("user_id", F.window("ts", "1 day").start.alias("window_start")).agg(
        (F.max("value") - F.min("value")).alias("spread"))
    assert sorted((r.user_id, r.window_start, round(r.spread, 6)) for r in got.collect()) == \
        sorted((r.user_id, r.window_start, round(r.spread, 6)) for r in want.collect())


def test_sliding_count_stream_matches_batch_on_closed_windows(spark, scratch):
    m = tb.events_as_marketing(tb.load_table(spark, SF_SMALL, "events")).where(
        "behavior <> 'error'").select("ts", "channel", "behavior", "seq")
    src = os.path.join(scratch, "mk")
    _write_files(_chunks(m, "seq", 3), src)
    sentinel = spark.createDataFrame([(10 ** 9,)], "seq long").select(
        F.lit("2030-01-01").cast("timestamp_ntz").alias("ts"), F.lit("x").alias("channel"),
        F.lit("x").alias("behavior"), "seq")
    _write_files([sentinel], src)
    stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.start(S.sliding_count_stream(stream, "ts", "1 hour", "10 minutes", ["channel", "behavior"]),
                "mk_stream", checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.sql(
        "SELECT window_start, channel, behavior, count FROM mk_stream WHERE channel <> 'x'").collect())
    want = sorted(tuple(r) for r in behavior.sliding_counts(
        S.event_time(m), "ts", "1 hour", "10 minutes", ["channel", "behavior"]).select(
        "window_start", "channel", "behavior", "count").collect())
    assert got == want and len(want) > 0


def test_window_inout_stream_matches_batch(spark, scratch):
    tx = classify_dc(tb.events_as_dc(tb.load_table(spark, SF_SMALL, "events")))
    keys = ["act_nbr", "ccy_cod", "brn"]
    src = os.path.join(scratch, "tx")
    cols = ["seq", "ts", "act_nbr", "ccy_cod", "brn", "direction", "signed_amt"]
    _write_files([c.select(*cols) for c in _chunks(tx, "seq", 3)], src)
    sentinel = tx.limit(1).select(F.lit(10 ** 9).cast("long").alias("seq"),
                                  F.lit("2030-01-01").cast("timestamp_ntz").alias("ts"),
                                  F.lit("x").alias("act_nbr"), "ccy_cod", "brn", "direction",
                                  "signed_amt")
    _write_files([sentinel], src)
    stream = spark.readStream.schema(tx.select(*cols).schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.start(S.window_inout_stream(stream, "1 hour", keys=keys), "win_stream",
                checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.sql(
        "SELECT window_start, act_nbr, ccy_cod, brn, in_amt, out_amt FROM win_stream "
        "WHERE act_nbr <> 'x'").collect())
    want = sorted(tuple(r) for r in flows.dc_window_inout(S.event_time(tx), "1 hour", time_col="ts",
                                                          keys=keys).select(
        "window_start", *keys, "in_amt", "out_amt").collect())
    assert got == want and len(want) > 0


def test_window_join_stream_matches_batch(spark, scratch):
    e = tb.load_table(spark, SF_SMALL, "events")
    c = e.where("event_type = 'click'").select("user_id", "ts", "event_id")
    v = e.where("event_type = 'view'").select("user_id", "ts", "event_id")
    lsrc, rsrc = os.path.join(scratch, "l"), os.path.join(scratch, "r")
    _write_files(_chunks(c, "event_id", 3), lsrc)
    _write_files(_chunks(v, "event_id", 3), rsrc)
    ls = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(lsrc)
    rs = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 1).parquet(rsrc)
    j = S.window_join_stream(ls, rs, "user_id", "1 day", delay="1 day", lcols=["event_id"],
                             rcols=["event_id"])
    q = S.start(j, "wj_stream", checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = sorted((r.l_event_id, r.r_event_id) for r in spark.sql("SELECT * FROM wj_stream").collect())
    want = sorted((r.l_event_id, r.r_event_id) for r in joins.window_join(
        c, v, "user_id", "1 day", lcols=["event_id"], rcols=["event_id"]).collect())
    assert got == want and len(want) > 0


def test_replayed_batch_rewrites_its_output(spark, scratch):
    """Drop the last commit marker so Spark re-runs that batch on restart: the batch's folder is
    rewritten with the same rows, nothing is added."""
    e = tb.load_table(spark, SF_SMALL, "events")
    d = e.select("event_id", "event_type", "ts")
    src = os.path.join(scratch, "in")
    _write_files(_chunks(d, "event_id", 3), src)
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    def run():
        stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = S.late_split_batches(stream, "ts", "event_id", "1 hour", out, checkpoint=ck)
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    def snapshot():
        return sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "on_time")).collect())

    run()
    first = snapshot()
    commits = sorted(int(f) for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit())
    for name in (str(commits[-1]), f".{commits[-1]}.crc"):
        if os.path.exists(os.path.join(ck, "commits", name)):
            os.remove(os.path.join(ck, "commits", name))
    replayed = run()
    assert replayed > 0  # the last batch really ran again
    assert snapshot() == first and len(first) == d.count()


def test_running_average_stream_matches_batch(spark, scratch):
    marks = tb.events_as_marks(tb.load_table(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "marks")
    _write_files(_chunks(marks, "seq", 3), src)
    stream = spark.readStream.schema(marks.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.start(S.running_average_stream(stream, threshold=80), "marks_stream",
                checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = spark.sql("SELECT * FROM marks_stream")
    avgs = behavior.running_average(marks)
    assert sorted(tuple(r) for r in got.select("name", "seq", "run_sum", "count", "avg_mark")
                  .collect()) == sorted(tuple(r) for r in avgs.collect())
    fired = sorted((r.name, r.segment, r.seq) for r in got.where("fire = 1").collect())
    want = sorted((r.name, r.segment, r.seq) for r in behavior.purge_segments(avgs).collect())
    assert fired == want and len(want) > 0


def test_window_aggregate_stream_update_and_append(spark, scratch):
    from ledgerflow.operators import triggers
    dev = tb.events_as_devices(tb.load_table(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "dev")
    _write_files(_chunks(dev, "seq", 3), src)
    sentinel = dev.limit(1).select(F.lit("x").alias("id"), "value",
                                   F.lit("2030-01-01").cast("timestamp_ntz").alias("ts"),
                                   F.lit(10 ** 9).cast("long").alias("seq"))
    _write_files([sentinel], src)
    final = triggers.early_firing(dev, "id", "ts", "1 day", "6 hours").where("fire_kind = 'final'")
    want = sorted((r.id, r.window_start, r.cum_count, r.cum_sum, r.cum_max) for r in final.collect())
    for mode in ("update", "append"):
        stream = spark.readStream.schema(dev.schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = S.start(S.window_aggregate_stream(stream, "id", "ts", "1 day", seq="seq"), f"agg_{mode}",
                    mode=mode, checkpoint=os.path.join(scratch, f"ck_{mode}"))
        q.awaitTermination()
        rows = spark.sql(f"SELECT * FROM agg_{mode} WHERE id <> 'x'").collect()
        last = {}
        for r in rows:  # update mode: the latest (largest) emission per window is the final one
            k = (r.id, r.window_start)
            if k not in last or r.cum_count >= last[k][0]:
                last[k] = (r.cum_count, r.cum_sum, r.cum_max)
        got = sorted((k[0], k[1], *v) for k, v in last.items())
        assert got == want, mode
        if mode == "append":
            mx = {(r.id, r.window_start): r.max_seq for r in rows}
            wmx = {(r.id, r.window_start): r.seq for r in behavior.window_max_by(
                dev, "id", "ts", "1 day").collect()}
            assert mx == wmx


def test_windowed_running_totals_as_one_streaming_job(spark, scratch):
    """Windowed in/out on the stream, then per-key running totals per window result."""
    tx = classify_dc(tb.events_as_dc(tb.load_table(spark, SF_SMALL, "events")))
    keys = ["act_nbr", "ccy_cod", "brn"]
    cols = ["seq", "ts", "act_nbr", "ccy_cod", "brn", "direction", "signed_amt"]
    src = os.path.join(scratch, "tx")
    _write_files([c.select(*cols) for c in _chunks(tx, "seq", 3)], src)
    sentinel = tx.limit(1).select(F.lit(10 ** 9).cast("long").alias("seq"),
                                  F.lit("2030-01-01").cast("timestamp_ntz").alias("ts"),
                                  F.lit("x").alias("act_nbr"), "ccy_cod", "brn", "direction",
                                  "signed_amt")
    _write_files([sentinel], src)
    stream = spark.readStream.schema(tx.select(*cols).schema).option("maxFilesPerTrigger", 1).parquet(src)
    win = S.window_inout_stream(stream, "1 hour", keys=keys)
    out = os.path.join(scratch, "rt")
    S.cumulative_sink(win, keys, "window_end", ["in_amt", "out_amt"], out,
                      checkpoint=os.path.join(scratch, "ck")).awaitTermination()
    got = sorted((r.act_nbr, r.ccy_cod, r.brn, r.window_end, r.cum_in_amt, r.cum_out_amt)
                 for r in spark.read.parquet(os.path.join(out, "emitted")).collect()
                 if r.act_nbr != "x")
    bw = flows.dc_window_inout(S.event_time(tx), "1 hour", time_col="ts", keys=keys)
    want = sorted((r.act_nbr, r.ccy_cod, r.brn, r.window_end, r.cum_in, r.cum_out)
                  for r in flows.dc_running_total(bw, keys=keys).collect())
    assert got == want and len(want) > 0


def test_act_rules_on_a_stream(spark, scratch):
    """Split by type, per-branch rules, merge of the rejected rows: stateless, runs as is."""
    from ledgerflow.operators import routing
    act = tb.lineitem_as_act(tb.load_table(spark, SF_SMALL, "lineitem"))
    src = os.path.join(scratch, "act")
    _write_files(_chunks(act, "l_orderkey", 2), src)
    stream = spark.readStream.schema(act.schema).option("maxFilesPerTrigger", 1).parquet(src)

    def rejected(df):
        routed = routing.route(df, {"kpp": F.col("typ") == "kpp", "kqp": F.col("typ") == "kqp"})
        return routing.rule_decision(routed.where("branch <> 'other'")).where("out_typ = 'del'")

    q = S.start(rejected(stream).select("l_orderkey", "l_linenumber"), "act_stream",
                checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM act_stream").collect())
    want = sorted(tuple(r) for r in rejected(act).select("l_orderkey", "l_linenumber").collect())
    assert got == want and len(want) > 0


def test_processing_time_tumbling_sum_stream(spark, scratch):
    """Processing-time windows (proc_ts stamped per micro-batch), unmatched codes kept as one
    zero group: per key, the window sums add up to the batch totals."""
    from ledgerflow.operators.custom import with_processing_time
    tx = classify_dc(tb.events_as_dc(tb.load_table(spark, SF_SMALL, "events")))
    cols = ["seq", "ts", "date", "time", "ccy_cod", "brn", "direction", "signed_amt"]
    src = os.path.join(scratch, "tx")
    _write_files([c.select(*cols) for c in _chunks(tx, "seq", 2)], src)
    stream = spark.readStream.schema(tx.select(*cols).schema).option("maxFilesPerTrigger", 1).parquet(src)
    agg = flows.dc_tumbling_sum(with_processing_time(stream), "2 seconds", keep_unmatched=True)
    # complete mode: the memory sink holds the whole result table after the last batch
    q = S.start(agg, "proc_stream", mode="complete", checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = spark.sql("SELECT date, time, ccy_cod, brn, direction, sum(amt) AS s FROM proc_stream "
                    "GROUP BY ALL")
    keys = [F.when(F.col("direction").isNotNull(), F.col(c)).alias(c)
            for c in ("date", "time", "ccy_cod", "brn")]
    want = tx.groupBy(*keys, "direction").agg(F.sum("signed_amt").alias("s"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_count_trigger_stream_matches_batch(spark, scratch):
    from ledgerflow.operators import triggers
    dev = tb.events_as_devices(tb.load_table(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "dev")
    _write_files(_chunks(dev, "seq", 3), src)
    stream = spark.readStream.schema(dev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.start(S.count_trigger_stream(stream, "id", "ts", "1 day", n=2), "ct_stream",
                checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    cols = ["id", "fire_no", "cum_count", "cum_sum", "cum_max"]
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM ct_stream").select(*cols).collect())
    want = sorted(tuple(r) for r in triggers.count_firing(dev, "id", "ts", "1 day", n=2)
                  .select(*cols).collect())
    assert got == want and len(want) > 0


def test_window_contents_stream_matches_batch(spark, scratch):
    dev = tb.events_as_devices(tb.load_table(spark, SF_SMALL, "events"))
    src = os.path.join(scratch, "dev")
    _write_files(_chunks(dev, "seq", 3), src)
    stream = spark.readStream.schema(dev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.start(S.window_contents_stream(stream, "id", "ts", "1 day"), "wc_stream",
                checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.sql("SELECT id, pos, seq, value FROM wc_stream").collect())
    want = sorted(tuple(r) for r in behavior.window_contents(dev, "id", "ts", "1 day").select(
        "id", "pos", "seq", "value").collect())
    assert got == want and len(want) == dev.count()


def test_command_line_dc_statistics(spark, scratch):
    from ledgerflow.__main__ import main
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)
    from test_parse import DC_IN, DC_OUT
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(DC_OUT + "\n" + DC_IN + "\n")
    assert main(["dc-statistics", "--path", src, "--out", out, "--trigger", "availableNow",
                 "--checkpoint", os.path.join(scratch, "ck")]) == 0
    cells = {r.qualifier: r.value for r in spark.read.parquet(out).collect()}
    assert cells["sumAmt"] == "20000.00" and cells["outAmt"] == "-20000.00"


def test_uv_first_sight_stream_matches_batch(spark, scratch):
    v = tb.load_table(spark, SF_SMALL, "events").where("event_type = 'view'").select(
        "ts", "user_id", F.col("event_id").alias("seq"))
    src = os.path.join(scratch, "views")
    _write_files(_chunks(v, "seq", 3), src)
    stream = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = S.start(S.uv_first_sight_stream(stream, "ts", "user_id", "1 hour"), "ufs_stream",
                checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    got = sorted((r.seq, r.uv) for r in spark.sql("SELECT * FROM ufs_stream").collect())
    run = behavior.uv_running(v, "ts", "user_id", "1 hour")
    firsts = run.groupBy("window_start", "user_id").agg(F.min("seq").alias("seq"))
    want = sorted((r.seq, r.uv) for r in run.join(firsts, ["window_start", "user_id", "seq"])
                  .collect())
    assert got == want and len(want) > 0


def test_command_line_orders_on_order_log(spark, scratch):
    import shutil

    from ledgerflow.__main__ import main
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)
    shutil.copy(os.path.join(FIXTURES, "order_log.csv"), src)
    assert main(["orders", "--path", src, "--out", out, "--trigger", "availableNow",
                 "--checkpoint", os.path.join(scratch, "ck")]) == 0
    res = spark.read.parquet(out)
    assert res.where("result = 'payed successfully'").count() == 37
    assert sorted(r.order_id for r in res.where("result = 'timeout'").collect()) == [34756, 34767]


def _open_window_feed(spark, scratch):
    """Four batches out of order inside one open window, one row each, after a row far ahead."""
    src = os.path.join(scratch, "ooo")
    secs = [50, 10, 55, 20, 30]
    rows = [spark.createDataFrame([(f"k{s % 2}", s, i, Decimal("1.125"))],
                                  "id string, sec int, seq long, value decimal(18,3)")
            .select("id", F.timestamp_seconds("sec").alias("ts"), "seq", "value")
            for i, s in enumerate(secs)]
    _write_files(rows, src)
    return spark.readStream.schema(rows[0].schema).option("maxFilesPerTrigger", 1).parquet(src), len(secs)


def test_rows_of_open_windows_are_all_counted(spark, scratch):
    stream, n = _open_window_feed(spark, scratch)
    S.start(S.count_trigger_stream(stream, "id", "ts", "1 minute", n=1), "open_ct",
            checkpoint=os.path.join(scratch, "c1")).awaitTermination()
    S.start(S.window_contents_stream(stream, "id", "ts", "1 minute"), "open_wc",
            checkpoint=os.path.join(scratch, "c2")).awaitTermination()
    S.start(S.window_aggregate_stream(stream, "id", "ts", "1 minute"), "open_agg", mode="complete",
            checkpoint=os.path.join(scratch, "c3")).awaitTermination()
    total = spark.sql("SELECT sum(cum_count) AS n FROM open_agg").first().n
    assert total == n
    assert spark.sql("SELECT * FROM open_ct").count() == n
    contents = spark.sql("SELECT * FROM open_wc")
    assert contents.count() == n and {str(r.value) for r in contents.collect()} == {"1.125"}
    assert spark.sql("SELECT max(cum_sum) AS s FROM open_ct WHERE cum_count = 3").first().s == Decimal("3.375")


def test_damaged_previous_output_fails_the_batch(spark, scratch):
    """The mark, the ledger and any other carried table: an unreadable folder is an error, never a
    fresh start."""
    from ledgerflow.streaming.runners import _previous_output
    root = os.path.join(scratch, "marks")
    assert _previous_output(spark, root, 0) is None
    spark.range(1).write.parquet(os.path.join(root, "batch_id=0"))
    assert _previous_output(spark, root, 1).count() == 1
    with pytest.raises(Exception):
        _previous_output(spark, root, 5)
    bad = os.path.join(root, "batch_id=6")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("damaged")
    with pytest.raises(Exception):
        _previous_output(spark, root, 7).count()


def test_marks_with_three_decimals_fire(spark, scratch):
    src = os.path.join(scratch, "m3")
    rows = [("a", 1, Decimal("80.004")), ("b", 1, Decimal("79.996")), ("a", 2, Decimal("79.990"))]
    df = spark.createDataFrame(rows, "name string, seq long, mark decimal(18,3)")
    _write_files([df], src)
    for scale in ("decimal(18,3)", "double"):
        batch = df.withColumn("mark", F.col("mark").cast(scale))
        seg = behavior.purge_segments(behavior.running_average(batch), threshold=80).collect()
        assert [(r.name, r.seq) for r in seg] == [("a", 1)]
        own = behavior.purge_segments(behavior.running_average(batch),
                                      condition=F.col("count") == 2).collect()
        assert [(r.name, r.seq) for r in own] == [("a", 1)]
        stream = spark.readStream.schema(df.schema).parquet(src).withColumn(
            "mark", F.col("mark").cast(scale))
        name = "m3_" + scale[:3]
        S.start(S.running_average_stream(stream, threshold=80.0), name,
                checkpoint=os.path.join(scratch, name)).awaitTermination()
        got = sorted((r.name, r.seq, r.fire) for r in spark.sql(f"SELECT * FROM {name}").collect())
        assert got == [("a", 1, 1), ("a", 2, 0), ("b", 1, 0)]


def test_counter_upsert_keeps_the_last_value(spark, scratch):
    stream, n = _open_window_feed(spark, scratch)
    agg = stream.groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("n"))
    out = os.path.join(scratch, "cnt")
    S.upsert_sink(agg.select(F.col("w.end").alias("window_end"), "n"), ["window_end"], out,
                  checkpoint=os.path.join(scratch, "ck")).awaitTermination()
    rows = S.latest(spark, out, ["window_end"]).collect()
    assert [r.n for r in rows] == [n]


def test_pattern_stream_with_text_keys_and_late_rows(spark, scratch):
    src = os.path.join(scratch, "txt")
    def one(*r):
        return spark.createDataFrame([r], "order_id string, event_type string, sec int, seq long").select(
            "order_id", "event_type", F.timestamp_seconds("sec").alias("ts"), "seq")
    rows = [one("ab", "create", 10, 1), one("ab", "pay", 20, 2), one("zz", "create", 9000, 3),
            one("cd", "create", 5, 4), one("zz", "pay", 99000, 5)]
    _write_files(rows, src)
    stream = spark.readStream.schema(rows[0].schema).option("maxFilesPerTrigger", 1).parquet(src)
    S.start(S.order_pattern_stream(stream, late="late"), "txt_orders",
            checkpoint=os.path.join(scratch, "ck")).awaitTermination()
    got = {(r.order_id, r.result) for r in spark.sql("SELECT * FROM txt_orders").collect()}
    assert ("ab", "payed successfully") in got and ("cd", "late") in got and ("zz", "timeout") in got


def test_first_sights_in_buckets_add_up(spark, scratch):
    views = tb.load_table(spark, SF_SMALL, "events").where("event_type = 'view'").select(
        "ts", "user_id", F.col("event_id").alias("seq"))
    src = os.path.join(scratch, "v")
    _write_files(_chunks(views, "seq", 2), src)
    stream = spark.readStream.schema(views.schema).option("maxFilesPerTrigger", 1).parquet(src)
    S.start(S.uv_first_sight_stream(stream, "ts", "user_id", "1 hour", buckets=4), "uv_buckets",
            checkpoint=os.path.join(scratch, "ck")).awaitTermination()
    got = spark.sql("SELECT window_start, sum(m) AS uv FROM (SELECT window_start, bucket, max(uv) AS m "
                    "FROM uv_buckets GROUP BY ALL) GROUP BY ALL")
    want = behavior.uv_exact(S.event_time(views), "ts", "user_id", "1 hour")
    assert {(r.window_start, r.uv) for r in got.collect()} == {
        (r.window_start, r.uv) for r in want.collect()}
