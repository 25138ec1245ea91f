"""

    python tools/bench_rewrites.py [sf_dir]      -> one JSON line {case: {variant: sec}}

Both variants of a case compute the same rows (checked by count); each is run once to warm up and
once timed, to completion with a ``noop`` write.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerflow.operators import joins, lateness, patterns  # noqa: E402
from ledgerflow.plans.panes import sliding_aggregate  # noqa: E402
from ledgerflow.session import get_session  # noqa: E402
from ledgerflow.sources import tables as tb  # noqa: E402


def timed(df):
    df.write.format("noop").mode("overwrite").save()
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3), df.count()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", app="ledgerflow-rewrites", shuffle_partitions=16)
    e = tb.load_table(spark, sf, "events")
    out = {}

    m = tb.events_as_marketing(e).where("behavior <> 'error'")
    slide = os.environ.get("SLIDE", "1 minute")
    out[f"sliding_1h_{slide.replace(' ', '')}"] = {
        v: timed(sliding_aggregate(m, "ts", "1 hour", slide, ["channel", "behavior"], **kw))
        for v, kw in (("window_expand", {"use_panes": False}), ("panes_explode", {"method": "explode"}),
                      ("panes_deltas", {"method": "deltas"}), ("panes_ranges", {"method": "ranges"}))}

    o = tb.events_as_orders(e)
    creates = o.where("event_type = 'create'").alias("c")
    pays = o.where("event_type = 'pay'").alias("p")
    later = (F.col("p.ts") > F.col("c.ts")) | ((F.col("p.ts") == F.col("c.ts")) & (F.col("p.seq") > F.col("c.seq")))
    selfjoin = (creates.join(pays, (F.col("c.order_id") == F.col("p.order_id")) & later, "left")
                .groupBy("c.order_id", "c.seq", "c.ts")
                .agg(F.min(F.struct("p.ts", "p.seq")).alias("n")))
    w = Window.partitionBy("order_id").orderBy(F.col("ts").desc(), F.col("seq").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    single = o.select("*", F.min(F.when(F.col("event_type") == "pay", F.struct("ts", "seq"))).over(w)
                      .alias("n")).where("event_type = 'create'")
    out["create_pay_12h"] = {
        "self_join": timed(selfjoin),
        "window_per_key": timed(single),
        "blocked_scan": timed(patterns.next_follow(o, "order_id", "event_type", "create", "pay",
                                                   "12 hours"))}

    d = e.select("event_id", F.when(F.col("event_id") % 4 == 0, F.col("ts") - F.expr("INTERVAL 2 HOURS"))
                 .otherwise(F.col("ts")).alias("ets"))
    wg = Window.orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    out["late_split_prefix_max"] = {
        "single_partition_window": timed(d.select("*", F.max("ets").over(wg).alias("m"))),
        "blocked_prefix": timed(lateness.with_watermark_before(d, "ets", "event_id",
                                                              block_rows=1 << 14, fanout=64))}

    c = e.where("event_type = 'click'").select("user_id", "ts", "event_id")
    v = e.where("event_type = 'view'").select("user_id", "ts", "event_id")
    cc, vv = c.alias("l"), v.alias("r")
    plain = cc.join(vv, (F.col("l.user_id") == F.col("r.user_id")) &
                    F.col("r.ts").between(F.col("l.ts") - F.expr("INTERVAL 90 MINUTES"), F.col("l.ts")))
    out["interval_join_90m"] = {
        "key_only_equi_join": timed(plain),
        "time_bucketed": timed(joins.interval_join(c, v, "user_id", "-90 minutes", "0 seconds",
                                                   lcols=["event_id"], rcols=["event_id"]))}
    print(json.dumps({"sf_dir": sf, "cases": out}))


if __name__ == "__main__":
    main()
