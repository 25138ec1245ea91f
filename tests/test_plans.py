import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow.plans import running, sliding_aggregate
from ledgerflow.sources import tables as tb


def _data(spark, n=3000, groups=4, seed=7):
    rnd = random.Random(seed)
    # one hot group holding about half of the rows
    rows = [(i, "hot" if rnd.random() < 0.5 else f"g{rnd.randrange(groups)}",
             rnd.randint(-50, 100), rnd.random()) for i in range(n)]
    return spark.createDataFrame(rows, "seq long, g string, v long, x double")


def test_blocked_running_equals_plain_window(spark):
    df = _data(spark)
    w = Window.partitionBy("g").orderBy("seq")
    for inclusive in (True, False):
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        want = df.select("seq", F.sum("v").over(frame).alias("s"), F.max("x").over(frame).alias("m"),
                         F.count("v").over(frame).alias("c"), F.min("v").over(frame).alias("n"))
        for fanout in (None, 3):
            got = running(df, ["g"], [F.col("seq")], F.floor(F.col("seq") / 37),
                          {"s": ("sum", "v"), "m": ("max", "x"), "c": ("count", "v"),
                           "n": ("min", "v")}, inclusive=inclusive, fanout=fanout)
            a = sorted(tuple(r) for r in got.select("seq", "s", "m", "c", "n").collect())
            b = sorted(tuple(r) for r in want.collect())
            assert a == b, (inclusive, fanout)


def test_global_prefix_max_multilevel(spark):
    df = _data(spark)
    want = df.select("seq", F.max("x").over(Window.orderBy("seq").rowsBetween(
        Window.unboundedPreceding, -1)).alias("m"))
    got = running(df, [], [F.col("seq")], F.floor(F.col("seq") / 10), {"m": ("max", "x")},
                  inclusive=False, fanout=4)
    assert sorted(tuple(r) for r in got.select("seq", "m").collect()) == \
        sorted(tuple(r) for r in want.collect())


def test_panes_equal_plain_window(spark):
    e = tb.load_table(spark, SF_SMALL, "events").withColumn(
        "cents", F.col("value").cast("decimal(18,2)"))
    # a null key must form its own group, as in groupBy
    e = e.withColumn("event_type", F.when(F.col("event_id") % 7 == 0, F.lit(None))
                     .otherwise(F.col("event_type")))
    cases = [("1 hour", "10 minutes"), ("30 minutes", "30 minutes"), ("2 hours", "45 minutes"),
             ("1 hour", "10 seconds")]
    for size, slide in cases:
        want = sliding_aggregate(e, "ts", size, slide, ["event_type"],
                                 sums={"v": F.col("value"), "c": F.col("cents")}, use_panes=False)
        rw = sorted((r.window_start, r.window_end, r.event_type or "", r["count"], round(r.v, 6), r.c)
                    for r in want.collect())
        for method in ("deltas", "explode", "ranges"):
            sums = {"c": F.col("cents")} if method == "deltas" else \
                {"v": F.col("value"), "c": F.col("cents")}
            got = sliding_aggregate(e, "ts", size, slide, ["event_type"], sums=sums, method=method)
            if method == "deltas":
                rg = sorted((r.window_start, r.window_end, r.event_type or "", r["count"], r.c)
                            for r in got.collect())
                assert rg == [(a, b, c, d, f) for a, b, c, d, _, f in rw], (size, slide, method)
            else:
                rg = sorted((r.window_start, r.window_end, r.event_type or "", r["count"],
                             round(r.v, 6), r.c) for r in got.collect())
                assert rg == rw, (size, slide, method)


def test_ranges_block_length_does_not_change_result(spark):
    e = tb.load_table(spark, SF_SMALL, "events")
    base = sliding_aggregate(e, "ts", "1 hour", "5 minutes", ["event_type"], method="deltas")
    want = sorted(tuple(r) for r in base.collect())
    for block in ("7 minutes", "30 minutes", "1 hour", "3 hours"):
        got = sliding_aggregate(e, "ts", "1 hour", "5 minutes", ["event_type"], method="ranges",
                                block=block)
        assert sorted(tuple(r) for r in got.collect()) == want, block


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_ordered_scans_read_their_input_once(spark):
    """One scan of the table and one exchange of its rows; what else is shuffled are block totals."""
    import re
    from ledgerflow import workloads
    for name in ("running_avg", "device_collect", "count_trigger", "order_pay_match", "order_pay_timeout",
                 "late_split", "late_split_delay", "on_time_counts", "purge_segments"):
        plan = _final_plan(workloads.REGISTRY[name](spark, SF_SMALL))
        assert len(re.findall(r"FileScan parquet|Scan parquet", plan)) == 1, name
        assert "ReusedExchange" in plan, name
        if name in ("running_avg", "device_collect", "count_trigger", "order_pay_match", "order_pay_timeout"):
            assert len(re.findall(r"(?<!Reused)Exchange (?:hash|range|Single)", plan)) <= 3, name


def test_hot_group_is_spread_over_its_blocks(spark):
    """No task of the scan sees more of a hot group than a few blocks of it."""
    from ledgerflow.operators import patterns
    df = spark.range(20000).select(F.lit("hot").alias("k"), F.when(F.col("id") % 3 > 0, "create").otherwise("pay").alias("kind"),
                                   F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.col("id").alias("seq"))
    n = patterns.next_follow(df, "k", "kind", "create", "pay", "2 minutes")
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:  # at this size all partitions would be merged into one task
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        per_task = n.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    assert sum(r["count"] for r in per_task) == 13333 and max(r["count"] for r in per_task) < 13333 / 3
    wrong = n.where((F.col("next_seq") != F.col("seq") + 3 - F.col("seq") % 3) & (F.col("seq") < 19998)).count()
    assert wrong == 0


def test_window_join_deals_a_hot_window_into_a_grid(spark):
    from ledgerflow.operators import joins
    left = spark.range(1200).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id") % 50).alias("k"),
                                    F.timestamp_seconds(F.when(F.col("id") < 600, 5).otherwise(F.col("id"))).alias("ts"),
                                    F.col("id").alias("a"))
    right = left.where("a % 2 = 0").withColumnRenamed("a", "b")
    right = right.unionAll(spark.sql("SELECT CAST(NULL AS bigint), timestamp_seconds(5), 7L"))
    want = joins.window_join(left, right, "k", "100 seconds", lcols=["a"], rcols=["b"], portion_rows=10 ** 9)
    got = joins.window_join(left, right, "k", "100 seconds", lcols=["a"], rcols=["b"], portion_rows=40)
    assert got.count() == want.count() > 600 * 300
    assert got.exceptAll(want).count() == 0
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        per_task = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert max(per_task) < 0.4 * sum(per_task)
