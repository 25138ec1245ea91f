"""Named queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Each reads whole tables through the feed-shaped views of :mod:`ledgerflow.sources.tables` and runs
one operator (or a short chain). The DuckDB statements in :mod:`ledgerflow.oracles` compute the same
result independently; column names are aliased identically on both sides.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.hashing import poly_hash
from .functions.parse import (DC_RENAME, IN_CODES, OUT_CODES, classify_dc, epoch_to_ts, parse_act,
                              parse_csv_lines, parse_dc, parse_devices, parse_fc, str_to_ts,
                              uuid_nodash)
from .operators import (behavior, cells, flows, joins, lateness, ledger, lookup, patterns, routing,
                        triggers)
from .schemas import MARK, ORDER_EVENT, USER_BEHAVIOR
from .session import scratch_path
from .sources import tables as tb

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register ``fn(spark, sf_dir)``. The session time zone is pinned to UTC first: the tables'
    event times are TIMESTAMP_NTZ and a few operators convert them to instants for bucketing."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir, *args, **kwargs):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir, *args, **kwargs)
        REGISTRY[name] = run
        return run
    return deco


def _events(spark, sf_dir):
    return tb.load_table(spark, sf_dir, "events")


def tx(spark: SparkSession, sf_dir: str, recognised_only: bool = False) -> DataFrame:
    """Classified DC records from ``events`` (the ``tx`` view).

    ``recognised_only=True`` (for consumers that drop unrecognised codes anyway) filters on the
    event types that map to a booked code, a predicate on a scan column that reaches parquet.
    """
    e = _events(spark, sf_dir)
    if recognised_only:
        e = e.where(F.col("event_type").isin(*tb.event_types_for(OUT_CODES + IN_CODES)))
    return classify_dc(tb.events_as_dc(e))


# ---------------------------------------------------------------- parsing
@query("parse_props")
def q_parse_props(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", tb.props_k().alias("k"))


def _envelope(kind: str, send_time, data):
    return F.to_json(F.struct(F.lit(kind).alias("type"), send_time.alias("send_time"),
                              data.alias("data"))).alias("value")


@query("src_json_lines")
def q_src_json_lines(spark, sf_dir):
    """events -> DC envelope JSON lines (all nine fields) -> parsed back with the envelope parser."""
    dc = tb.events_as_dc(_events(spark, sf_dir)).withColumns({
        "onl_bal": F.col("trs_amt"), "trs_dir": F.substring("code", 1, 1),
        "rcd_ver": (F.col("seq") % 3).cast("string")})
    data = F.struct(*[F.col(own).alias(wire) for wire, own in DC_RENAME.items()])
    return parse_dc(dc.select("seq", _envelope("DigitCurrency", F.col("reg_tim"), data)), keep=["seq"])


@query("src_fc_lines")
def q_src_fc_lines(spark, sf_dir):
    """events -> FC envelope JSON lines -> parsed back."""
    fc = tb.events_as_fc(_events(spark, sf_dir))
    data = F.struct(F.col("act_nbr").alias("ACT_NBR"), F.col("ccy_cod").alias("CCY_NBR"),
                    F.col("amt").cast("string").alias("TRX_AMT"), F.col("dir").alias("BOK_DIR"))
    return parse_fc(fc.select("seq", _envelope("FlowCenter", F.lit("now"), data)), keep=["seq"])


@query("src_act_lines")
def q_src_act_lines(spark, sf_dir):
    """lineitem -> ACT envelope JSON lines, with ``data`` as escaped JSON text -> parsed back."""
    act = tb.lineitem_as_act(tb.load_table(spark, sf_dir, "lineitem"))
    fields = {"type": "typ", "ACTNBR": "act_nbr", "CCYNBR": "ccy_nbr", "BRNGLG": "ccy_nbr",
              "REGTIM": "reg_tim", "TRSAMT": "amt", "TRSDIR": "dir", "PRDCOD": "cod",
              "RCVEAC": "rcv", "PRCSTS": "sts"}
    data = F.to_json(F.struct(*[F.col(own).cast("string").alias(wire) for wire, own in fields.items()]))
    lines = act.select("l_orderkey", "l_linenumber", _envelope("Act", F.lit("now"), data))
    return parse_act(lines, keep=["l_orderkey", "l_linenumber"])


@query("src_order_lines")
def q_src_order_lines(spark, sf_dir):
    """events -> order log CSV lines -> parsed back, with the event time from epoch seconds."""
    o = tb.events_as_orders(_events(spark, sf_dir))
    line = F.concat_ws(",", F.col("order_id").cast("string"), "event_type", F.concat(
        F.lit(" t"), F.col("seq")), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    parsed = parse_csv_lines(o.select(line.alias("value")), ORDER_EVENT)
    return parsed.withColumn("ts", epoch_to_ts("event_time", "s").cast("timestamp_ntz"))


@query("src_mark_lines")
def q_src_mark_lines(spark, sf_dir):
    """events -> ``name,mark`` lines -> parsed back, the mark as exact cents."""
    m = tb.events_as_marks(_events(spark, sf_dir))
    line = F.concat(F.col("name"), F.lit(", "), F.col("mark").cast("string"))
    return parse_csv_lines(m.select(line.alias("value")), MARK)


@query("src_device_lines")
def q_src_device_lines(spark, sf_dir):
    """events -> device CSV lines -> parsed back, with the event time from epoch milliseconds."""
    d = _devices(spark, sf_dir)
    line = F.concat_ws(", ", "id", F.col("value").cast("string"),
                       F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
    return parse_devices(d.select(line.alias("value"))).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("text_scalars")
def q_text_scalars(spark, sf_dir):
    """Time text -> timestamp, and the shape of the random identifiers."""
    e = _events(spark, sf_dir).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"),
                                      uuid_nodash().alias("u"))
    return e.select("event_id", str_to_ts("text").cast("timestamp_ntz").alias("ts"),
                    F.col("u").rlike("^[0-9a-f]{32}$").alias("is_uuid"))


@query("src_csv_lines")
def q_src_csv_lines(spark, sf_dir):
    """events -> padded CSV lines of the user-behaviour feed -> parsed back in schema order.

    user = user_id, item = event_id, category = props.k, behaviour = event type, time = epoch s.
    """
    e = _events(spark, sf_dir)
    line = F.concat_ws(",", *[F.concat(F.lit(" "), c.cast("string"), F.lit(" ")) for c in (
        F.col("user_id"), F.col("event_id"), tb.props_k(), F.col("event_type"),
        F.unix_seconds(F.col("ts").cast("timestamp")))])
    ub = parse_csv_lines(e.select(line.alias("value")), USER_BEHAVIOR)
    return ub.withColumn("ts", epoch_to_ts("timestamp", "s").cast("timestamp_ntz"))


@query("tx_signed")
def q_tx_signed(spark, sf_dir):
    return tx(spark, sf_dir).select("seq", "act_nbr", "ccy_cod", "brn", "date", "time", "code",
                                     "direction", "amt", "signed_amt")


# ---------------------------------------------------------------- money flows
@query("dc_direction_sum")
def q_dc_direction_sum(spark, sf_dir):
    return flows.dc_direction_sum(tx(spark, sf_dir, recognised_only=True))


@query("dc_net_flow")
def q_dc_net_flow(spark, sf_dir):
    return flows.dc_net_flow(tx(spark, sf_dir, recognised_only=True))


@query("dc_cells")
def q_dc_cells(spark, sf_dir):
    return cells.to_cells(flows.dc_net_flow(tx(spark, sf_dir, recognised_only=True)), flows.NET_KEYS)


@query("dc_tumbling_sum")
def q_dc_tumbling_sum(spark, sf_dir):
    return flows.dc_tumbling_sum(tx(spark, sf_dir, recognised_only=True), "1 hour", time_col="ts")


@query("dc_tumbling_unmatched")
def q_dc_tumbling_unmatched(spark, sf_dir):
    """As dc_tumbling_sum, keeping unrecognised codes as one null-key group per window with sum 0."""
    return flows.dc_tumbling_sum(tx(spark, sf_dir), "1 hour", time_col="ts", keep_unmatched=True)


WINDOW_ACCOUNT_KEYS = ("act_nbr", "ccy_cod", "brn")


@query("dc_window_inout")
def q_dc_window_inout(spark, sf_dir):
    return flows.dc_window_inout(tx(spark, sf_dir, recognised_only=True), "1 hour", time_col="ts",
                                 keys=WINDOW_ACCOUNT_KEYS)


@query("dc_running_total")
def q_dc_running_total(spark, sf_dir):
    win = flows.dc_window_inout(tx(spark, sf_dir, recognised_only=True), "1 hour", time_col="ts",
                                keys=WINDOW_ACCOUNT_KEYS)
    return flows.dc_running_total(win, keys=WINDOW_ACCOUNT_KEYS)


@query("fc_anti")
def q_fc_anti(spark, sf_dir):
    fc = tb.events_as_fc(_events(spark, sf_dir))
    excl = tb.exclusion_list(tb.load_table(spark, sf_dir, "customer"))
    return lookup.anti_filter(fc, excl)


@query("fc_sum")
def q_fc_sum(spark, sf_dir):
    return flows.fc_sum(q_fc_anti(spark, sf_dir))


# ---------------------------------------------------------------- behaviour

def _marks(spark, sf_dir):
    return tb.events_as_marks(_events(spark, sf_dir))


@query("running_avg")
def q_running_avg(spark, sf_dir):
    return behavior.running_average(_marks(spark, sf_dir))


@query("purge_segments")
def q_purge_segments(spark, sf_dir):
    # two dependent prefix scans over the same (name, block) partitioning, in one plan
    avgs = behavior.running_average(_marks(spark, sf_dir), with_block=True)
    return behavior.purge_segments(avgs, threshold=80)


def _views(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.where(F.col("event_type") == "view").select(
        "ts", "user_id", F.col("event_id").alias("seq"))


@query("uv_hourly")
def q_uv_hourly(spark, sf_dir):
    return behavior.uv_exact(_views(spark, sf_dir), "ts", "user_id", "1 hour")


@query("poly_hash")
def q_poly_hash(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", "user_id", poly_hash(F.col("user_id").cast("string")).alias("h"))


@query("uv_bitmap")
def q_uv_bitmap(spark, sf_dir):
    return behavior.uv_bitmap(_views(spark, sf_dir), "ts", "user_id", "1 hour")


@query("uv_approx")
def q_uv_approx(spark, sf_dir):
    """HyperLogLog++ per window, held against the exact count: within 3 percent, or off by one."""
    v = _views(spark, sf_dir)
    keys = ["window_start", "window_end"]
    both = behavior.uv_approx(v, "ts", "user_id", "1 hour").withColumnRenamed("uv", "approx").join(
        behavior.uv_exact(v, "ts", "user_id", "1 hour"), keys)
    off = F.abs(F.col("approx") - F.col("uv"))
    return both.select(*keys, (off <= F.greatest(0.03 * F.col("uv"), F.lit(1.0))).alias("near"))


@query("uv_last")
def q_uv_last(spark, sf_dir):
    return behavior.window_last(_views(spark, sf_dir), "ts", "1 hour", "user_id")


@query("uv_running")
def q_uv_running(spark, sf_dir):
    return behavior.uv_running(_views(spark, sf_dir), "ts", "user_id", "1 hour")


MARKETING_SIZE, MARKETING_SLIDE = "1 hour", "10 minutes"


@query("marketing_sliding")
def q_marketing_sliding(spark, sf_dir, size=MARKETING_SIZE, slide=MARKETING_SLIDE):
    m = tb.events_as_marketing(_events(spark, sf_dir)).where(F.col("behavior") != "error")
    return behavior.sliding_counts(m, "ts", size, slide, ["channel", "behavior"])


def _devices(spark, sf_dir):
    return tb.events_as_devices(_events(spark, sf_dir))


@query("device_max_by")
def q_device_max_by(spark, sf_dir):
    return behavior.window_max_by(_devices(spark, sf_dir), "id", "ts", "1 day")


@query("device_collect")
def q_device_collect(spark, sf_dir):
    return behavior.window_contents(_devices(spark, sf_dir), "id", "ts", "1 day")


@query("count_trigger")
def q_count_trigger(spark, sf_dir):
    return triggers.count_firing(_devices(spark, sf_dir), "id", "ts", "1 day", n=2)


@query("early_fire")
def q_early_fire(spark, sf_dir):
    return triggers.early_firing(_devices(spark, sf_dir), "id", "ts", "1 day", "6 hours")


# ---------------------------------------------------------------- joins
def _typed(spark, sf_dir, t):
    return _events(spark, sf_dir).where(F.col("event_type") == t).select(
        "user_id", "ts", "event_id")


@query("interval_join")
def q_interval_join(spark, sf_dir):
    return joins.interval_join(_typed(spark, sf_dir, "click"), _typed(spark, sf_dir, "view"),
                               "user_id", "-90 minutes", "0 seconds",
                               lcols=["event_id"], rcols=["event_id"])


@query("window_join")
def q_window_join(spark, sf_dir):
    return joins.window_join(_typed(spark, sf_dir, "click"), _typed(spark, sf_dir, "view"),
                             "user_id", "1 day", lcols=["event_id"], rcols=["event_id"])


# ---------------------------------------------------------------- patterns
ORDER_LIMIT = "12 hours"


def _order_pattern(spark, sf_dir):
    o = tb.events_as_orders(_events(spark, sf_dir))
    return patterns.followed_by(o, "order_id", "event_type", "create", "pay", ORDER_LIMIT)


@query("order_pay_match")
def q_order_pay_match(spark, sf_dir):
    return _order_pattern(spark, sf_dir)[0]


@query("order_pay_timeout")
def q_order_pay_timeout(spark, sf_dir):
    return _order_pattern(spark, sf_dir)[1]


# ---------------------------------------------------------------- late data
def _delayed(spark, sf_dir):
    """Every 4th arrival carries an event time 2 h in the past (the simulator's delayed rows)."""
    e = _events(spark, sf_dir)
    ets = F.when(F.col("event_id") % 4 == 0, F.col("ts") - F.expr("INTERVAL 2 HOURS")) \
        .otherwise(F.col("ts"))
    return e.select("event_id", "user_id", "event_type", ets.alias("ets"))


@query("late_split")
def q_late_split(spark, sf_dir):
    _, late = lateness.late_split(_delayed(spark, sf_dir), "ets", "event_id", "1 hour")
    return late


@query("late_split_delay")
def q_late_split_delay(spark, sf_dir):
    _, late = lateness.late_split(_delayed(spark, sf_dir), "ets", "event_id", "1 hour",
                                  delay="30 minutes")
    return late


@query("on_time_counts")
def q_on_time_counts(spark, sf_dir):
    rows = _delayed(spark, sf_dir).drop("user_id")
    on_time, _ = lateness.late_split(rows, "ets", "event_id", "1 hour")
    g = on_time.groupBy(F.window("ets", "1 hour").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "count")


# ---------------------------------------------------------------- routing
ACT_COLS = ("l_orderkey", "l_linenumber", "typ", "act_nbr", "ccy_nbr", "reg_tim", "amt", "dir",
            "cod", "sts", "rcv")


def _act(spark, sf_dir):
    return tb.lineitem_as_act(tb.load_table(spark, sf_dir, "lineitem"))


def _act_branches():
    return {"kpp": F.col("typ") == "kpp", "kqp": F.col("typ") == "kqp"}


@query("act_split")
def q_act_split(spark, sf_dir):
    return routing.route(_act(spark, sf_dir), _act_branches()).select(
        "l_orderkey", "l_linenumber", "typ", "branch")


def _act_decided(spark, sf_dir):
    """kpp and kqp side outputs, each through its type's rules, merged again.

    Written as one pass (route, keep the two branches, rules keyed by type) rather than two
    filtered copies of the scan that are unioned: same rows, one read of ``lineitem``.
    """
    routed = routing.route(_act(spark, sf_dir), _act_branches())
    return routing.rule_decision(routed.where(F.col("branch") != "other"))


@query("act_rules")
def q_act_rules(spark, sf_dir):
    return _act_decided(spark, sf_dir).select("l_orderkey", "l_linenumber", "typ", "dir", "sts",
                                              "cod", "decision", "out_typ")


@query("act_accepted_union")
def q_act_accepted_union(spark, sf_dir):
    d = _act_decided(spark, sf_dir)
    return d.where(F.col("decision") == "keep").select(*ACT_COLS)


@query("act_rejected_union")
def q_act_rejected_union(spark, sf_dir):
    d = _act_decided(spark, sf_dir)
    return d.where(F.col("out_typ") == routing.REJECTED).select(
        *[F.col("out_typ").alias("typ") if c == "typ" else F.col(c) for c in ACT_COLS])


# ---------------------------------------------------------------- offset ledger
@query("offset_ledger")
def q_offset_ledger(spark, sf_dir):
    """Two batches of event offsets (partition = user % 8) plus a replay of part of the first. The
    batches are cut by offset, so every row is in one of them whatever its time."""
    e = _events(spark, sf_dir).select(F.lit("events").alias("topic"),
                                      (F.col("user_id") % 8).cast("int").alias("partition"),
                                      F.col("event_id").alias("offset"))
    first = e.where("offset % 4 < 2")
    second = e.where("offset % 4 >= 2").unionByName(e.where("offset % 4 = 1"))
    return ledger.advance(ledger.advance(None, first), second)


# ---------------------------------------------------------------- streams
def _event_stream(spark, sf_dir):
    """``events`` as a stream through the file source; as a pattern, the path may be a file or a folder."""
    return spark.readStream.schema(_events(spark, sf_dir).schema).parquet(f"{sf_dir}/events.parque[t]")


def _stream_folder(spark) -> str:
    return scratch_path(spark, "streams", uuid.uuid4().hex)


def _run_to_end(df: DataFrame) -> DataFrame:
    """Run a stream over what is there and read what it wrote; times as in the tables."""
    from . import streaming
    spark, root = df.sparkSession, _stream_folder(df.sparkSession)
    streaming.start(df, "run", checkpoint=f"{root}/checkpoint", fmt="parquet", path=f"{root}/out").awaitTermination()
    return _wall_times(spark.read.schema(df.schema).parquet(f"{root}/out"))


def _wall_times(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


@query("stream_early_fire")
def q_stream_early_fire(spark, sf_dir):
    """Early and final firings of eight device groups in one streaming query, as far as the watermark goes."""
    from .streaming import early_firing_stream
    d = tb.events_as_devices(_event_stream(spark, sf_dir)).withColumn(
        "id", (F.col("id").cast("long") % 8).cast("string"))
    return _run_to_end(early_firing_stream(d, "id", "ts", "1 day", "6 hours"))


@query("stream_sliding")
def q_stream_sliding(spark, sf_dir):
    """Sliding counts of the closed windows from rings of panes."""
    from .streaming import sliding_ring_stream
    m = tb.events_as_marketing(_event_stream(spark, sf_dir)).where(F.col("behavior") != "error")
    return _run_to_end(sliding_ring_stream(m, "ts", MARKETING_SIZE, MARKETING_SLIDE, ["channel", "behavior"]))


@query("stream_segments")
def q_stream_segments(spark, sf_dir):
    """Condition-fired segments with their best element, on a stream."""
    from .streaming import purge_segments_stream
    return _run_to_end(purge_segments_stream(tb.events_as_marks(_event_stream(spark, sf_dir)), threshold=80))


@query("stream_uv_running")
def q_stream_uv_running(spark, sf_dir):
    """Distinct (hashed) users of its window so far, for every view of a stream."""
    from .streaming import read_uv_running, uv_running_sink
    v = _event_stream(spark, sf_dir).where(F.col("event_type") == "view").select(
        "ts", "user_id", F.col("event_id").alias("seq"))
    root = _stream_folder(spark)
    uv_running_sink(v, "ts", "user_id", "1 day", f"{root}/out", checkpoint=f"{root}/checkpoint").awaitTermination()
    return _wall_times(read_uv_running(spark, f"{root}/out"))
