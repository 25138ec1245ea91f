"""Streaming jobs. Every ``*_stream`` function returns a streaming DataFrame; ``start`` runs it.
``foreachBatch`` jobs (``dc_statistics``, ``fc_statistics``, ``late_split_batches``,
``offset_ledger_sink``) return a started :class:`StreamingQuery`."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import classify_dc, parse_dc, parse_fc, recognised, with_rejects
from ..operators import cells, flows, lateness, ledger, lookup
from ..operators.patterns import PAID, TIMEOUT
from ..plans.panes import interval_us
from ..plans.prefix import running
from ..session import scratch_path
from . import store
from .state import (CONTENTS_STATE, OUTPUT_SCHEMA, STATE_SCHEMA, UV_OUTPUT, UV_STATE,
                    contents_state_fn, count_schemas, count_state_fn, marks_schemas, marks_state_fn,
                    pattern_state_fn, uv_counter_fn)


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP: cast a TIMESTAMP_NTZ event time (session time zone is UTC)."""
    if dict(df.dtypes).get(col) == "timestamp_ntz":
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start(df: DataFrame, name: str, checkpoint: str | None = None, fmt: str = "memory",
          mode: str = "append", trigger: str | None = "availableNow", path: str | None = None,
          options: dict | None = None) -> StreamingQuery:
    """Start a streaming query; checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>``."""
    spark = df.sparkSession
    ck = checkpoint or scratch_path(spark, "streams", name)
    w = df.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", ck)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt == "memory":
        w = w.queryName(name)
    w = _trigger(w, trigger)
    return w.start(path) if path else w.start()


@contextmanager
def _cached(df: DataFrame):
    """``df`` cached for the block and released whatever happens in it."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def _scale(df: DataFrame, col: str) -> int | None:
    """Decimal places of a decimal or integral column; None for floating point."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale
    return 0 if isinstance(kind, T.IntegralType) else None


def _units(col: str, scale: int | None) -> Column:
    """A number as whole units of its last decimal place, exactly; floating point stays."""
    if scale is None:
        return F.col(col).cast("double")
    return (F.col(col).cast(f"decimal(38,{scale})") * F.lit(10 ** scale).cast("decimal(20,0)")
            ).cast("long")


def _from_units(col: str, scale: int | None) -> Column:
    if scale is None:
        return F.col(col)
    return (F.col(col).cast("decimal(38,0)") / F.lit(10 ** scale).cast("decimal(20,0)")).cast(
        f"decimal(38,{scale})")


def _batch_dir(root: str, batch_id: int) -> str:
    return os.path.join(root, f"batch_id={batch_id}")


# ------------------------------------------------------------------ per-batch (stateless) jobs
def dc_statistics(lines: DataFrame, out_root: str, checkpoint: str | None = None,
                  trigger: str | None = "5 seconds", as_cells: bool = True) -> StreamingQuery:
    """DC message stream -> per-micro-batch net flow (the 5 s batch job), written as cells.

    Parsing and classification stay in the streaming plan (narrow); the aggregate and unpivot run
    on each micro-batch. Output of batch N goes to ``out_root/batch_id=N`` (overwrite: a replayed
    batch rewrites its own folder, it never adds duplicates). Lines without a transaction code, and
    recognised ones whose date, time or amount did not parse, go with their raw text (``value``) to
    ``out_root/_rejects/batch_id=N``; lines with another code are the only ones left out.
    """
    tx = classify_dc(parse_dc(lines, keep=["value"]))

    def per_batch(bdf: DataFrame, batch_id: int):
        with _cached(bdf) as bdf:
            write(bdf, batch_id)

    def write(bdf: DataFrame, batch_id: int):
        coded, bad_lines = with_rejects(bdf, ["code"])
        ok, bad_fields = with_rejects(recognised(coded), ["date", "time", "amt"])
        bad = bad_lines.unionByName(bad_fields)
        net = flows.dc_net_flow(ok)
        out = cells.to_cells(net, flows.NET_KEYS, batch_id=batch_id) if as_cells else net
        out.write.mode("overwrite").parquet(_batch_dir(out_root, batch_id))
        bad.write.mode("overwrite").parquet(_batch_dir(os.path.join(out_root, "_rejects"), batch_id))

    return _foreach(tx, per_batch, "dc_statistics", checkpoint, trigger)


def fc_statistics(lines: DataFrame, exclusion: Callable[[SparkSession], DataFrame], out_root: str,
                  checkpoint: str | None = None, trigger: str | None = "5 seconds"
                  ) -> StreamingQuery:
    """FC message stream -> per-batch sums per (account, currency, direction) after dropping the
    accounts on the exclusion list. ``exclusion`` is called inside every batch, so each batch sees
    the list as it is then (a static DataFrame built once would keep its first file listing). Lines
    without account, amount or direction go with their raw text to ``out_root/_rejects``."""
    fc = parse_fc(lines, keep=["value"])

    def per_batch(bdf: DataFrame, batch_id: int):
        with _cached(bdf) as bdf:
            write(bdf, batch_id)

    def write(bdf: DataFrame, batch_id: int):
        ok, bad = with_rejects(bdf, ["act_nbr", "amt", "dir"])
        excl = exclusion(bdf.sparkSession)
        kept = lookup.anti_filter(ok, excl)
        flows.fc_sum(kept).write.mode("overwrite").parquet(_batch_dir(out_root, batch_id))
        bad.write.mode("overwrite").parquet(_batch_dir(os.path.join(out_root, "_rejects"), batch_id))

    return _foreach(fc, per_batch, "fc_statistics", checkpoint, trigger)


def late_split_batches(df: DataFrame, ts: str, arrival: str, size: str, out_root: str,
                       delay: str = "0 seconds", checkpoint: str | None = None,
                       trigger: str | None = "availableNow") -> StreamingQuery:
    """Late-row side output on a stream, deterministic under replay.

    The high-water mark (max event time seen so far) after batch N is stored as a one-row table
    ``<out_root>/_hwm/batch_id=N``; batch N reads the mark of the latest earlier batch, splits its
    rows with :func:`lateness.late_flag` (arrival order inside the batch), and writes
    ``on_time``/``late`` folders for N. A replayed batch reads the same earlier mark and
    rewrites the same output.
    """
    hwm_root = os.path.join(out_root, "_hwm")
    delay_us = interval_us(delay)

    def per_batch(bdf: DataFrame, batch_id: int):
        with _cached(bdf) as bdf:
            split(bdf, batch_id)

    def split(bdf: DataFrame, batch_id: int):
        prev = _previous_hwm(bdf.sparkSession, hwm_root, batch_id)
        prev = None if prev is None else _ts_literal(prev, bdf.schema[ts].dataType)
        flagged = lateness.late_flag(bdf, ts, arrival, size, delay=delay)
        if prev is not None:
            before = F.greatest(F.col("max_ts_before"), prev)
            wm = before if delay_us == 0 else \
                before - F.expr(f"INTERVAL {delay_us - 1000} MICROSECONDS")
            flagged = flagged.withColumn("is_late", F.col("window_end") <= wm)
        cols = bdf.columns + ["window_end"]
        with _cached(flagged) as rows:
            rows.where(~F.col("is_late")).select(*cols).write.mode("overwrite").parquet(
                os.path.join(out_root, "on_time", f"batch_id={batch_id}"))
            rows.where(F.col("is_late")).select(*cols).write.mode("overwrite").parquet(
                os.path.join(out_root, "late", f"batch_id={batch_id}"))
        top = bdf.agg(F.max(ts).alias("m"))
        if prev is not None:
            top = top.select(F.greatest(F.col("m"), prev).alias("m"))
        top.write.mode("overwrite").parquet(_batch_dir(hwm_root, batch_id))
        store.drop_before(bdf.sparkSession, hwm_root, batch_id - 1)

    return _foreach(df, per_batch, "late_split", checkpoint, trigger)


def _previous_output(spark: SparkSession, root: str, batch_id: int):
    """Output written by the batch before ``batch_id`` (None before the first).

    ``foreachBatch`` ids are consecutive, batch N runs only after N-1 committed, and every batch
    writes its folder, so that folder must be there: if it cannot be read, the batch fails.
    """
    return None if batch_id == 0 else spark.read.parquet(_batch_dir(root, batch_id - 1))


def _ts_literal(value, dtype):
    """A literal of the column's own timestamp type, independent of the session's and the Python
    process's time zones (a naive ``datetime`` from ``collect`` is local time for TIMESTAMP and
    wall-clock time for TIMESTAMP_NTZ)."""
    from datetime import timezone

    from pyspark.sql import types as T
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    aware = value.astimezone(timezone.utc) if value.tzinfo is None else value
    return F.lit(aware.isoformat(sep=" ")).cast("timestamp")


def _previous_hwm(spark: SparkSession, hwm_root: str, batch_id: int):
    prev = _previous_output(spark, hwm_root, batch_id)
    row = prev.select("m").first() if prev is not None else None
    return row.m if row else None


def offset_ledger_sink(records: DataFrame, ledger_root: str, checkpoint: str | None = None,
                       trigger: str | None = "availableNow") -> StreamingQuery:
    """Keep ``(topic, partition) -> next offset`` up to date from processed records.

    The ledger after batch N is written to ``ledger_root/batch_id=N`` from the ledger of the
    latest earlier batch, so a replayed batch produces the same ledger and it never moves back.
    """
    def per_batch(bdf: DataFrame, batch_id: int):
        prev = _previous_output(bdf.sparkSession, ledger_root, batch_id)
        ledger.advance(prev, bdf).write.mode("overwrite").parquet(_batch_dir(ledger_root, batch_id))

    return _foreach(records, per_batch, "offset_ledger", checkpoint, trigger)


def _foreach(df: DataFrame, fn, name: str, checkpoint: str | None, trigger: str | None
             ) -> StreamingQuery:
    ck = checkpoint or scratch_path(df.sparkSession, "streams", name)
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", ck)
    return _trigger(w, trigger).start()


# ------------------------------------------------------------------ stateful streaming plans
def window_inout_stream(tx: DataFrame, size: str, time_col: str = "ts", delay: str = "0 seconds",
                        keys: Sequence[str] = flows.WINDOW_KEYS) -> DataFrame:
    """Windowed in/out per key; rows come out once the watermark closes the window (append)."""
    return flows.dc_window_inout(event_time(tx, time_col).withWatermark(time_col, delay), size,
                                 time_col=time_col, keys=keys)


def running_total_stream(win: DataFrame, keys: Sequence[str] = flows.WINDOW_KEYS) -> DataFrame:
    """Cumulative in/out/net per key over window results (run with ``outputMode('update')``)."""
    g = win.groupBy(*keys).agg(F.sum("in_amt").alias("cum_in"), F.sum("out_amt").alias("cum_out"))
    return g.withColumn("cum_net", F.col("cum_in") + F.col("cum_out"))


def uv_distinct_stream(views: DataFrame, ts: str, user: str, size: str,
                       delay: str = "0 seconds") -> DataFrame:
    """Distinct users per tumbling window on a stream: (window, user) first, then a count per
    window -- two chained stateful aggregations, append mode (distinct aggregates are not
    supported on streams)."""
    v = event_time(views, ts).withWatermark(ts, delay)
    pairs = v.groupBy(F.window(ts, size).alias("w"), F.col(user)).agg(F.count(F.lit(1)).alias("n"))
    g = pairs.groupBy("w").agg(F.count(F.lit(1)).alias("uv"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv")


def sliding_count_stream(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str],
                         delay: str = "0 seconds") -> DataFrame:
    """Sliding-window counts on a stream, in append mode, through panes.

    Where ``size`` is a multiple of ``slide``, a ring of panes per key
    (:func:`timers.sliding_ring_stream`). Else two chained stateful aggregations: rows -> tumbling panes of ``slide`` (state per pane), then
    panes -> sliding windows, using the pane's event time (``window_time``, its last instant: a
    slide-aligned window holds the pane iff it holds that instant). Only pane rows are expanded
    into their windows.
    """
    if interval_us(size) % interval_us(slide) == 0:
        from .timers import sliding_ring_stream
        return sliding_ring_stream(df, ts, size, slide, keys, delay)
    d = event_time(df, ts).withWatermark(ts, delay)
    panes = d.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(F.count(F.lit(1)).alias("n"))
    pt = panes.select(F.window_time("pane").alias("pane_time"), *keys, "n")
    g = pt.groupBy(F.window("pane_time", size, slide).alias("w"), *keys).agg(
        F.sum("n").alias("count"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "count")


BITMAP_PART = 32768  # bits of one bitmap value


def uv_bitmap_stream(views: DataFrame, ts: str, user: str, size: str,
                     delay: str = "0 seconds") -> DataFrame:
    """Bitmap distinct users per tumbling window on a stream (append mode): a bitmap per
    (window, bitmap bucket) of the users' ``poly_hash`` bit indexes, then the set bits summed per
    window -- two chained stateful aggregations, each group's state a fixed-size bitmap."""
    from ..functions.hashing import poly_hash
    v = event_time(views, ts).withWatermark(ts, delay)
    v = v.withColumn("h", poly_hash(F.col(user).cast("string")))
    per_part = v.groupBy(F.window(ts, size).alias("w"), F.expr(f"h div {BITMAP_PART}").alias("b")).agg(
        F.bitmap_construct_agg(F.col("h") % BITMAP_PART).alias("bm"))
    g = per_part.groupBy("w").agg(F.sum(F.bitmap_count("bm")).alias("uv"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv")


def interval_join_stream(left: DataFrame, right: DataFrame, key: str, lo: str, hi: str,
                         lts: str = "ts", rts: str = "ts", delay: str = "0 seconds",
                         lcols: Sequence[str] = (), rcols: Sequence[str] = ()) -> DataFrame:
    """Stream-stream interval join; the time-range condition lets Spark drop old state."""
    from ..operators.joins import _signed_seconds
    lo_us = int(_signed_seconds(lo) * 1_000_000)
    hi_us = int(_signed_seconds(hi) * 1_000_000)
    l = event_time(left.select(F.col(key).alias("_lk"), *[F.col(c).alias(f"l_{c}")
                                                          for c in (lts, *lcols)]), f"l_{lts}")
    r = event_time(right.select(F.col(key).alias("_rk"), *[F.col(c).alias(f"r_{c}")
                                                           for c in (rts, *rcols)]), f"r_{rts}")
    l = l.withWatermark(f"l_{lts}", delay)
    r = r.withWatermark(f"r_{rts}", delay)
    cond = (F.col("_lk") == F.col("_rk")) & \
        (F.col(f"r_{rts}") >= F.col(f"l_{lts}") + F.expr(f"INTERVAL {lo_us} MICROSECONDS")) & \
        (F.col(f"r_{rts}") <= F.col(f"l_{lts}") + F.expr(f"INTERVAL {hi_us} MICROSECONDS"))
    j = l.join(r, cond)
    return j.select(F.col("_lk").alias(key), *[f"l_{c}" for c in (lts, *lcols)],
                    *[f"r_{c}" for c in (rts, *rcols)])


def window_join_stream(left: DataFrame, right: DataFrame, key: str, size: str, lts: str = "ts",
                       rts: str = "ts", delay: str = "0 seconds", lcols: Sequence[str] = (),
                       rcols: Sequence[str] = ()) -> DataFrame:
    """Stream-stream inner join on equal key and equal tumbling window; the window equality on
    watermarked event times lets Spark drop a window's state once both watermarks pass it."""
    l = event_time(left, lts).withWatermark(lts, delay)
    r = event_time(right, rts).withWatermark(rts, delay)
    # one event-time column per side: the window; the row time is passed on as plain data
    l = l.select(F.col(key).alias("_lk"), F.window(lts, size).alias("_lw"),
                 F.col(lts).cast("timestamp_ntz").alias(f"l_{lts}"),
                 *[F.col(c).alias(f"l_{c}") for c in lcols])
    r = r.select(F.col(key).alias("_rk"), F.window(rts, size).alias("_rw"),
                 F.col(rts).cast("timestamp_ntz").alias(f"r_{rts}"),
                 *[F.col(c).alias(f"r_{c}") for c in rcols])
    j = l.join(r, (F.col("_lk") == F.col("_rk")) & (F.col("_lw") == F.col("_rw")))
    return j.select(F.col("_lk").alias(key), F.col("_lw.start").alias("window_start"),
                    F.col("_lw.end").alias("window_end"), *[f"l_{c}" for c in (lts, *lcols)],
                    *[f"r_{c}" for c in (rts, *rcols)])


def order_pattern_stream(orders: DataFrame, key: str = "order_id", kind: str = "event_type",
                         first: str = "create", then: str = "pay", within: str = "15 minutes",
                         ts: str = "ts", seq: str = "seq", delay: str = "0 seconds",
                         late: str | None = None) -> DataFrame:
    """Matches and timeouts of "first followed by then within T" on one stream, per key state.

    Output ``key, first_seq, first_ts, next_seq, next_ts, result`` (result = 'payed successfully'
    or 'timeout'), in append mode. Rows behind the watermark are dropped, or with ``late`` come out
    under that result label. The key may be of any type with a text form. One stream and one watermark, so no multiple-watermark policy
    question arises.
    """
    within_us = interval_us(within)
    o = event_time(orders, ts).withWatermark(ts, delay).select(
        F.col(key).cast("string").alias("key"), F.col(kind).alias("kind"),
        F.unix_micros(F.col(ts)).alias("us"), F.col(seq).cast("long").alias("seq"),
        (F.window(ts, "400000 days").alias("w") if late else F.col(ts)))
    # the event-time column decides which rows are filtered as late before they get here: the row
    # time itself, or, to see the late rows too, one window that is never behind the watermark
    fn = pattern_state_fn(first, then, within_us, PAID, TIMEOUT, late)
    out = o.groupBy("key").applyInPandasWithState(fn, OUTPUT_SCHEMA, STATE_SCHEMA, "append",
                                                   "EventTimeTimeout")
    return out.select(F.col("key").cast(orders.schema[key].dataType).alias(key), "first_seq",
                      F.timestamp_micros("first_us").alias("first_ts"), "next_seq",
                      F.timestamp_micros("next_us").alias("next_ts"), "result")


def running_average_stream(marks: DataFrame, name: str = "name", mark: str = "mark",
                           seq: str = "seq", threshold: float | None = None,
                           expire: str | None = None) -> DataFrame:
    """Per-record running average per name on a stream (append mode, one row per record).

    Output as :func:`operators.behavior.running_average` (``name, seq, run_sum, count,
    avg_mark``, in the same types) plus ``segment`` and ``fire`` when ``threshold`` is given: the
    records with ``fire = 1`` are the purge-segment results of ``purge_segments`` (the firing record
    is its segment's largest average). Records of a name must arrive in ``seq`` order. With
    ``expire`` (an interval of processing time) the state of a name that was silent for so long is
    dropped; without it there is one small state per name for good.
    """
    scale = _scale(marks, mark)
    d = marks.select(F.col(name).cast("string").alias("name"), F.col(seq).cast("long").alias("seq"),
                     _units(mark, scale).alias("units"))
    limit = None if threshold is None else Fraction(str(threshold)) * 10 ** (scale or 0)
    expire_ms = interval_us(expire) // 1000 if expire else None
    out_schema, state_schema = marks_schemas(scale is not None)
    out = d.groupBy("name").applyInPandasWithState(
        marks_state_fn(limit, expire_ms), out_schema, state_schema, "append",
        "ProcessingTimeTimeout" if expire else "NoTimeout")
    run_sum = _from_units("total", scale)
    average = run_sum / F.col("count")
    if scale is not None:
        average = average.cast(f"decimal(38,{max(6, scale + 4)})")
    return out.select(F.col("name").alias(name), F.col("seq").alias(seq), run_sum.alias("run_sum"),
                      "count", average.alias("avg_mark"), "segment", "fire")


def window_aggregate_stream(df: DataFrame, key: str, ts: str, size: str, value: str = "value",
                            delay: str = "0 seconds", seq: str | None = None) -> DataFrame:
    """Count, sum, max and max-by-value element per (key, tumbling window) on a stream.

    With ``seq`` (arrival), ``max_seq`` is the arrival of the element with the largest value, the
    earliest arrival winning a tie (A11).

    Early firing (T10) is this query started with ``mode="update"`` and
    ``trigger="<interval>"``: each trigger re-emits the windows that changed, accumulated so far.
    The final firing at window end (T9) is the same query with ``mode="append"``: a window is
    emitted once the watermark passes its end.
    """
    d = event_time(df, ts).withWatermark(ts, delay)
    extra = [F.max_by(F.col(seq), F.struct(F.col(value), -F.col(seq))).alias("max_seq")] \
        if seq else []
    g = d.groupBy(F.window(ts, size).alias("w"), key).agg(
        F.count(F.lit(1)).alias("cum_count"), F.sum(value).alias("cum_sum"),
        F.max(value).alias("cum_max"), *extra)
    return g.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "cum_count", "cum_sum", "cum_max", *(["max_seq"] if seq else []))


TOTAL_BUCKETS = 256
COMPACT_EVERY = 64


def cumulative_sink(results: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str],
                    out_root: str, checkpoint: str | None = None,
                    trigger: str | None = "availableNow",
                    buckets: int = TOTAL_BUCKETS, block: Column | None = None) -> StreamingQuery:
    """Running totals per key over a stream of results, one output row per result (A6).

    Each micro-batch: cumulative sums inside the batch per key (ordered by ``order``; a batch
    holds few results per key, or ``block`` cuts a key's rows into blocks along the order) plus the key's totals before it, written to
    ``out_root/emitted/batch_id=N``. Totals lie in ``buckets`` hash buckets of keys; a batch reads and
    writes anew only the buckets of its own keys, below ``out_root/_totals/batch_id=N``, and a small
    index ``out_root/_index/batch_id=N`` tells for each bucket which batch wrote it last. A replayed
    batch starts from the index of batch N-1 and so emits the same rows. Totals that neither needs are
    removed, so at most two folders a bucket stay.
    """
    keys, sums = list(keys), list(sums)
    totals_root, index_root = os.path.join(out_root, "_totals"), os.path.join(out_root, "_index")

    def per_batch(bdf: DataFrame, batch_id: int):
        with _cached(bdf.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
                     ) as rows:
            write(rows, bdf.columns, batch_id)

    def write(rows: DataFrame, columns: list[str], batch_id: int):
        from pyspark.sql import Window
        spark = rows.sparkSession
        index = _previous_output(spark, index_root, batch_id)
        written = {r["bucket"]: r["batch"] for r in index.collect()} if index is not None else {}
        own = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets``
        paths = [f"{_batch_dir(totals_root, written[b])}/_bucket={b}" for b in own if b in written]
        before = None
        if paths:
            before = spark.read.parquet(*paths).select(
                *[F.col(k).alias(f"_k_{k}") for k in keys],
                *[F.col(f"cum_{c}").alias(f"_p_{c}") for c in sums])
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        run = rows.select(*columns, *[F.sum(c).over(w).alias(f"_r_{c}") for c in sums]) if block is None \
            else running(rows.select(*columns), keys, [F.col(order)], block,
                         {f"_r_{c}": ("sum", c) for c in sums})
        added = rows.groupBy("_bucket", *keys).agg(*[F.sum(c).alias(f"_r_{c}") for c in sums])

        def with_before(df: DataFrame, how: str) -> DataFrame:
            if before is None:
                return df.select("*", *[F.lit(0).alias(f"_p_{c}") for c in sums])
            same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
            return df.join(before, same, how)

        def total(c: str) -> Column:
            return (F.coalesce(F.col(f"_p_{c}"), F.lit(0)) + F.coalesce(F.col(f"_r_{c}"), F.lit(0))
                    ).alias(f"cum_{c}")

        with_before(run, "left").select(*columns, *map(total, sums)).write.mode("overwrite").parquet(
            os.path.join(out_root, "emitted", f"batch_id={batch_id}"))
        merged = with_before(added, "full_outer")
        if before is not None:
            merged = merged.withColumns({k: F.coalesce(k, f"_k_{k}") for k in keys})
        merged = merged.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        (merged.select("_bucket", *keys, *map(total, sums)).write.mode("overwrite")
         .partitionBy("_bucket").parquet(_batch_dir(totals_root, batch_id)))
        replaced = {b: m for b, m in written.items() if m == batch_id - 1}
        needed = set(written.values()) | {batch_id}
        written |= {b: batch_id for b in own}
        spark.createDataFrame(list(written.items()), "bucket int, batch long").coalesce(1).write.mode(
            "overwrite").parquet(_batch_dir(index_root, batch_id))
        prune(spark, batch_id, replaced, needed)

    def prune(spark: SparkSession, batch_id: int, replaced: dict, needed: set):
        """Remove what neither the next batch nor a replay of this one reads: buckets that the batch before
        has written anew, totals without any bucket left, and the indexes before that batch's."""
        if replaced and batch_id - 2 in store.folders(spark, index_root):
            old = spark.read.parquet(_batch_dir(index_root, batch_id - 2))
            for r in old.collect():  # at most ``buckets``
                if r["bucket"] in replaced:
                    store.drop(spark, _batch_dir(totals_root, r["batch"]), f"_bucket={r['bucket']}")
        for m in store.folders(spark, totals_root, complete=False):
            if m not in needed:
                store.drop(spark, _batch_dir(totals_root, m))
        store.drop_before(spark, index_root, batch_id - 1)

    return _foreach(results, per_batch, "cumulative", checkpoint, trigger)


def upsert_sink(results: DataFrame, keys: Sequence[str], out_root: str,
                checkpoint: str | None = None, trigger: str | None = "availableNow",
                mode: str = "update", compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Counters per key with the last value kept (K3), e.g. (window_end, n): batch N writes the rows
    that changed to ``out_root/batch_id=N``; :func:`latest` reads the newest row of each key. Every
    ``compact_every`` batches the ones before are merged into a snapshot with one row per key."""
    def per_batch(bdf: DataFrame, batch_id: int):
        bdf.write.mode("overwrite").parquet(_batch_dir(out_root, batch_id))
        if batch_id and batch_id % compact_every == 0:
            store.compact(bdf.sparkSession, out_root, batch_id - 1, lambda rows: newest(rows, keys))

    ck = checkpoint or scratch_path(results.sparkSession, "streams", "upsert")
    w = results.writeStream.outputMode(mode).foreachBatch(per_batch).option("checkpointLocation", ck)
    return _trigger(w, trigger).start()


def newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the row of the latest batch, with its ``batch_id``."""
    values = [c for c in rows.columns if c not in keys]
    top = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return top.select(*keys, "_v.*")


def latest(spark: SparkSession, out_root: str, keys: Sequence[str]) -> DataFrame:
    """The rows of an :func:`upsert_sink` as a table: per key the one of the latest batch. Reads the
    snapshot and the batches after it."""
    return newest(store.read(spark, out_root), keys).drop("batch_id")


def _by_window(df: DataFrame, key: str, ts: str, size: str, seq: str, delay: str, *cols) -> DataFrame:
    """Rows with their window as the one event-time column: a row is late only when its whole window
    is behind the watermark, not when the row itself is."""
    d = event_time(df, ts).withWatermark(ts, delay)
    w = F.window(ts, size)
    return d.select(F.col(key).cast("string").alias("key"), w.alias("w"),
                    F.unix_micros(w.start).alias("window_start_us"),
                    F.col(seq).cast("long").alias("seq"), *cols)


def count_trigger_stream(df: DataFrame, key: str, ts: str, size: str, n: int,
                         value: str = "value", seq: str = "seq",
                         delay: str = "0 seconds") -> DataFrame:
    """Count trigger (T13) on a stream: per (key, tumbling window), a row at every ``n``-th
    element (in arrival order) with ``fire_no``, ``cum_count``, ``cum_sum`` and ``cum_max`` of
    ``value`` (exact, in the scale of ``value``). Rows of a window count while it is open, in
    whatever time order they come. Append mode; window state is dropped after its end."""
    size_us = interval_us(size)
    scale = _scale(df, value)
    d = _by_window(df, key, ts, size, seq, delay, _units(value, scale).alias("units"))
    out_schema, state_schema = count_schemas(scale is not None)
    out = d.groupBy("key", "window_start_us").applyInPandasWithState(
        count_state_fn(n, size_us), out_schema, state_schema, "append", "EventTimeTimeout")
    start = F.timestamp_micros("window_start_us")
    return out.select(F.col("key").alias(key), start.alias("window_start"),
                      (start + F.expr(f"INTERVAL {size_us} MICROSECONDS")).alias("window_end"),
                      "fire_no", "cum_count", _from_units("total", scale).alias("cum_sum"),
                      _from_units("largest", scale).alias("cum_max"))


def window_contents_stream(df: DataFrame, key: str, ts: str, size: str, value: str = "value",
                           seq: str = "seq", delay: str = "0 seconds") -> DataFrame:
    """Window contents (A12) on a stream, long form: every element with its arrival rank in its
    (key, tumbling window), emitted as it arrives (append), ``value`` unchanged. Rows of a window
    are taken while it is open, in whatever time order they come."""
    size_us = interval_us(size)
    d = _by_window(df, key, ts, size, seq, delay, F.unix_micros(F.col(ts).cast("timestamp")).alias("us"),
                   F.col(value).alias("value"))
    columns = ["key", "window_start_us", "seq", "us", "value"]
    schema = T.StructType([*d.select(*columns).schema.fields, T.StructField("pos", T.LongType())])
    out = d.groupBy("key", "window_start_us").applyInPandasWithState(
        contents_state_fn(size_us, columns), schema, CONTENTS_STATE, "append", "EventTimeTimeout")
    start = F.timestamp_micros("window_start_us")
    return out.select(F.col("key").alias(key), start.alias("window_start"),
                      (start + F.expr(f"INTERVAL {size_us} MICROSECONDS")).alias("window_end"),
                      "pos", F.col("seq").alias(seq), F.timestamp_micros("us").alias(ts),
                      F.col("value").alias(value))


def uv_first_sight_stream(views: DataFrame, ts: str, user: str, size: str, seq: str = "seq",
                          delay: str = "0 seconds", buckets: int = 1) -> DataFrame:
    """Distinct users so far per tumbling window, emitted at each user's first view of the window
    (a repeat view would emit the unchanged count). Watermarked de-duplication of (window, user),
    then a counter: all state is bounded by the watermark, none holds a user set. With ``buckets``
    above 1 a busy window is spread: ``uv`` then counts within the row's ``bucket`` of users, and a
    window's number of users is the sum of the largest ``uv`` of its buckets."""
    size_us = interval_us(size)
    v = event_time(views, ts).withWatermark(ts, delay)
    # the window is the one event-time column carried on
    firsts = v.select(F.window(ts, size).alias("w"), F.col(user).cast("string").alias("user_id"),
                      F.col(seq).cast("long").alias("seq")).dropDuplicates(["w", "user_id"])
    keyed = firsts.select("w", F.unix_micros(F.col("w.start")).alias("window_start_us"), "seq",
                          "user_id", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")
                          .alias("bucket"))
    out = keyed.groupBy("window_start_us", "bucket").applyInPandasWithState(
        uv_counter_fn(size_us), UV_OUTPUT, UV_STATE, "append", "EventTimeTimeout")
    return out.select(F.timestamp_micros("window_start_us").alias("window_start"),
                      F.col("seq").alias(seq), "user_id", "uv",
                      *(["bucket"] if buckets > 1 else []))
