"""Batch models of window triggers: early (interval) firing and count firing.

In streaming, early firing is ``outputMode("update")`` with a processing-time trigger and the final
result an ``append`` query; here each firing is a row, so the result is reproducible and testable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.panes import interval_us
from ..plans.prefix import running


def early_firing(df: DataFrame, key: str, ts: str, size: str, interval: str,
                 value: str = "value") -> DataFrame:
    """Accumulating early results every ``interval`` (aligned ticks) while a window is open, then
    the final result at window end.

    An element is first included by the firing at the next interval boundary after it (capped at
    the window end); early firings happen only at ticks that saw new data (the intended behaviour
    of the reference trigger). Output per firing: ``fire_time``, ``fire_kind`` ('early'/'final'),
    cumulative ``cum_count``, ``cum_sum`` and ``cum_max`` of ``value``.

    One aggregate per (key, window, tick) and one window pass over the ticks (at most
    size / interval per window, bounded by time) yield both the early rows and the final row.
    """
    iv = interval_us(interval)
    w = F.window(ts, size)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    tick_free = F.timestamp_micros(us - F.pmod(us, F.lit(iv)) + F.lit(iv)).cast(
        df.schema[ts].dataType)
    d = df.select(key, w.start.alias("window_start"), w.end.alias("window_end"), ts, value)
    d = d.withColumn("fire_time", F.least(tick_free, F.col("window_end")))
    per_tick = d.groupBy(key, "window_start", "window_end", "fire_time").agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"), F.max(value).alias("m"))
    part = Window.partitionBy(key, "window_start")
    wt = part.orderBy("fire_time").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = per_tick.select(key, "window_start", "window_end", "fire_time",
                          F.sum("n").over(wt).alias("cum_count"),
                          F.sum("s").over(wt).alias("cum_sum"),
                          F.max("m").over(wt).alias("cum_max"),
                          (F.col("fire_time") == F.max("fire_time").over(part)).alias("_last"))
    kinds = F.array(
        F.when(F.col("fire_time") < F.col("window_end"),
               F.struct(F.col("fire_time").alias("t"), F.lit("early").alias("k"))),
        F.when(F.col("_last"), F.struct(F.col("window_end").alias("t"), F.lit("final").alias("k"))))
    out = cum.select("*", F.explode(kinds).alias("_f")).where(F.col("_f").isNotNull())
    return out.select(key, "window_start", "window_end", F.col("_f.t").alias("fire_time"),
                      F.col("_f.k").alias("fire_kind"), "cum_count", "cum_sum", "cum_max")


def count_firing(df: DataFrame, key: str, ts: str, size: str, n: int, value: str = "value",
                 seq: str = "seq", block: str = "1 hour") -> DataFrame:
    """Fire every ``n`` elements of a (key, tumbling window), accumulating (fire, no purge).

    The k-th firing happens at the element of rank k*n (by time, then arrival) and covers
    ranks 1..k*n; a trailing partial group does not fire. One blocked prefix scan gives every
    element its rank, running sum and running max; the firing rows are the elements whose
    rank is a multiple of ``n``. Output: ``fire_no``, ``cum_count``, ``cum_sum``,
    ``cum_max`` of ``value``.
    """
    w = F.window(ts, size)
    d = df.select(key, w.start.alias("window_start"), w.end.alias("window_end"), ts, seq, value)
    blk = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(interval_us(block)))
    r = running(d, [key, "window_start"], [F.col(ts), F.col(seq)], blk,
                {"pos": ("count", F.lit(1)), "cum_sum": ("sum", F.col(value)),
                 "cum_max": ("max", F.col(value))})
    return (r.where(F.col("pos") % n == 0)
            .select(key, "window_start", "window_end",
                    (F.col("pos") / n).cast("bigint").alias("fire_no"),
                    F.col("pos").cast("bigint").alias("cum_count"), "cum_sum", "cum_max"))
