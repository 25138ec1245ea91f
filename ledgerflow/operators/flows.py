"""Money-flow aggregates over classified DC records (output of ``functions.classify_dc``).

All are single ``groupBy`` aggregates: Spark runs a partial (map-side) aggregate before the one
shuffle on the grouping keys, so the shuffle carries one row per key and task, not one per record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import DIR_IN, DIR_OUT, recognised
from ..plans.prefix import running
from ..schemas import MONEY

NET_KEYS = ("date", "time", "ccy_cod", "brn")
WINDOW_KEYS = ("act_nbr", "ccy_cod", "brn", "date", "time")


def _money_sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast(MONEY)).cast(MONEY)


def dc_direction_sum(tx: DataFrame, keys: Sequence[str] = NET_KEYS) -> DataFrame:
    """Signed amount per (keys, direction); unrecognised codes dropped."""
    return (recognised(tx).groupBy(*keys, "direction")
            .agg(_money_sum(F.col("signed_amt")).alias("amt")))


def dc_net_flow(tx: DataFrame, keys: Sequence[str] = NET_KEYS) -> DataFrame:
    """One row per key with out, in and net amounts; an absent side is 0.

    Conditional sums in one aggregate replace the per-direction reduce followed by a second
    group-and-pivot shuffle: one shuffle in total.
    """
    d = F.col("direction")
    return (recognised(tx).groupBy(*keys).agg(
        _money_sum(F.when(d == DIR_OUT, F.col("signed_amt"))).alias("out_amt"),
        _money_sum(F.when(d == DIR_IN, F.col("signed_amt"))).alias("in_amt"),
        _money_sum(F.col("signed_amt")).alias("sum_amt")))


def dc_tumbling_sum(tx: DataFrame, size: str, time_col: str = "proc_ts",
                    keys: Sequence[str] = NET_KEYS, keep_unmatched: bool = False) -> DataFrame:
    """Tumbling-window signed sum per (window, keys, direction).

    ``keep_unmatched=True`` keeps unrecognised codes as one group per window, with null keys, null
    direction and sum 0.
    """
    src = recognised(tx)
    if keep_unmatched:
        src = tx.withColumns({k: F.when(F.col("direction").isNotNull(), F.col(k)) for k in keys})
    g = src.groupBy(F.window(time_col, size).alias("w"), *keys, "direction").agg(
        _money_sum(F.col("signed_amt")).alias("amt"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "direction", "amt")


def dc_window_inout(tx: DataFrame, size: str, time_col: str = "proc_ts",
                    keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Tumbling-window in and out amounts per (window, keys) in one incremental aggregate."""
    d = F.col("direction")
    g = recognised(tx).groupBy(F.window(time_col, size).alias("w"), *keys).agg(
        _money_sum(F.when(d == DIR_IN, F.col("signed_amt"))).alias("in_amt"),
        _money_sum(F.when(d == DIR_OUT, F.col("signed_amt"))).alias("out_amt"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "in_amt", "out_amt")


def dc_running_total(win: DataFrame, keys: Sequence[str] = WINDOW_KEYS,
                     block: Column | None = None) -> DataFrame:
    """Cumulative in, out and net per key across its windows, one row per window result.

    The input holds one row per (key, window), so a key has at most (time span / window size)
    rows however much raw data it had: a per-key window over it is bounded by time, not by data
    volume. ``block`` (e.g. the calendar day of ``window_end``) switches to the blocked prefix scan
    of ``plans.prefix.running`` for keys with very long histories of very short windows.
    """
    if block is None:
        w = (Window.partitionBy(*keys).orderBy("window_end")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        r = win.select("*", F.sum("in_amt").over(w).alias("cum_in"),
                       F.sum("out_amt").over(w).alias("cum_out"))
    else:
        r = running(win, keys, [F.col("window_end")], block,
                    {"cum_in": ("sum", F.col("in_amt")), "cum_out": ("sum", F.col("out_amt"))})
    return r.select(*keys, "window_start", "window_end",
                    F.col("cum_in").cast(MONEY).alias("cum_in"),
                    F.col("cum_out").cast(MONEY).alias("cum_out"),
                    (F.col("cum_in") + F.col("cum_out")).cast(MONEY).alias("cum_net"))


def fc_sum(fc: DataFrame, keys: Sequence[str] = ("act_nbr", "ccy_cod", "dir")) -> DataFrame:
    """Unsigned amount per (account, currency, book direction)."""
    return fc.groupBy(*keys).agg(_money_sum(F.col("amt")).alias("amt"))
