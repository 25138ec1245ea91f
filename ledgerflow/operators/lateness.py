"""Late-data side output, defined on arrival order so that it is deterministic.

A row is late when the latest window containing it had already closed by the time it arrived:
``window_end - 1 ms <= watermark``, where the watermark is the largest event time seen *before*
the row arrived minus the out-of-orderness bound (minus 1 ms for an ascending watermark, which
cancels the 1 ms of the window's max timestamp).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.panes import interval_us
from ..plans.prefix import running

DEFAULT_BLOCK_ROWS = 1 << 20
DEFAULT_FANOUT = 1024


def with_watermark_before(df: DataFrame, ts: str, arrival: str,
                          block_rows: int = DEFAULT_BLOCK_ROWS,
                          fanout: int = DEFAULT_FANOUT) -> DataFrame:
    """Add ``max_ts_before``: the largest ``ts`` among rows that arrived before this one.

    A global prefix maximum without a single-task window: blocks of ``block_rows`` arrivals, block
    maxima prefixed in blocks of ``fanout`` again (see ``plans.prefix``). ``arrival`` must be a
    unique, dense-ish integer sequence (offsets, sequence numbers).
    """
    return running(df, [], [F.col(arrival)], F.floor(F.col(arrival) / F.lit(block_rows)),
                   {"max_ts_before": ("max", F.col(ts))}, inclusive=False, fanout=fanout)


def late_flag(df: DataFrame, ts: str, arrival: str, size: str, slide: str | None = None,
              delay: str = "0 seconds", **kw) -> DataFrame:
    """Add ``window_end`` (of the latest window holding the row) and boolean ``is_late``."""
    delay_us = interval_us(delay)
    w = F.window(ts, slide or size)  # latest window containing ts starts at its slide bucket
    last_end = w.start + F.expr(f"INTERVAL {interval_us(size)} MICROSECONDS") \
        if slide else w.end
    d = with_watermark_before(df, ts, arrival, **kw).withColumn("window_end", last_end)
    # Late iff window_end - 1 ms <= max_before - delay; an ascending watermark (delay 0) is
    # max_before - 1 ms, so the two 1 ms terms cancel.
    wm = F.col("max_ts_before") if delay_us == 0 else \
        F.col("max_ts_before") - F.expr(f"INTERVAL {delay_us - 1000} MICROSECONDS")
    return d.withColumn("is_late", F.coalesce(F.col("window_end") <= wm, F.lit(False)))


def late_split(df: DataFrame, ts: str, arrival: str, size: str, slide: str | None = None,
               delay: str = "0 seconds", **kw) -> tuple[DataFrame, DataFrame]:
    """Return ``(on_time, late)``; together they hold every input row exactly once.

    Both are filters over one flagged plan: when both are written, persist the input (as the
    streaming runner does per micro-batch) or write ``late_flag`` once, partitioned by ``is_late``.
    """
    flagged = late_flag(df, ts, arrival, size, slide, delay, **kw)
    cols = df.columns + ["window_end"]
    return (flagged.where(~F.col("is_late")).select(*cols),
            flagged.where(F.col("is_late")).select(*cols))
