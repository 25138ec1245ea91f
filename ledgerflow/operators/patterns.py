"""'A followed by B within T' per key (relaxed contiguity), with timeouts.

Each A pairs with the first B after it on the same key -- "after" in (event time, arrival) order --
and matches when ``B.ts - A.ts < within``; otherwise it times out (at the end of a bounded input
every open A times out). Several A's may share one B.

Plan: no self-join. A blocked reverse running minimum of the B events' (time, arrival) gives each
A its next B; the key's rows are cut into time blocks, so a hot key is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.panes import interval_us
from ..plans.prefix import running

# Result labels of the order-pay pattern.
PAID = "payed successfully"
TIMEOUT = "timeout"


def next_follow(df: DataFrame, key: str, kind: str, first: str, then: str, within: str,
                ts: str = "ts", seq: str = "seq", block: str = "1 hour") -> DataFrame:
    """One row per ``first`` event with the time and arrival of the next ``then`` event
    (``next_ts``/``next_seq``, null when there is none) and ``matched`` (next within the limit).

    The next ``then`` is a running minimum of ``(ts, seq)`` over the key's later rows: a blocked
    prefix scan in descending order (``plans.prefix.running``) with time blocks of ``block``, so
    a hot key is spread over its blocks and no pairs are formed. The block length does not change
    the result.
    """
    lim_us = interval_us(within)
    blk_us = interval_us(block)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.select(key, kind, ts, seq)
    cand = F.when(F.col(kind) == then, F.struct(F.col(ts).alias("t"), F.col(seq).alias("s")))
    r = running(d, [key], [F.col(ts).desc(), F.col(seq).desc()], -F.floor(us / blk_us),
                {"_n": ("min", cand)}, inclusive=False)
    r = (r.where(F.col(kind) == first)
         .select(key, ts, seq, F.col("_n.t").alias("next_ts"), F.col("_n.s").alias("next_seq")))
    ok = F.col("next_ts").isNotNull() & (
        F.col("next_ts") < F.col(ts) + F.expr(f"INTERVAL {lim_us} MICROSECONDS"))
    return r.withColumn("matched", F.coalesce(ok, F.lit(False)))


def drop_late_rows(df: DataFrame, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Drop rows behind an ascending watermark: event time earlier than the largest event time
    that arrived before them (what an event-time pattern operator discards as late)."""
    from .lateness import with_watermark_before
    w = with_watermark_before(df, ts, seq)
    keep = F.col("max_ts_before").isNull() | (F.col(ts) >= F.col("max_ts_before"))
    return w.where(keep).drop("max_ts_before")


def followed_by(df: DataFrame, key: str, kind: str, first: str, then: str, within: str,
                ts: str = "ts", seq: str = "seq", block: str = "1 hour",
                strict_late: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(matches, timeouts)``.

    matches: ``key, first_seq, first_ts, next_seq, next_ts, result``; timeouts: ``key, first_seq,
    first_ts, result``. ``strict_late=True`` first drops rows that arrive behind an ascending
    watermark (see :func:`drop_late_rows`); by default every row takes part.
    """
    if strict_late:
        df = drop_late_rows(df, ts, seq)
    n = next_follow(df, key, kind, first, then, within, ts, seq, block)
    matches = n.where("matched").select(
        key, F.col(seq).alias("first_seq"), F.col(ts).alias("first_ts"), "next_seq", "next_ts",
        F.lit(PAID).alias("result"))
    timeouts = n.where(~F.col("matched")).select(
        key, F.col(seq).alias("first_seq"), F.col(ts).alias("first_ts"),
        F.lit(TIMEOUT).alias("result"))
    return matches, timeouts
