"""Interval join and tumbling-window join on an equal key.

Both are equi-joins on ``(key, time bucket)``, so a hot key is spread over its time buckets instead of
landing in one task; a hot bucket of the interval join can be split by AQE, one of the window join is
dealt into a grid. There is no nested-loop or cartesian step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.panes import interval_seconds


def _us(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def interval_join(left: DataFrame, right: DataFrame, key: str, lo: str, hi: str,
                  lts: str = "ts", rts: str = "ts", lcols: Sequence[str] = (),
                  rcols: Sequence[str] = (), bucket: str | None = None) -> DataFrame:
    """Pairs with equal ``key`` and ``left.ts + lo <= right.ts <= left.ts + hi`` (both inclusive).

    ``lo``/``hi`` are signed interval texts (e.g. ``'-90 minutes'``, ``'0 seconds'``). Time is cut
    into buckets of ``bucket`` (default ``hi - lo``, at least 1 s); each right row is copied into the
    left buckets its range can reach, so every matching pair meets in exactly one bucket.
    Output columns: ``key``, ``l_<c>`` for ``lts`` and ``lcols``, ``r_<c>`` for ``rts`` and ``rcols``.
    """
    lo_us = int(_signed_seconds(lo) * 1_000_000)
    hi_us = int(_signed_seconds(hi) * 1_000_000)
    if hi_us < lo_us:
        raise ValueError("interval join needs lo <= hi")
    width = int(interval_seconds(bucket) * 1_000_000) if bucket else max(hi_us - lo_us, 1_000_000)
    l = left.select(F.col(key).alias("_k"), *[F.col(c).alias(f"l_{c}") for c in (lts, *lcols)])
    l = l.withColumn("_b", F.floor(_us(f"l_{lts}") / width))
    r = right.select(F.col(key).alias("_k"), *[F.col(c).alias(f"r_{c}") for c in (rts, *rcols)])
    # right.ts in [l.ts+lo, l.ts+hi]  <=>  l.ts in [r.ts-hi, r.ts-lo]: the left buckets to reach.
    r_us = _us(f"r_{rts}")
    r = r.withColumn("_b", F.explode(F.sequence(F.floor((r_us - hi_us) / width),
                                                F.floor((r_us - lo_us) / width))))
    cond = (F.col(f"r_{rts}") >= F.col(f"l_{lts}") + F.expr(f"INTERVAL {lo_us} MICROSECONDS")) & \
           (F.col(f"r_{rts}") <= F.col(f"l_{lts}") + F.expr(f"INTERVAL {hi_us} MICROSECONDS"))
    j = l.join(r, ["_k", "_b"]).where(cond)
    return j.select(F.col("_k").alias(key), *[f"l_{c}" for c in (lts, *lcols)],
                    *[f"r_{c}" for c in (rts, *rcols)])


def _signed_seconds(text: str) -> float:
    t = text.strip()
    sign = -1.0 if t.startswith("-") else 1.0
    return sign * interval_seconds(t.lstrip("+-").strip())


#: Rows of one side of a (key, window) that meet in a task, at about the most.
PORTION_ROWS = 1 << 14


def _portions(side: DataFrame, own: str, other: str, hot: DataFrame) -> DataFrame:
    """Rows of a side with their grid cells: the row's own portion, and a copy for each of the other
    side's portions. Pairs that are not hot are one cell."""
    cells = side.join(hot, ["_k", "window_start"], "left")
    portion = F.pmod(F.xxhash64(*side.columns), F.coalesce(own, F.lit(1)))
    return cells.select(*side.columns, portion.alias(f"_p{own}"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.coalesce(other, F.lit(1)) - 1)).alias(f"_p{other}"))


def window_join(left: DataFrame, right: DataFrame, key: str, size: str, lts: str = "ts",
                rts: str = "ts", lcols: Sequence[str] = (), rcols: Sequence[str] = (),
                portion_rows: int = PORTION_ROWS) -> DataFrame:
    """All pairs with equal ``key`` in the same tumbling window (inner window join).

    An equi-join on ``(key, window_start)``. Pairs with more than ``portion_rows`` rows on a side are hot:
    their left rows are dealt into portions, their right rows too, and each portion of one side meets each
    portion of the other in a cell of its own. The table of hot pairs comes from counts that are combined
    map-side; it has at most rows / ``portion_rows`` entries, and how it is joined is left to Spark's size
    checks. Equal rows share a portion.
    """
    lw = F.window(lts, size)
    rw = F.window(rts, size)
    l = left.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), lw.start.alias("window_start"), lw.end.alias("window_end"),
        *[F.col(c).alias(f"l_{c}") for c in (lts, *lcols)])
    r = right.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), rw.start.alias("window_start"), *[F.col(c).alias(f"r_{c}") for c in (rts, *rcols)])

    def counts(side: DataFrame, name: str) -> DataFrame:
        return side.select("_k", "window_start", *[F.lit(int(n == name)).alias(n) for n in ("_l", "_r")])

    rows = counts(l, "_l").unionAll(counts(r, "_r")).groupBy("_k", "window_start").agg(
        F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    # a side without a row has no pairs, however many rows the other one has
    hot = rows.where(f"greatest(_l, _r) > {portion_rows} AND least(_l, _r) > 0").select(
        "_k", "window_start", *[F.ceil(F.col(c) / portion_rows).alias(c) for c in ("_l", "_r")])
    j = _portions(l, "_l", "_r", hot).join(_portions(r, "_r", "_l", hot), ["_k", "window_start", "_p_l", "_p_r"])
    return j.select(F.col("_k").alias(key), "window_start", "window_end",
                    *[f"l_{c}" for c in (lts, *lcols)], *[f"r_{c}" for c in (rts, *rcols)])
