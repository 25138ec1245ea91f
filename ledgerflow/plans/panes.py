"""Sliding-window aggregation through panes.

``groupBy(window(ts, size, slide))`` copies every input row into ``size/slide`` windows before the
aggregate (an ``Expand`` of 360x for 1 h / 10 s, whose generated code is even too large to compile).
When ``size`` is a multiple of ``slide`` each window is the union of ``size/slide`` consecutive
panes of length ``slide``, so rows are first aggregated into panes (one pass with map-side partial
aggregation) and only pane rows are taken further:

* ``deltas`` (counts and exact sums): a pane contributes ``+n`` at the start of the first window
  holding it and ``-n`` at the start of the first window past it. A blocked prefix sum over these
  change points per key gives the window value, constant up to the next change point; each such
  run is expanded into its window starts. Work is proportional to panes plus output windows, with
  no per-window re-aggregation.
* ``ranges`` (default): the same change points, but the value of a window is *local* -- the sum
  of the panes in ``[start, start + size)`` -- so no global prefix is needed. Per key, time is cut
  into blocks (by default at least ``size`` long); every pane and change point is copied into the
  blocks whose change points can reach it (at most two with the default), and two bounded
  ``RANGE`` frames over
  ``(key, block)`` give each change point its window value and the next change point. One
  shuffle after the pane aggregate, no joins, nothing re-read.
* ``explode``: each pane row is copied into its ``size/slide`` windows and re-aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix import running

_UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
          "day": 86400, "days": 86400, "millisecond": 0.001, "milliseconds": 0.001,
          "microsecond": 0.000001, "microseconds": 0.000001}


def interval_us(text: str) -> int:
    """Microseconds of an interval text such as ``500 milliseconds`` or ``1 hour 30 minutes``."""
    parts = text.split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval: {text!r}")
    return sum(round(float(n) * _UNITS[unit.lower()] * 1_000_000)
               for n, unit in zip(parts[::2], parts[1::2]))


def interval_seconds(text: str) -> float:
    return interval_us(text) / 1_000_000


def _iv(us: int) -> Column:
    return F.expr(f"INTERVAL {us} MICROSECONDS")


def sliding_aggregate(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str],
                      sums: dict[str, Column] | None = None, count_name: str | None = "count",
                      use_panes: bool = True, method: str = "auto",
                      block: str | None = None) -> DataFrame:
    """Sliding-window ``count(*)`` and ``sum(col)`` per ``keys``.

    Output: ``window_start, window_end, *keys, <count_name>, *sums`` for every window holding at
    least one row. ``method``: ``'ranges'`` (default), ``'deltas'`` (exact sum types only),
    ``'explode'``; ``use_panes=False`` or a size that is not a multiple of the slide uses the plain
    ``F.window`` form. ``block`` is the time block of the ``ranges`` method (default: the larger of
    ``size`` and one day); it does not change the result.
    """
    sums = sums or {}
    keys = list(keys)
    size_s, slide_s = interval_seconds(size), interval_seconds(slide)
    ratio = size_s / slide_s
    if not use_panes or abs(ratio - round(ratio)) > 1e-9:
        aggs = ([F.count(F.lit(1)).alias(count_name)] if count_name else []) + \
               [F.sum(c).alias(n) for n, c in sums.items()]
        g = df.groupBy(F.window(ts, size, slide).alias("w"), *keys).agg(*aggs)
        return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        *keys, *([count_name] if count_name else []), *sums.keys())

    panes = (df.groupBy(F.window(ts, slide).start.alias("pane_start"), *keys)
             .agg(F.count(F.lit(1)).alias("_pane_n"),
                  *[F.sum(c).alias(f"_pane_{n}") for n, c in sums.items()]))
    exact = all(isinstance(panes.schema[f"_pane_{n}"].dataType,
                           (T.IntegralType, T.DecimalType)) for n in sums)
    if method == "auto":
        method = "ranges"
    if method == "deltas" and not exact:
        raise ValueError("method='deltas' needs integral or decimal sums")
    size_us, slide_us = int(round(size_s * 1e6)), int(round(slide_s * 1e6))
    if method == "ranges":
        blk = int(interval_seconds(block) * 1e6) if block else None
        out = _by_ranges(panes, keys, list(sums), size_us, slide_us, df.schema[ts].dataType, blk)
    elif method == "deltas":
        out = _by_deltas(panes, keys, list(sums), size_us, slide_us)
    else:
        out = _by_explode(panes, keys, list(sums), int(round(ratio)), size_us, slide_us)
    cols = ["window_start", F.col("window_start") + _iv(size_us), *keys]
    return out.select(cols[0], cols[1].alias("window_end"), *keys,
                      *([F.col("_n").alias(count_name)] if count_name else []),
                      *[F.col(f"_s_{n}").alias(n) for n in sums])


def _by_explode(panes, keys, sums, n, size_us, slide_us):
    # window(pane_start, size, slide) would expand into n projections (too much generated code
    # for large n): an explicit generator instead.
    k = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_k")
    start = F.col("pane_start") - _iv(slide_us) * F.col("_k")
    return (panes.select("*", k).groupBy(start.alias("window_start"), *keys)
            .agg(F.sum("_pane_n").alias("_n"), *[F.sum(f"_pane_{s}").alias(f"_s_{s}") for s in sums]))


def _by_deltas(panes, keys, sums, size_us, slide_us):
    vals = ["_pane_n", *[f"_pane_{s}" for s in sums]]
    enter = panes.select(*keys, (F.col("pane_start") - _iv(size_us - slide_us)).alias("pos"),
                         *[F.col(v) for v in vals])
    leave = panes.select(*keys, (F.col("pane_start") + _iv(slide_us)).alias("pos"),
                         *[(-F.col(v)).alias(v) for v in vals])
    deltas = enter.unionByName(leave).groupBy(*keys, "pos").agg(*[F.sum(v).alias(v) for v in vals])
    day = F.datediff(F.to_date("pos"), F.lit("1970-01-01").cast("date"))
    level = running(deltas, keys, [F.col("pos")], day,
                    {"_n": ("sum", "_pane_n"), **{f"_s_{s}": ("sum", f"_pane_{s}") for s in sums}})
    nxt = running(level, keys, [F.col("pos").desc()], -day,
                  {"_next": ("min", F.col("pos"))}, inclusive=False)
    starts = F.explode(F.sequence(F.col("pos"), F.col("_next") - _iv(slide_us), _iv(slide_us)))
    return nxt.where(F.col("_n") > 0).select(starts.alias("window_start"), *keys, "_n",
                                            *[f"_s_{s}" for s in sums])


def _by_ranges(panes, keys, sums, size_us, slide_us, ts_type, block_us=None):
    from .prefix import GROUP
    blk_us = block_us or max(size_us, 86_400_000_000)
    p = F.unix_micros(F.col("pane_start").cast("timestamp"))
    zero = [F.lit(0).cast(panes.schema[f"_pane_{x}"].dataType).alias(f"_pane_{x}") for x in sums]
    vals = [F.col(f"_pane_{x}") for x in sums]
    # a pane (kind 0) and its two change points (kind 1): first window holding it, first past it
    items = F.array(
        F.struct(p.alias("pos"), F.lit(0).alias("kind"), F.col("_pane_n").alias("n"), *vals),
        F.struct((p - (size_us - slide_us)).alias("pos"), F.lit(1).alias("kind"),
                 F.lit(0).cast("bigint").alias("n"), *zero),
        F.struct((p + slide_us).alias("pos"), F.lit(1).alias("kind"),
                 F.lit(0).cast("bigint").alias("n"), *zero))
    rows = panes.select(F.struct(*keys).alias(GROUP), *keys, F.explode(items).alias("r")).select(
        GROUP, *keys, "r.*")
    pos = F.col("pos")
    # blocks whose change points can reach the row: a pane at p is summed by change points in
    # (p - size, p]; a change point at q is the "next" of change points in [q - size, q), and it
    # is also needed in its own block, where it is emitted
    lo = F.when(F.col("kind") == 0, pos - size_us + 1).otherwise(pos - size_us)
    hi = pos
    rows = rows.select("*", F.floor(pos / blk_us).alias("_home"),
                       F.explode(F.sequence(F.floor(lo / blk_us), F.floor(hi / blk_us))).alias("_blk"))
    rows = rows.repartition(GROUP, "_blk")
    # same (key, block, time, kind) from several panes: merge (no shuffle: already clustered)
    # (the key columns depend on the group struct; listing them keeps a hash aggregate)
    merged = rows.groupBy(GROUP, "_blk", "pos", "kind", *keys).agg(
        F.max((F.col("_home") == F.col("_blk")).cast("int")).alias("home"), F.sum("n").alias("n"),
        *[F.sum(f"_pane_{x}").alias(f"_pane_{x}") for x in sums])
    w = Window.partitionBy(GROUP, "_blk").orderBy("pos")
    val = w.rangeBetween(0, size_us - 1)
    ahead = w.rangeBetween(1, size_us)
    cur = merged.select(
        "*", F.sum("n").over(val).alias("_n"),
        *[F.sum(f"_pane_{x}").over(val).alias(f"_s_{x}") for x in sums],
        F.min(F.when(F.col("kind") == 1, pos)).over(ahead).alias("_next"))
    live = cur.where((F.col("kind") == 1) & (F.col("home") == 1) & (F.col("_n") > 0))
    starts = F.explode(F.sequence(pos, F.col("_next") - slide_us, F.lit(slide_us)))
    out = live.select(starts.alias("_start_us"), *keys, "_n", *[f"_s_{x}" for x in sums])
    return out.select(F.timestamp_micros("_start_us").cast(ts_type).alias("window_start"),
                      *keys, "_n", *[f"_s_{x}" for x in sums])
