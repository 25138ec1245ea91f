"""User-behaviour aggregates: running averages, unique visitors, sliding counts, per-window
max-by and window contents, condition-fired segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import BITMAP_BITS, HASH_SEED, poly_hash
from ..plans.panes import interval_us, sliding_aggregate
from ..plans.prefix import GROUP, running

DEFAULT_BLOCK_ROWS = 1 << 20


def seq_block(seq: str = "seq", rows: int = DEFAULT_BLOCK_ROWS) -> Column:
    """Block id along an arrival sequence: at most ``rows`` arrivals per block."""
    return F.floor(F.col(seq) / F.lit(rows))


def _window_cols(w: str = "w") -> list[Column]:
    return [F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end")]


# ------------------------------------------------------------------ A7 / A13
def running_average(marks: DataFrame, name: str = "name", mark: str = "mark", seq: str = "seq",
                    block_rows: int = DEFAULT_BLOCK_ROWS, with_block: bool = False) -> DataFrame:
    """Per-name running sum and count in arrival order; ``avg_mark`` = sum / count.

    Decimals stay exact in their own scale s, with the average rounded half up to max(6, s + 4)
    places; floating point marks give double sums and averages. ``with_block=True`` keeps the
    arrival-block column ``blk`` for a chained scan.
    """
    kind = marks.schema[mark].dataType
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0 if isinstance(kind, T.IntegralType) \
        else None
    sums, avgs = ("double", "double") if scale is None else \
        (f"decimal(38,{scale})", f"decimal(38,{max(6, scale + 4)})")
    m = marks.select(name, seq, F.col(mark).cast(sums).alias("mark"),
                     seq_block(seq, block_rows).alias("blk"))
    r = running(m, [name], [F.col(seq)], "blk",
                {"run_sum": ("sum", F.col("mark")), "run_cnt": ("count", F.col("mark"))},
                keep_keys=with_block)
    return r.select(name, seq, F.col("run_sum").cast(sums).alias("run_sum"),
                    F.col("run_cnt").alias("count"),
                    (F.col("run_sum") / F.col("run_cnt")).cast(avgs).alias("avg_mark"),
                    *(["blk", GROUP] if with_block else []))


def purge_segments(avgs: DataFrame, threshold: float = 80, name: str = "name", seq: str = "seq",
                   block_rows: int = DEFAULT_BLOCK_ROWS, condition: Column | None = None) -> DataFrame:
    """Global window per name, fired (and purged) when the running average passes ``threshold``, or
    when ``condition`` (any predicate over the columns of ``avgs``) holds; each firing emits the
    max-average element since the previous firing.

    Segment id = number of *earlier* firings of the name (a blocked exclusive prefix count), so
    rows between two firings share a segment; open segments (no firing yet) emit nothing. The
    threshold test is ``run_sum > threshold * count``, exact on decimals.
    """
    if condition is None:
        condition = F.col("run_sum") > F.lit(threshold) * F.col("count")
    fire = F.coalesce(condition, F.lit(False)).cast("int")
    f = avgs.withColumn("fire", fire)
    # reuse the block column of running_average(with_block=True): same (name, block) partitioning
    blk = "blk" if "blk" in avgs.columns else seq_block(seq, block_rows)
    seg = running(f, [name], [F.col(seq)], blk,
                  {"segment": ("sum", F.col("fire"))}, inclusive=False)
    seg = seg.withColumn("segment", F.coalesce(F.col("segment"), F.lit(0)).cast("bigint"))
    best = F.max_by(F.struct(seq, "avg_mark", "count"), F.struct(F.col("avg_mark"), -F.col(seq)))
    g = (seg.groupBy(name, "segment")
         .agg(F.max("fire").alias("closed"), best.alias("b"))
         .where(F.col("closed") == 1))
    return g.select(name, "segment", F.col(f"b.{seq}").alias(seq),
                    F.col("b.avg_mark").alias("avg_mark"), F.col("b.count").alias("count"))


# ------------------------------------------------------------------ A8 / A9 / T11
def uv_exact(views: DataFrame, ts: str, user: str, size: str) -> DataFrame:
    """Exact distinct users per tumbling window (Spark plans it as (window, user) then window)."""
    g = views.groupBy(F.window(ts, size).alias("w")).agg(F.count_distinct(user).alias("uv"))
    return g.select(*_window_cols(), "uv")


def uv_bitmap(views: DataFrame, ts: str, user: str, size: str, seed: int = HASH_SEED,
              cap: int = BITMAP_BITS) -> DataFrame:
    """Distinct hashed users per window: the bits that are set in a window's bitmap (one-hash Bloom
    filter count).

    A set bit is one (window, bit) row, made distinct before the shuffle and counted per window. Whole
    bitmaps are not built: they are nearly empty, and each map task would send its own.
    """
    h = poly_hash(F.col(user).cast("string"), seed, cap)
    bits = views.select(F.window(ts, size).alias("w"), h.alias("h")).distinct()
    g = bits.groupBy("w").agg(F.count("h").alias("uv"))
    return g.select(*_window_cols(), "uv")


def uv_approx(views: DataFrame, ts: str, user: str, size: str, rsd: float = 0.01) -> DataFrame:
    """HyperLogLog++ distinct users per window (fixed-size state, mergeable partials)."""
    g = views.groupBy(F.window(ts, size).alias("w")).agg(
        F.approx_count_distinct(user, rsd).alias("uv"))
    return g.select(*_window_cols(), "uv")


def uv_running(views: DataFrame, ts: str, user: str, size: str, seq: str = "seq",
               block_rows: int = DEFAULT_BLOCK_ROWS, hashed: bool = False) -> DataFrame:
    """Fire-and-purge on every element: after each view, the distinct users of its window so far.

    A user's first view in a window adds one. The first views are a partially aggregated min per
    (window, user); as rows of their own they join the window's views in one blocked prefix scan along the
    arrivals, so no view looks up its user, and neither a busy window nor a busy user meets in one task.
    ``hashed=True`` counts distinct ``poly_hash`` bit indexes instead (the bitmap job's notion of a new
    user: its bit was unset). Views without a user are left out.
    """
    ident = poly_hash(F.col(user).cast("string")) if hashed else F.col(user)
    w = F.window(ts, size)
    d = views.select(w.start.alias("window_start"), w.end.alias("window_end"), F.col(user).alias("user_id"),
                     ident.alias("_id"), F.col(seq).alias("_seq"), F.lit(0).alias("_new")).where("_id IS NOT NULL")
    firsts = d.groupBy("window_start", "window_end", "_id").agg(F.min("_seq").alias("_seq"))
    firsts = firsts.select("window_start", "window_end", F.lit(None).cast(d.schema["user_id"].dataType).alias("user_id"),
                           "_seq", F.lit(1).alias("_new"))
    both = d.drop("_id").unionByName(firsts)
    r = running(both, ["window_start"], [F.col("_seq"), F.col("_new").desc()], seq_block("_seq", block_rows),
                {"uv": ("sum", F.col("_new"))})
    return r.where("_new = 0").select("window_start", "window_end", F.col("_seq").alias(seq), "user_id",
                                      F.col("uv").cast("bigint"))


# ------------------------------------------------------------------ A10
def sliding_counts(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str],
                   use_panes: bool = True) -> DataFrame:
    """Count per (sliding window, keys) via the pane rewrite (see ``plans.panes``)."""
    return sliding_aggregate(df, ts, size, slide, keys, count_name="count", use_panes=use_panes)


# ------------------------------------------------------------------ A11 / A12
def window_max_by(df: DataFrame, key: str, ts: str, size: str, value: str = "value",
                  seq: str = "seq", cols: Sequence[str] = ("ts", "value")) -> DataFrame:
    """Element with the largest ``value`` per (key, tumbling window); the earliest arrival wins a tie.

    ``max_by`` is an ordinary aggregate (partial + final), no sort of the group.
    """
    payload = F.struct(F.col(seq).alias(seq), *[F.col(c) for c in cols])
    g = df.groupBy(key, F.window(ts, size).alias("w")).agg(
        F.max_by(payload, F.struct(F.col(value), -F.col(seq))).alias("m"))
    return g.select(key, *_window_cols(), *[F.col(f"m.{c}").alias(c) for c in (seq, *cols)])


def window_last(df: DataFrame, ts: str, size: str, value: str, seq: str = "seq") -> DataFrame:
    """``value`` of the last arrival of each tumbling window: an ordinary ``max_by`` aggregate."""
    g = df.groupBy(F.window(ts, size).alias("w")).agg(F.max_by(value, seq).alias(value),
                                                      F.max(seq).alias(seq))
    return g.select(*_window_cols(), seq, value)


def window_contents(df: DataFrame, key: str, ts: str, size: str, seq: str = "seq",
                    block: str = "1 hour", cols: Sequence[str] = ("value",)) -> DataFrame:
    """All elements of each (key, tumbling window), in (time, arrival) order, as ranked rows.

    The list is kept in long form (one row per element with its 1-based ``pos``) rather than
    collected into one value, so no group is ever materialised in one task; ranks come from
    a blocked prefix count with ``block``-long time blocks.
    """
    d = df.select(key, F.window(ts, size).start.alias("window_start"),
                  F.window(ts, size).end.alias("window_end"), ts, seq, *cols)
    blk = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) /
                  F.lit(interval_us(block)))
    r = running(d, [key, "window_start"], [F.col(ts), F.col(seq)], blk,
                {"pos": ("count", F.lit(1))})
    return r.select(key, "window_start", "window_end", "pos", seq, ts, *cols)

