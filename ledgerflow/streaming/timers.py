"""Window jobs on streams that keep their own timers: early and final firing in one query, sliding
counts from a ring of panes, condition-fired segments, and distinct users after every view.

Each keeps, per key in state, only what later results need: ticks that have not fired, panes that an open
window covers, the best element of the open segment, a bitmap. Numbers are summed exactly (decimals as
Python decimals, kept in state as text) and every function walks its rows frame by frame, so a micro-batch
is bounded by the source's ``max_per_trigger`` or ``max_files_per_trigger``.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator, Sequence
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import BITMAP_BITS, HASH_SEED, poly_hash
from ..operators.behavior import seq_block
from ..plans.panes import interval_us
from .runners import cumulative_sink, event_time

EXACT = Context(prec=100)


def _number(df: DataFrame, col: str) -> tuple[Column, T.DataType, Callable]:
    """A numeric column as sums are kept: (expression, type, from text). Integers become decimals."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.DecimalType, T.IntegralType)):
        scale = kind.scale if isinstance(kind, T.DecimalType) else 0
        return F.col(col).cast(f"decimal(38,{scale})"), T.DecimalType(38, scale), Decimal
    return F.col(col).cast("double"), T.DoubleType(), float


def _add(a, b):
    if a is None or b is None:
        return b if a is None else a
    return EXACT.add(a, b) if isinstance(a, Decimal) else a + b


def _most(a, b):
    return (b if a is None else a) if a is None or b is None else max(a, b)


def _values(column: pd.Series) -> list:
    return [None if v is None or v != v else v for v in column.tolist()]


def _text(value) -> str | None:
    return None if value is None else repr(value) if isinstance(value, float) else str(value)


def _after(state, at_us: int) -> None:
    """Wake the state up once the watermark has passed ``at_us``."""
    state.setTimeoutTimestamp(max(-(-at_us // 1000), state.getCurrentWatermarkMs() + 1))


# ------------------------------------------------------------------ T10
def early_state_fn(size_us: int, every_us: int, parse: Callable, columns: Sequence[str]):
    """Accumulating results of a (key, window): one at each interval boundary that has new rows, once
    the watermark has passed it, and one at the window's end. State: the total that has fired and one
    partial result per tick that has not, at most size / interval of them."""
    def read(text):
        return None if text is None else parse(text)

    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        start = int(key[1])
        end, mark = start + size_us, state.getCurrentWatermarkMs() * 1000
        count, total, most, ticks = 0, None, None, {}
        if state.exists:
            count, total, most, *partial = state.get
            total, most = read(total), read(most)
            ticks = {t: (n, read(s), read(m)) for t, n, s, m in zip(*partial)}
        if not state.hasTimedOut:
            for pdf in pdfs:
                us = pdf["us"].to_numpy()
                at = us - us % every_us + every_us
                if mark > 0:  # a tick that has fired does not change any more: the next one takes the row
                    at = np.maximum(at, mark - mark % every_us + every_us)
                for t, v in zip(np.minimum(at, end).tolist(), _values(pdf["value"])):
                    n, s, m = ticks.get(t, (0, None, None))
                    ticks[t] = (n + 1, _add(s, v), _most(m, v))
        out = []
        for t in sorted(ticks):
            if t <= mark:
                n, s, m = ticks.pop(t)
                count, total, most = count + n, _add(total, s), _most(most, m)
                if t < end:
                    out.append((key[0], start, t, "early", count, total, most))
        if end <= mark:
            out.append((key[0], start, end, "final", count, total, most))
            state.remove()
        else:
            at = sorted(ticks)
            state.update((count, _text(total), _text(most), at, [ticks[t][0] for t in at],
                          [_text(ticks[t][1]) for t in at], [_text(ticks[t][2]) for t in at]))
            _after(state, at[0] if at else end)
        if out:
            yield pd.DataFrame(out, columns=columns)
    return fn


def early_firing_stream(df: DataFrame, key: str, ts: str, size: str, interval: str,
                        value: str = "value", delay: str = "0 seconds") -> DataFrame:
    """Early and final firing (T10) of tumbling windows in one append-mode query, row for row as
    :func:`operators.triggers.early_firing`.

    A tick fires when the watermark passes it, so its result holds every row of its time that is at
    most ``delay`` late; a later row of a window that is still open counts from the next tick on. Rows of
    closed windows are dropped. Out-of-order rows within ``delay`` do not change any result.
    """
    size_us = interval_us(size)
    number, kind, parse = _number(df, value)
    d = event_time(df, ts).withWatermark(ts, delay)
    w = F.window(ts, size)
    d = d.select(F.col(key).alias("key"), w.alias("w"), F.unix_micros(w.start).alias("start_us"),
                 F.unix_micros(F.col(ts)).alias("us"), number.alias("value"))
    out_schema = T.StructType([
        T.StructField("key", df.schema[key].dataType), T.StructField("start_us", T.LongType()),
        T.StructField("fire_us", T.LongType()), T.StructField("fire_kind", T.StringType()),
        T.StructField("cum_count", T.LongType()), T.StructField("cum_sum", kind),
        T.StructField("cum_max", kind)])
    out = d.groupBy("key", "start_us").applyInPandasWithState(
        early_state_fn(size_us, interval_us(interval), parse, out_schema.names), out_schema,
        "count long, total string, most string, ticks array<long>, counts array<long>, "
        "totals array<string>, mosts array<string>", "append", "EventTimeTimeout")
    back = "bigint" if isinstance(df.schema[value].dataType, T.IntegralType) else kind
    return out.select(F.col("key").alias(key), F.timestamp_micros("start_us").alias("window_start"),
                      F.timestamp_micros(F.col("start_us") + size_us).alias("window_end"),
                      F.timestamp_micros("fire_us").alias("fire_time"), "fire_kind", "cum_count",
                      F.col("cum_sum").cast(back).alias("cum_sum"), F.col("cum_max").cast(
                          df.schema[value].dataType).alias("cum_max"))


# ------------------------------------------------------------------ A10 / T6
def ring_state_fn(size_us: int, slide_us: int, columns: Sequence[str]):
    """Sliding counts of a key from its panes: a window comes out when its last pane has closed. State:
    the panes that a later window covers (less than size / slide), and how far windows have come out."""
    covers = size_us // slide_us

    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs() * 1000
        upto, starts, counts = state.get if state.exists else (None, [], [])
        panes = dict(zip(starts, counts))
        if not state.hasTimedOut:
            for pdf in pdfs:
                for s, n in zip(pdf["pane_us"].tolist(), pdf["n"].tolist()):
                    panes[s] = panes.get(s, 0) + n
        at = np.array(sorted(panes), dtype="int64")
        number = np.array([panes[s] for s in at.tolist()], dtype="int64")
        # windows that hold a pane, are closed and have not come out yet; the last closed one starts here
        closed = mark - size_us - (mark - size_us) % slide_us
        first = np.unique((at[:, None] - slide_us * np.arange(covers)).ravel())
        due = first[first <= closed]
        if upto is not None:
            due = due[due > upto]
        before = np.concatenate([[0], np.cumsum(number)])
        n = before[np.searchsorted(at, due + size_us)] - before[np.searchsorted(at, due)]
        kept = at > closed
        if kept.any():
            state.update((int(closed) if upto is None else max(upto, int(closed)), at[kept].tolist(),
                          number[kept].tolist()))
            left = first[first > closed]
            _after(state, int(left[0]) + size_us)
        else:
            state.remove()
        if len(due):
            yield pd.DataFrame({**{f"key{i}": [k] * len(due) for i, k in enumerate(key)}, "start_us": due,
                                "count": n}, columns=columns)
    return fn


def _pane_counts(keys: Sequence[str]):
    """Rows of an Arrow batch counted per key and pane, with the latest time of each: what is shuffled
    are these counts, not the rows."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by([*keys, "pane_us"]).aggregate(
                [("us", "max"), ("us", "count")])
            yield from counted.select([*keys, "pane_us", "us_max", "us_count"]).rename_columns(
                [*keys, "pane_us", "last_us", "n"]).combine_chunks().to_batches()
    return fn


def sliding_ring_stream(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str],
                        delay: str = "0 seconds") -> DataFrame:
    """Sliding-window counts in append mode, as :func:`operators.behavior.sliding_counts`.

    Rows are counted into panes of ``slide`` before the shuffle, batch by batch. A pane's count goes once
    into its key's ring, never into the ``size / slide`` windows that hold it. Rows of closed panes are
    dropped. ``size`` must be a multiple of ``slide``.
    """
    size_us, slide_us = interval_us(size), interval_us(slide)
    if size_us % slide_us:
        raise ValueError("a ring of panes needs a size that is a multiple of the slide")
    named = [f"key{i}" for i in range(len(keys))]
    us = F.unix_micros(F.col(ts))
    rows = event_time(df, ts).where(F.col(ts).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, named)], (us - F.pmod(us, F.lit(slide_us))).alias("pane_us"), us.alias("us"))
    key_fields = [T.StructField(n, df.schema[k].dataType) for k, n in zip(keys, named)]
    longs = [T.StructField(n, T.LongType()) for n in ("pane_us", "last_us", "n")]
    panes = rows.mapInArrow(_pane_counts(named), T.StructType([*key_fields, *longs]))
    # the pane is the one event-time column carried on: late is what belongs to a closed pane
    panes = (panes.withColumn("last", F.timestamp_micros("last_us")).withWatermark("last", delay)
             .select(*named, "pane_us", "n", F.window("last", slide).alias("pane")))
    out_schema = T.StructType([*key_fields, T.StructField("start_us", T.LongType()), T.StructField("count", T.LongType())])
    out = panes.groupBy(*named).applyInPandasWithState(
        ring_state_fn(size_us, slide_us, out_schema.names), out_schema,
        "upto long, starts array<long>, counts array<long>", "append", "EventTimeTimeout")
    start = F.timestamp_micros("start_us")
    return out.select(start.alias("window_start"), F.timestamp_micros(F.col("start_us") + size_us).alias(
        "window_end"), *[F.col(n).alias(k) for k, n in zip(keys, named)], "count")


# ------------------------------------------------------------------ A13 / T7 / T12
def segment_state_fn(condition: Callable, parse: Callable, places: int | None, columns: Sequence[str]):
    """Running sum and count of a name, and the best element of its open segment; a record that fires
    emits it and starts the next segment. The largest average is best, the earliest of equal ones."""
    def average(total, count):
        if total is None:
            return None
        if places is None:
            return total / count
        return EXACT.divide(total, Decimal(count)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP, EXACT)

    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        total, n, segment, seq, best, best_n = state.get if state.exists else (None, 0, 0, None, None, None)
        total, best = (None if v is None else parse(v) for v in (total, best))
        rows = pd.concat(list(pdfs), ignore_index=True).sort_values("seq", kind="stable")
        seqs, sums, counts = rows["seq"].tolist(), [], []
        for v in _values(rows["mark"]):
            total, n = _add(total, v), n + (v is not None)
            sums.append(total)
            counts.append(n)
        averages = [average(t, c) for t, c in zip(sums, counts)]
        seen = pd.DataFrame({"name": key[0], "seq": seqs, "run_sum": pd.Series(sums, dtype=object), "count": counts,
                             "avg_mark": pd.Series(averages, dtype=object)})
        out = []
        for s, a, c, fire in zip(seqs, averages, counts, condition(seen)):
            if seq is None or a is not None and (best is None or a > best):
                seq, best, best_n = s, a, c
            if fire:
                out.append((key[0], segment, seq, best, best_n))
                segment, seq, best, best_n = segment + 1, None, None, None
        state.update((_text(total), n, segment, seq, _text(best), best_n))
        if out:
            yield pd.DataFrame(out, columns=columns)
    return fn


def purge_segments_stream(marks: DataFrame, name: str = "name", mark: str = "mark", seq: str = "seq",
                          threshold: float = 80, condition: Callable | None = None) -> DataFrame:
    """Condition-fired segments on a stream, row for row as :func:`operators.behavior.purge_segments`:
    at each record whose running aggregates fulfil ``condition``, the element with the largest average
    since the last firing.

    ``condition`` takes a pandas frame with a name's new records in order (``name``, ``seq``, ``run_sum``,
    ``count``, ``avg_mark``; numbers as decimals, None before the first mark) and gives a truth value for
    each; by default the average must pass ``threshold``. One state per name, of fixed size. Records of a
    name must come in ``seq`` order.
    """
    number, kind, parse = _number(marks, mark)
    limit = parse(str(threshold))

    def passed(seen: pd.DataFrame) -> list:
        return [t is not None and t > limit * c for t, c in zip(seen["run_sum"], seen["count"])]

    # the scales of a division and of the batch operator's average
    exact = isinstance(kind, T.DecimalType)
    places = max(kind.scale, 6) if exact else None
    average = T.DecimalType(38, max(6, kind.scale + 4)) if exact else kind
    d = marks.select(F.col(name).alias("name"), F.col(seq).cast("long").alias("seq"), number.alias("mark"))
    out_schema = T.StructType([
        T.StructField("name", marks.schema[name].dataType), T.StructField("segment", T.LongType()),
        T.StructField("seq", T.LongType()), T.StructField("avg_mark", average), T.StructField("count", T.LongType())])
    out = d.groupBy("name").applyInPandasWithState(
        segment_state_fn(condition or passed, parse, places, out_schema.names), out_schema,
        "total string, n long, segment long, seq long, best string, best_n long", "append", "NoTimeout")
    return out.select(F.col("name").alias(name), "segment", F.col("seq").alias(seq), "avg_mark", "count")


# ------------------------------------------------------------------ T11 / A9
#: Bits of the bitmap that one state holds; a window's bitmap is cut into so many at most.
PART_BITS = 1 << 17


def seen_state_fn(size_us: int, columns: Sequence[str]):
    """Which views of a (window, part of the bitmap) are by a user not seen before in it: their bit was
    unset. State: the part's bits, compressed, dropped after the window's end."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        bits = np.zeros(PART_BITS // 8, dtype="uint8")
        if state.exists:
            bits = np.frombuffer(zlib.decompress(bytes(state.get[0])), dtype="uint8").copy()
        rows = pd.concat(list(pdfs), ignore_index=True).sort_values("seq", kind="stable", ignore_index=True)
        bit = rows["bit"].to_numpy()
        new = ~rows["bit"].duplicated().to_numpy() & ((bits[bit // 8] >> (bit % 8)) & 1 == 0)
        np.bitwise_or.at(bits, bit[new] // 8, (1 << (bit[new] % 8)).astype("uint8"))
        state.update((zlib.compress(bits.tobytes(), 1),))
        _after(state, int(key[0]) + size_us)
        out = rows[["start_us", "seq", "user_id"]].copy()
        out["new"] = new.astype("int64")
        yield out[list(columns)]
    return fn


def first_views_stream(views: DataFrame, ts: str, user: str, size: str, seq: str = "seq",
                       delay: str = "0 seconds", seed: int = HASH_SEED, cap: int = BITMAP_BITS) -> DataFrame:
    """Every view with ``new`` = 1 where its user's bit was unset in its window's bitmap, else 0
    (append mode). The bitmap is cut into parts of ``PART_BITS``, each a state of its own, so a busy window
    is spread over its parts and its state is at most the bitmap."""
    size_us = interval_us(size)
    v = event_time(views, ts).withWatermark(ts, delay)
    w = F.window(ts, size)
    h = poly_hash(F.col(user).cast("string"), seed, cap)
    v = v.select(w.alias("w"), F.unix_micros(w.start).alias("start_us"), F.col(seq).cast("long").alias("seq"),
                 F.col(user).cast("string").alias("user_id"), h.alias("h"))
    v = v.where("h IS NOT NULL").select("w", "start_us", "seq", "user_id", F.floor(F.col("h") / PART_BITS).alias("part"),
                                        (F.col("h") % PART_BITS).alias("bit"))
    out_schema = T.StructType([T.StructField("start_us", T.LongType()), T.StructField("seq", T.LongType()),
                               T.StructField("user_id", T.StringType()), T.StructField("new", T.LongType())])
    out = v.groupBy("start_us", "part").applyInPandasWithState(
        seen_state_fn(size_us, out_schema.names), out_schema, "bits binary", "append", "EventTimeTimeout")
    start = F.timestamp_micros("start_us")
    return out.select(start.alias("window_start"), F.timestamp_micros(F.col("start_us") + size_us).alias(
        "window_end"), F.col("seq").alias(seq), F.col("user_id").cast(views.schema[user].dataType).alias("user_id"),
        "new")


def uv_running_sink(views: DataFrame, ts: str, user: str, size: str, out_root: str, seq: str = "seq",
                    delay: str = "0 seconds", checkpoint: str | None = None,
                    trigger: str | None = "availableNow") -> StreamingQuery:
    """Distinct users of its window so far, for every view (T11, A9), as
    :func:`operators.behavior.uv_running` with ``hashed=True``: column ``cum_new`` below
    ``out_root/emitted``.

    Stage one tells new users from seen ones per (window, part of the bitmap); stage two adds the parts
    up: a running sum per window in arrival order inside the micro-batch, in blocks of arrivals, on the
    window's total of the batches before (:func:`cumulative_sink`). Arrivals must come in ``seq`` order over micro-batches.
    """
    new = first_views_stream(views, ts, user, size, seq, delay)
    return cumulative_sink(new, ["window_start"], seq, ["new"], out_root, checkpoint, trigger,
                           block=seq_block(seq))


def read_uv_running(spark, out_root: str, seq: str = "seq") -> DataFrame:
    """What :func:`uv_running_sink` has emitted: ``window_start, window_end, seq, user_id, uv``."""
    rows = spark.read.parquet(os.path.join(out_root, "emitted"))
    return rows.select("window_start", "window_end", seq, "user_id", F.col("cum_new").alias("uv"))
