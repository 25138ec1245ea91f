"""Exclusion-list filter (anti join against a refreshable dimension)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the hashed list; its table has at most ``FILTER_BITS / 64`` rows of two longs, whatever the
#: list's size, so sending it to every executor is bounded (2^27 bits: 2 million rows, about 64 MB).
FILTER_BITS = 1 << 27


def _size_in_bytes(df: DataFrame) -> int:
    """The optimizer's estimate, the same that decides on broadcast joins."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return conf.autoBroadcastJoinThreshold()


def _hashed(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_bitmap(keys_table: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """(``_lf_word``, ``_lf_mask``): the bits of all hashed keys, 64 to a word, built by one aggregate that
    is combined map-side. Words without a bit are left out."""
    h = keys_table.select(_hashed(keys, bits).alias("_lf_h"))
    mask = F.expr("shiftleft(1L, cast(_lf_h % 64 as int))")
    return (h.select(F.shiftright("_lf_h", 6).alias("_lf_word"), mask.alias("_lf_m"))
            .groupBy("_lf_word").agg(F.bit_or("_lf_m").alias("_lf_mask")))


def anti_filter(df: DataFrame, exclusion: DataFrame, keys: Sequence[str] = ("act_nbr", "ccy_cod"),
                method: str = "auto", bits: int = FILTER_BITS) -> DataFrame:
    """Drop rows whose key tuple is in ``exclusion``.

    A null key part matches the text ``null`` on the other side (the reference builds its keys by
    string concatenation).

    ``method="join"``: one anti join, whose list Spark broadcasts when its size allows, and which else
    shuffles both sides. ``method="filter"``: rows whose hashed key is not among the list's set bits are not
    on it and go on as they are; only the others, those on the list and about ``list size / bits`` of
    the rest, are shuffled for the exact anti join. The bits are sent to every executor, and their size is
    bounded by ``bits``, not by the list. ``auto``: the filter where the list is too large to broadcast by
    the session's threshold.
    """
    left = df.select("*", *[F.coalesce(F.col(k).cast("string"), F.lit("null")).alias(f"_x_{k}") for k in keys])
    # no distinct(): an anti join only tests existence, duplicates on the right change nothing
    right = exclusion.select(*[F.coalesce(F.col(k).cast("string"), F.lit("null")).alias(f"_x_{k}")
                               for k in keys])
    on = [f"_x_{k}" for k in keys]
    if method == "auto":
        method = "join" if _size_in_bytes(right) <= _broadcast_limit(df) else "filter"
    if method == "join":
        return left.join(right, on, "left_anti").select(*df.columns)
    if method != "filter":
        raise ValueError(f"unknown method {method!r}")
    words = F.broadcast(key_bitmap(right, on, bits))
    left = left.withColumn("_lf_h", _hashed(on, bits))
    found = (F.shiftright("_lf_h", 6) == F.col("_lf_word")) & (
        F.expr("shiftright(_lf_mask, cast(_lf_h % 64 as int)) & 1L") == 1)
    clear = left.join(words, found, "left_anti").select(*df.columns)
    maybe = left.join(words, found, "left_semi").join(right, on, "left_anti").select(*df.columns)
    return clear.unionAll(maybe)
