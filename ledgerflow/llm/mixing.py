"""Mixing sources to target weights, in DataFrame functions only.

Tokens are aggregated per source; the sources' targets follow from their weights; a source's
repetition rate is its target over its tokens. A document is emitted floor(rate) times, and once
more when its hash, seeded, read as a number in [0, 1), lies below the fraction of the rate. The
hash depends on the document id alone, so reruns and lost tasks give the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 17


def size_of(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_rates(sizes: DataFrame, source: str = "source", size: str = "size",
                 weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: (``source``, source_size, target, rate).

    Sources by code point, null last, take ``weights`` in turn. ``share`` times all tokens are dealt
    by weight; a target stops at ``cap`` times its source's tokens and the excess is dealt again by
    weight. With the sources in order of cap / weight, the ones that stop come first, and source i
    stops when what is left for it and its followers gives it more than its cap: running sums say
    which. Sources without tokens have target and rate 0.

    The running sums go over one row per source, the only step in one task.
    """
    by_source = sizes.groupBy(source).agg(F.sum(size).cast("long").alias("source_size"))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.col("_llm_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = (by_source.withColumn("_llm_rank", F.row_number().over(
        Window.orderBy(F.col(source).asc_nulls_last()))).withColumn("_llm_w", pick)
        .withColumn("_llm_cap", cap * F.col("source_size")))
    order = Window.orderBy(F.col("_llm_cap") / F.col("_llm_w"), "_llm_rank")
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = (share * F.sum("source_size").over(whole)
            - F.coalesce(F.sum("_llm_cap").over(before), F.lit(0.0)))
    filled = (ranked.withColumn("_llm_left", left)
              .withColumn("_llm_rest", F.sum("_llm_w").over(onward))
              .withColumn("_llm_place", F.row_number().over(order))
              .withColumn("_llm_stop", F.col("_llm_left") * F.col("_llm_w")
                          > F.col("_llm_cap") * F.col("_llm_rest")))
    # the first source that does not stop fixes the level for it and all after it
    level = F.max(F.when(~F.col("_llm_stop"), F.struct(-F.col("_llm_place"),
                                                       (F.col("_llm_left") / F.col("_llm_rest"))
                                                       .alias("level")))).over(whole)["level"]
    target = F.when(F.col("_llm_stop"), F.col("_llm_cap")).otherwise(level * F.col("_llm_w"))
    return (filled.select(source, "source_size", target.alias("target"))
            .withColumn("rate", F.when(F.col("source_size") > 0,
                                       F.col("target") / F.col("source_size")).otherwise(0.0)))


def uniform(key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from 52 bits of the md5 of seed and key (null counts as the text null)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(rate: Column, key: Column, seed: int = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(uniform(key, seed) < rate - whole, 1).otherwise(0)).cast("long")


def rate_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source", **options) -> DataFrame:
    """(``id_col``, size, source_size, target, n_copies) for each row of ``docs``.

    A null source is a source like any other, the last in order; a null text has size 0; rows with
    the same id get the same number of copies; other columns are not read.
    """
    sizes = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                        size_of(F.col(text_col)).alias("size"))
    rates = source_rates(sizes, **options).withColumnRenamed("source", "of")
    joined = sizes.join(rates, F.col("source").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias(id_col), "size", "source_size", "target",
                         copies(F.col("rate"), F.col("id")).alias("n_copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it (rows not taken are left out).

    All columns stay, whatever their names. The rates, one row per source, are written as a table
    first: the planner then knows their size in bytes and broadcasts them if it is below the session's
    threshold, so that texts are not shuffled by source.
    """
    sizes = docs.select(F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"))
    of, rate, copy = unused(docs, "_llm_of", "_llm_rate", "_llm_copy")
    rates = stored(source_rates(sizes, **options), "rates").select(
        F.col("source").alias(of), F.col("rate").alias(rate))
    n = copies(F.col(rate), F.col(id_col))
    return (docs.join(rates, F.col(source_col).eqNullSafe(F.col(of)))
            .withColumn(copy, F.explode(F.array_repeat(F.lit(0), n.cast("int")))).drop(of, rate, copy))
