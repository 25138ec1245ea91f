"""Offset ledger: per (topic, partition) the next offset to read, never moving back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_offsets(batch: DataFrame, topic: str = "topic", partition: str = "partition",
                  offset: str = "offset") -> DataFrame:
    return batch.groupBy(F.col(topic).alias("topic"), F.col(partition).alias("partition")).agg(
        (F.max(offset) + 1).alias("next_offset"))


def advance(ledger: DataFrame | None, batch: DataFrame, topic: str = "topic",
            partition: str = "partition", offset: str = "offset") -> DataFrame:
    """Merge a processed batch into the ledger: ``next = greatest(old next, max(offset) + 1)``.

    A replayed batch with lower offsets leaves the ledger where it was.
    """
    nxt = batch_offsets(batch, topic, partition, offset)
    if ledger is None:
        return nxt
    j = ledger.alias("l").join(nxt.alias("b"), ["topic", "partition"], "full_outer")
    return j.select("topic", "partition",
                    F.greatest(F.col("l.next_offset"), F.col("b.next_offset")).alias("next_offset"))
