"""Lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame

def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: a reliable checkpoint of ``df`` in the shared ``spark.checkpoint.dir``.

    For multi-pass operators whose later passes would otherwise recompute the earlier ones (and,
    after an executor loss, recompute a long lineage). Runs a job now.
    """
    from ..session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
