"""Extension points for user code, where built-in expressions do not reach.

The reference's user-function surfaces (map, aggregate, reduce and per-window process functions)
are covered by column expressions and the operators of this package. When a per-window computation
really needs arbitrary code, these run it through Arrow batches, keyed and windowed by Spark; one
call sees one (key, window) group, so the user function must stay within a group's size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_processing_time(df: DataFrame, col: str = "proc_ts") -> DataFrame:
    """Stamp rows with the processing time (one value per micro-batch/query: ``current_timestamp``).

    Tests pass a fixed column instead so results repeat.
    """
    return df.withColumn(col, F.current_timestamp())


def grouped_aggregate(df: DataFrame, keys: Sequence[str], fn: Callable[..., object],
                      cols: Sequence[str], return_type: str, name: str = "value") -> DataFrame:
    """User-defined aggregate: ``fn`` gets the group's columns ``cols`` as pandas Series and returns one
    value of ``return_type``. One call sees one whole group; where the aggregate is a sum, count, max
    or the like, use the built-in functions, which are combined before the shuffle."""
    udaf = F.pandas_udf(fn, return_type, F.PandasUDFType.GROUPED_AGG)
    return df.groupBy(*keys).agg(udaf(*[F.col(c) for c in cols]).alias(name))


def window_apply(df: DataFrame, keys: Sequence[str], ts: str, size: str,
                 fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                 slide: str | None = None) -> DataFrame:
    """Per (keys, window) process function: ``fn`` gets the group's rows (with ``window_start`` and
    ``window_end``) as a pandas DataFrame and returns rows of ``schema``."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    d = df.select("*", w.start.alias("window_start"), w.end.alias("window_end"))
    return d.groupBy(*keys, "window_start").applyInPandas(fn, schema)
