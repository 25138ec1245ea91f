"""Blocked running aggregates: prefix scans that never put a whole group (or table) in one task.

A plain ``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task, and with no
``partitionBy`` the whole table. Here each group is cut into blocks along the order (``block`` is a
column that never decreases with the order inside a group, e.g. ``floor(seq / B)`` or a time bucket):

1. running aggregate inside each ``(group, block)``  -- a window over at most one block;
2. one total per ``(group, block)``                   -- a hash aggregate;
3. exclusive prefix of the block totals per group      -- a window over the small block table
   (itself blocked again when ``fanout`` is set, so even a global order stays spread out);
4. join 3 back on ``(group, block)`` and combine.

Steps 1 and 2 read the same shuffled rows: both start from one repartition by ``(group, block)`` and
use the same columns, so Spark plans one scan and one exchange of the data (the second use reads the
exchange again). What else is shuffled are block totals.

The group is carried as one struct column (never null; null fields compare equal, like a window's
null group), so the join in step 4 is a plain equi-join on ``(group, block)`` that keeps the
partitioning of step 1. Supported kinds have an associative combine: ``sum``, ``count``, ``max``,
``min``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RUN = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
# How block totals are combined along the blocks.
_COMBINE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
GROUP = "_lf_g"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def running(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], block: Column | str,
            specs: dict[str, tuple[str, Column | str]], inclusive: bool = True,
            fanout: int | None = None, keep_keys: bool = False, _depth: int = 0) -> DataFrame:
    """Add one column per ``specs`` item: ``name -> (kind, column)``.

    ``inclusive=True`` is the frame *unbounded preceding .. current row*; ``False`` stops at the
    row before (the value "as of just before this row"). ``order`` must be a total order inside
    a group (add a unique tie-breaker) for a deterministic result.

    ``block`` may name an existing column, and with ``keep_keys=True`` the output keeps the block
    and group-key columns: a chained scan over the same ``by`` and block then reuses the first
    scan's partitioning, and its window needs no shuffle of the data.
    """
    by = list(by)
    d = df
    if isinstance(block, str):
        blk = block
    else:
        blk = f"_lf_blk{_depth}"
        d = d.withColumn(blk, block)
    keys = [blk]
    chained = isinstance(block, str) and GROUP in d.columns  # already dealt out by these keys
    if by:
        if GROUP not in d.columns:
            d = d.withColumn(GROUP, F.struct(*by))
        keys = [GROUP, blk]

    d = d if chained else d.repartition(*keys)
    w = (Window.partitionBy(*keys).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    inner = d.select("*", *[_RUN[k](_col(c)).over(w).alias(f"_lf_in_{n}")
                            for n, (k, c) in specs.items()])

    # a digest of all columns keeps those of the exchange the same as below ``inner``
    named = [f.name for f in d.schema.fields if not isinstance(f.dataType, T.MapType)]
    totals = d.groupBy(*keys).agg(*[_RUN[k](_col(c)).alias(f"_lf_t_{n}") for n, (k, c) in specs.items()],
                                  F.max(F.xxhash64(*named)).alias("_lf_any")).where("_lf_any IS NOT NULL")
    gkeys = keys[:-1]
    if fanout:
        tspecs = {f"_lf_p_{n}": ("sum" if k == "count" else k, F.col(f"_lf_t_{n}"))
                  for n, (k, _) in specs.items()}
        prior = running(totals, gkeys, [F.col(blk)], F.floor(F.col(blk) / F.lit(fanout)), tspecs,
                        inclusive=False, _depth=_depth + 1)
    else:
        wb = Window.partitionBy(*gkeys).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
        prior = totals.select(*keys, *[_COMBINE[k](F.col(f"_lf_t_{n}")).over(wb)
                                       .alias(f"_lf_p_{n}") for n, (k, _) in specs.items()])

    # ``prior`` derives from ``inner``: rename its keys so the self-join is unambiguous.
    prior = prior.select(*[F.col(c).alias(f"_lf_k{j}") for j, c in enumerate(keys)],
                         *[f"_lf_p_{n}" for n in specs])
    cond = [F.col(c) == F.col(f"_lf_k{j}") for j, c in enumerate(keys)]
    joined = inner.join(prior, cond, "left")
    keep = list(df.columns)
    if keep_keys:
        keep += [c for c in keys if c not in keep]
    merged = []
    for n, (k, _) in specs.items():
        p, i = F.col(f"_lf_p_{n}"), F.col(f"_lf_in_{n}")
        if k in ("sum", "count"):
            val = F.when(p.isNull(), i).when(i.isNull(), p).otherwise(p + i)
            if k == "count":
                val = F.coalesce(val, F.lit(0).cast("bigint"))
        else:
            val = (F.greatest if k == "max" else F.least)(p, i)
        merged.append(val.alias(n))
    return joined.select(*[F.col(c) for c in keep], *merged)
