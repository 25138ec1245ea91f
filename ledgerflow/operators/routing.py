"""Stream routing: split by predicate into named outputs, rule decisions, merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per-type acceptance rules of the ACT feed (type, direction, status, product).
ACT_RULES = (
    {"typ": "kpp", "dir": "D", "sts": "22", "cod": "95100"},
    {"typ": "kqp", "dir": "C", "cod": "95100", "sts": "20"},
)
REJECTED = "del"


def route(df: DataFrame, branches: Mapping[str, Column], other: str = "other",
          name: str = "branch") -> DataFrame:
    """Label each row with the first branch whose predicate holds (``other`` when none)."""
    expr = None
    for b, pred in branches.items():
        expr = F.when(pred, F.lit(b)) if expr is None else expr.when(pred, F.lit(b))
    return df.withColumn(name, expr.otherwise(F.lit(other)) if expr is not None else F.lit(other))


def split(df: DataFrame, branches: Mapping[str, Column], other: str = "other"
          ) -> dict[str, DataFrame]:
    """Side outputs: one DataFrame per branch plus ``other`` (rows no predicate accepted).

    Every input row lands in exactly one output. Each output is a filter over the same plan; cache
    the input (or run inside ``foreachBatch`` on a persisted batch) when several are consumed.
    """
    labelled = route(df, branches, other, "_branch")
    names = [*branches, other]
    return {n: labelled.where(F.col("_branch") == n).drop("_branch") for n in names}


def rule_decision(df: DataFrame, rules: Sequence[Mapping[str, str]] = ACT_RULES,
                  type_col: str = "typ") -> DataFrame:
    """Add ``decision`` ('keep'/'del') and ``out_typ`` (type kept, or 'del') from a rules table.

    A row is kept when some rule for its type matches all of that rule's fields.
    """
    ok = F.lit(False)
    for r in rules:
        cond = F.lit(True)
        for c, v in r.items():
            cond = cond & (F.col(c) == F.lit(v))
        ok = ok | cond
    ok = F.coalesce(ok, F.lit(False))
    return df.withColumn("decision", F.when(ok, F.lit("keep")).otherwise(F.lit(REJECTED))) \
             .withColumn("out_typ", F.when(ok, F.col(type_col)).otherwise(F.lit(REJECTED)))


def merge(*dfs: DataFrame) -> DataFrame:
    """Union of same-typed streams (by column name)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
