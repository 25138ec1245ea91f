"""Entity -> wide-column cells (table, rowkey, family, qualifier, value), one row per cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Target table, column family and the entity's field names as qualifiers.
DC_TABLE = "dc_sum_mon"
DC_FAMILY = "digitCur"
DC_QUALIFIERS = {"date": "date", "time": "time", "ccy_cod": "ccyCod", "brn": "brn",
                 "out_amt": "outAmt", "in_amt": "inAmt", "sum_amt": "sumAmt"}


def to_cells(df: DataFrame, key_cols: Sequence[str], qualifiers: dict[str, str] = DC_QUALIFIERS,
             table: str = DC_TABLE, family: str = DC_FAMILY, batch_id: int = 0) -> DataFrame:
    """Unpivot each row into one cell per qualifier, values as text.

    The row key is ``md5`` of the JSON array of the batch id and the key columns (nulls kept as
    ``null``, texts quoted), so a retried micro-batch rewrites its own cells, another batch of the
    same minute adds rows of its own, and no two key tuples share a key.
    """
    key = F.to_json(F.array(F.lit(str(batch_id)), *[F.col(c).cast("string") for c in key_cols]))
    rowkey = F.md5(key)
    src = df.select(rowkey.alias("rowkey"),
                    *[F.col(c).cast("string").alias(q) for c, q in qualifiers.items()])
    cells = src.unpivot(["rowkey"], list(qualifiers.values()), "qualifier", "value")
    return cells.select(F.lit(table).alias("table"), "rowkey", F.lit(family).alias("family"),
                        "qualifier", "value")
