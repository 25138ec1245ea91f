"""Polynomial string hash used for bitmap distinct counting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seed and bitmap size of the unique-visitor bitmap.
HASH_SEED = 61
BITMAP_BITS = 1 << 29


def poly_hash(s: str | Column, seed: int = HASH_SEED, cap: int = BITMAP_BITS) -> Column:
    """``h = h*seed + code(char)`` over the string, masked with ``cap-1``.

    The mask is applied at every step: the result is the same modulo ``cap`` (a power of two) as
    masking once at the end, and the intermediate never overflows a long, which ANSI mode would
    reject. Runs as a higher-order SQL expression inside codegen, no Python.
    """
    if cap & (cap - 1):
        raise ValueError("cap must be a power of two")
    col = F.col(s) if isinstance(s, str) else s
    chars = F.transform(F.split(col, ""), lambda c: F.ascii(c).cast("bigint"))
    mask = F.lit(cap - 1).cast("bigint")
    return F.aggregate(chars, F.lit(0).cast("bigint"),
                       lambda h, c: (h * F.lit(seed).cast("bigint") + c).bitwiseAND(mask))
