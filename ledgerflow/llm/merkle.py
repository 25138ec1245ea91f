"""Merkle manifest of a dataset: a tree per source, and one tree over the sources' roots.

Each aligned block of 256 nodes keeps a level of its tree as one hex string, 64 characters a node.
Fixed-width substrings of a level, 16 nodes long, are the runs whose digests form the next level, and
the substrings left and right of a node in its run are its siblings. The blocks' roots are the nodes of
the next tier, where the same happens again, until a source has one node; the sources' roots, in order,
go through the same tiers. Proofs are then handed down from the top: what lies above a block is the
same for all its nodes and is joined to the block once.

A node's place among its source's nodes comes from a range partitioning: row numbers inside a
partition plus the source's rows in the partitions before. Texts are read once and not shuffled; a
source with any share of the rows is spread over ranges and blocks like any other.

Rows of a null source form a source of their own, the first one. Rows with equal ids are ordered by
their leaves, a null id comes first; wholly equal rows have equal leaves and each its own place. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
BLOCK = FAN * FAN
HEX = 64


def leaf(columns: Sequence[Column]) -> Column:
    """sha256 of the fields: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    def field(c):
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(field, columns)), 256)


def _ranked(nodes: DataFrame, order: Sequence[str], tag: str) -> DataFrame:
    """``nodes`` (g, ...) with ``pos`` (from 0, by ``order`` within g) and ``n``, the nodes of g.

    The range partition is written down with its number, so a place does not change when a task is
    run again. Equal rows are told apart by ``_at``, so that no number of them lies in one range.
    """
    dealt = (nodes.withColumn("_at", F.monotonically_increasing_id())
             .repartitionByRange("g", *order, "_at").withColumn("_part", F.spark_partition_id()))
    dealt = stored(dealt, f"{tag}-ranges")
    counts = dealt.groupBy("g", "_part").agg(F.count("*").alias("_c"))
    w = Window.partitionBy("g")
    before = counts.select(
        "g", "_part", F.sum("_c").over(w).alias("n"),
        (F.sum("_c").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_c")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("g", "_part").orderBy(*order, "_at")) - 1
    return (dealt.withColumn("_i", inside).join(before, ["g", "_part"])
            .withColumn("pos", F.col("_before") + F.col("_i")).drop("_part", "_at", "_before", "_i"))


def _digests(level: Column) -> Column:
    """The next level: the digest of each run of a level's string."""
    runs = F.ceil(F.length(level) / F.lit(HEX * FAN)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(
        F.substring(level, i * HEX * FAN + 1, F.lit(HEX * FAN)), 256)), "")


def _blocks(nodes: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per aligned block of (g, n, pos, digest): its nodes in order, its two levels and its
    root (``top``). A group of one node is its own root, one of at most 16 has one level of digests."""
    node = F.struct("pos", "digest", *keep)
    blocks = nodes.groupBy("g", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(node)).alias("nodes"))
    blocks = blocks.withColumn("level0", F.array_join(F.col("nodes.digest"), ""))
    blocks = blocks.withColumn("level1", F.when(F.col("n") > FAN, _digests(F.col("level0"))))
    return blocks.withColumn("top", F.when(F.col("n") == 1, F.col("level0")).otherwise(
        F.sha2(F.coalesce("level1", "level0"), 256)))


def _flanks(run: Column, i: Column) -> Column:
    """What lies left and right of node ``i`` in a run."""
    return F.struct(F.substring(run, F.lit(1), i * HEX).alias("l"),
                    F.substring(run, (i + 1) * HEX + 1, F.lit(HEX * FAN)).alias("r"))


def _path(level0: Column, level1: Column, n: Column, at: Column) -> Column:
    """The siblings of node ``at`` of a block, level by level."""
    run = F.floor(at / FAN).cast("int")
    first = F.array(_flanks(F.substring(level0, run * HEX * FAN + 1, F.lit(HEX * FAN)), at % FAN))
    return F.when(n == 1, F.slice(first, 1, 0)).when(n <= FAN, first).otherwise(
        F.concat(first, F.array(_flanks(level1, run))))


def _tiers(nodes: DataFrame, keep: Sequence[str], tag: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each tier, and (g, digest): the root of each g."""
    tiers = []
    while True:
        blocks = stored(_blocks(nodes, () if tiers else keep), f"{tag}-tier{len(tiers)}")
        tiers.append(blocks)
        nodes = blocks.select("g", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("pos"),
                              F.col("top").alias("digest"))
        if not (blocks.agg(F.max("n").alias("n")).first().n or 0) > BLOCK:
            return tiers, nodes.select("g", "digest")


def _handed_down(tiers: list[DataFrame], above: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(g, digest, path, ``keep``, other columns of ``above``) of each node of the first tier, given
    ``above`` (g, path, ...): the siblings that every node of g has above the root of g."""
    rest = [c for c in above.columns if c not in ("g", "path")]
    for t, blocks in reversed(list(enumerate(tiers))):
        on = ["g"] if t == len(tiers) - 1 else ["g", "block"]
        own = keep if t == 0 else ()
        at = (F.col("node.pos") % BLOCK).cast("int")
        one = (blocks.drop("top").join(above, on).select("g", F.explode("nodes").alias("node"), "level0", "level1",
                                             "n", "path", *rest)
               .select("g", F.col("node.pos").alias("block"), F.col("node.digest").alias("digest"),
                       F.concat(_path(F.col("level0"), F.col("level1"), F.col("n"), at), "path")
                       .alias("path"), *[F.col(f"node.{c}").alias(c) for c in own], *rest))
        above = one.drop("digest") if t else one
    return above.drop("block")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, source: str = "source",
             order: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``order``'s value as ``id``, ``source``, ``leaf``, ``subroot`` (the
    root of its source), ``root`` and ``path``, an array with the siblings left (``l``) and right
    (``r``) of the row's node on each level up to the root, as joined digests. ``carry`` adds columns
    computed from ``docs``."""
    carry = carry or {}
    rows = docs.select(F.struct(F.col(source).alias("source")).alias("g"), F.col(order).alias("id"),
                       leaf([F.col(c) for c in fields]).alias("digest"),
                       *[c.alias(name) for name, c in carry.items()])
    keep = ["id", *carry]
    tiers, subroots = _tiers(_ranked(rows, ["id", "digest"], "leaves"), keep, "merkle")
    tops = _ranked(subroots.select(F.lit(0).alias("g"), F.col("g").alias("of"), "digest"), ["of"], "subroots")
    top_tiers, root = _tiers(tops, ["of"], "merkle-top")
    above = _handed_down(top_tiers, root.select("g", F.col("digest").alias("root"), F.array().cast(
        "array<struct<l:string,r:string>>").alias("path")), ["of"])
    above = above.select(F.col("of").alias("g"), F.col("digest").alias("subroot"), "path", "root")
    return (_handed_down(tiers, above, keep)
            .select("id", F.col("g.source").alias("source"), F.col("digest").alias("leaf"), "subroot",
                    "root", "path", *carry))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["l"], x["r"])), "")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, digest, lambda at, x: F.sha2(F.concat(x["l"], at, x["r"]), 256))
