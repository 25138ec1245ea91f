"""MinHash near-dedup by an LSH forest, confirmed on full shingle sets.

Every distinct shingle set (documents with the same set are one node, the smallest id) has one
signature of ``60`` minhashes. A tree of the forest is a sorted order of the nodes by a rotation of
the signature; nodes with a long common prefix in a tree are candidates.

* Regions of a tree are the runs of its order with a common prefix of ``DEPTH`` values. With 20 trees
  on disjoint starts, two sets of similarity 0.75 miss every common region with probability
  (1 - 0.75^3)^20, about 2 in 100,000; the more similar, the less. Counting the prefixes first leaves
  nodes without company out of the orders.
* In a first pass each member of a region is checked against one of them, the most central: the one
  whose regions in all trees are the largest together, as is the text that copies were made from.
  This settles groups of copies, of any size, with about one check per member, and no region is
  gathered.
* Regions that are still not one group are put in order: one range partitioning by (tree, rotated
  signature) sorts all trees, and the common prefix of each place with the next one is read off. A
  region of at most ``LEAF`` members is paired as it is and is never cut by the partitioning. A
  larger one is cut where the common prefix is shortest, again and again, until each run has at most
  ``LEAF`` members: the depth adapts to how crowded the order is there, and a node meets the
  neighbours with which it has the longest prefix. This finds most links of such a region, not all.
* Regions of more than ``LEAF`` members that are still not one group are then compared in full,
  blocks of members against blocks: every pair of different groups is checked on its full sets, in
  the first region that it shares. The largest group of a region is not compared with itself. The
  work grows with the square of what is left in such a region, spread over tasks of bounded size.

The texts of documents with company in some region are kept as a table for the checks: a set is
made once per task and compared with those that were sent to it, in portions of bounded size. Ids may
be of any type with an order that groups and joins, such as integers and texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, components, rows, stored, unused, utf8
from .words import shingles

HASHES = 60
DEPTH = 3
LEAF = 64
RUN = 1 << 14
PORTION = 256
BLOCK = 512
BLOCK_SHINGLES = 1 << 21
SHINGLE = 5
PERCENT = 75


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(60)
    odd = rng.integers(0, 2 ** 63, HASHES, dtype="u8") * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 2 ** 63, HASHES, dtype="u8")


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, digest, sig): the set's size, its digest and its minhashes for each row.
    Texts without words have size 0 and an empty signature."""
    bounded_batches(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    odd, add = _seeds()

    def run(batches):
        for whole in batches:
            for b in rows(whole, 256):
                sets = [shingles(t.lower(), shingle) for t in utf8(b.column(1))]
                sizes = np.array([len(s) for s in sets], dtype="i8")
                has = np.flatnonzero(sizes)
                sig = np.zeros((len(sets), HASHES), dtype="i4")
                if len(has):
                    flat = np.concatenate([sets[i] for i in has])
                    starts = np.append(0, np.cumsum(sizes[has])[:-1])
                    for p in range(HASHES):
                        low = np.minimum.reduceat(flat * odd[p] + add[p], starts)
                        sig[has, p] = (low >> np.uint64(32)).astype("u4").view("i4")
                offsets = np.append(0, np.cumsum(np.where(sizes > 0, HASHES, 0))).astype("i4")
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array(sizes),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                             pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig[has].ravel()))],
                    names=["id", "n_shingles", "digest", "sig"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, n_shingles bigint, digest binary, sig array<int>")


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirm(edges: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The edges (a, b) whose ``texts`` (node, text) are similar. The texts of up to ``PORTION`` b's
    meet the text of their a in one place; an a with more of them is sent to several."""
    bounded_batches(texts.sparkSession)
    kind = edges.select("a").schema[0].dataType.simpleString()
    portions = (edges.groupBy("a").agg(F.count("*").alias("n"))
                .select("a", F.ceil(F.col("n") / PORTION).cast("int").alias("portions")))
    asked = (edges.join(portions, "a")
             .select("a", F.col("b").alias("node"), F.lit(1).alias("role"),
                     F.pmod(F.xxhash64("b"), F.col("portions")).cast("int").alias("portion"))
             .unionAll(portions.select("a", F.col("a").alias("node"), F.lit(0).alias("role"),
                                       F.explode(F.sequence(F.lit(0), F.col("portions") - 1))
                                       .alias("portion"))))
    sent = (asked.join(texts, "node").repartition("a", "portion")
            .sortWithinPartitions("a", "portion", "role").select("a", "portion", "role", "node", "text"))

    def run(batches):
        place, centres = None, []
        for whole in batches:
            for b in rows(whole, 256):
                found = []
                keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
                roles, nodes = b.column(2).to_pylist(), b.column(3).to_pylist()
                for key, role, node, text in zip(keys, roles, nodes, utf8(b.column(4))):
                    if key != place:
                        place, centres = key, []
                    own = shingles(text.lower(), shingle)
                    if role == 0:
                        centres.append(own)
                    elif any(similar(c, own, percent) for c in centres):
                        found.append((key[0], node))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in found], b.schema.types[0]),
                     pa.array([x[1] for x in found], b.schema.types[3])], names=["a", "b"])

    return sent.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def rotated(tree, values: int = HASHES):
    """The first ``values`` of the tree's rotation of the signature, its key in the tree's order."""
    start = tree * DEPTH
    if values == DEPTH:
        return F.slice("sig", start + 1, DEPTH)
    return F.concat(F.slice("sig", start + 1, HASHES - start), F.slice("sig", F.lit(1), start))


def common_prefix(keys: np.ndarray) -> np.ndarray:
    """For each row of ``keys`` but the last, how many leading values it shares with the next."""
    differ = keys[1:] != keys[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), keys.shape[1])


def cut(prefix: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Where runs start among sorted keys whose neighbours share ``prefix`` values: everything is cut
    at its shortest common prefixes until no run has more than ``leaf`` members. A run of equal keys
    is cut into pieces of ``leaf``."""
    starts, todo = [], [(0, len(prefix) + 1)]
    while todo:
        lo, hi = todo.pop()
        inner = prefix[lo:hi - 1]
        if hi - lo <= leaf:
            starts.append(lo)
        elif inner.min() == inner.max() == HASHES:
            starts += range(lo, hi, leaf)
        else:
            at = [lo, *(lo + 1 + np.flatnonzero(inner == inner.min())), hi]
            todo += zip(at, at[1:])
    return np.array(sorted(starts))


def neighbours(members: DataFrame, sigs: DataFrame, percent: int, leaf: int = LEAF) -> DataFrame:
    """Candidates (a, b), a < b, among ``members`` (region, n, tree, node, n_shingles, centre, part) of
    regions with ``n`` members: pairs of different parts in one run of a tree's order, but for those
    with the region's centre and those whose sizes rule a link out.

    A crowded region may be cut by the partitioning, and is cut after ``RUN`` rows.
    """
    bounded_batches(members.sparkSession)
    kind = members.schema["node"].dataType.simpleString()
    crowded = F.col("n") > leaf
    sent = (members.join(sigs, "node")
            .select("tree", "region", "node", "part", "n_shingles",
                    (F.col("node") == F.col("centre")).alias("central"),
                    rotated(F.col("tree")).alias("key"),
                    F.when(crowded, rotated(F.col("tree"))).otherwise(rotated(F.col("tree"), DEPTH))
                    .alias("bound"), F.when(crowded, F.col("node")).alias("tie"))
            .repartitionByRange("tree", "bound", "tie")
            .sortWithinPartitions("tree", "key", "region", "node")
            .select("region", "node", "part", "n_shingles", "central", "key"))

    def pairs(rows_: pa.Table):
        region, size, central = (rows_.column(c).to_numpy() for c in ("region", "n_shingles", "central"))
        part = pa.compute.dictionary_encode(rows_.column("part").combine_chunks()).indices.to_numpy()
        first = np.append(0, np.flatnonzero(region[1:] != region[:-1]) + 1)
        lengths = np.diff(np.append(first, len(region)))
        run = np.repeat(np.arange(len(first)), lengths)
        if (lengths > leaf).any():
            keys = rows_.column("key").combine_chunks()
            starts = [first]
            for lo, n in zip(first[lengths > leaf], lengths[lengths > leaf]):
                own = keys.slice(lo, n).flatten().to_numpy().reshape(n, HASHES)
                starts.append(lo + cut(common_prefix(own), leaf))
            first = np.unique(np.concatenate(starts))
            run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(region))))
        left, right = [], []
        for k in range(1, leaf):
            near = run[k:] == run[:-k]
            if not near.any():
                break
            i = np.flatnonzero(near & (part[k:] != part[:-k]) & ~central[k:] & ~central[:-k])
            low, high = np.minimum(size[i], size[i + k]), np.maximum(size[i], size[i + k])
            i = i[100 * low >= percent * high]
            left.append(i)
            right.append(i + k)
        node = rows_.column("node").combine_chunks()
        for i, j in zip(left, right):
            if len(i):
                yield pa.RecordBatch.from_arrays([node.take(pa.array(i)), node.take(pa.array(j))],
                                                 names=["x", "y"])

    def run(batches):
        kept = None
        for b in batches:
            held = pa.Table.from_batches([b])
            held = held if kept is None else pa.concat_tables([kept, held]).combine_chunks()
            region = held.column("region").to_numpy()
            at = np.flatnonzero(region != region[-1]) if len(region) else []
            at = len(region) if len(region) > RUN and not len(at) else int(at[-1]) + 1 if len(at) else 0
            if at:
                yield from pairs(held.slice(0, at))
            kept = held.slice(at) if at < held.num_rows else None
        if kept is not None:
            yield from pairs(kept)

    return (sent.mapInArrow(run, f"x {kind}, y {kind}")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


class Block:
    """Texts that wait in one place, by node, and what a text that comes by links with."""

    def __init__(self):
        self.nodes, self.parts, self.sigs, self.sets, self.owner = [], [], [], [], None

    def add(self, node, part, sig: np.ndarray, own: np.ndarray) -> None:
        self.nodes.append(node)
        self.parts.append(part)
        self.sigs.append(sig)
        self.sets.append(own)

    def close(self) -> None:
        """An index from shingles to the texts that hold them."""
        self.nodes, self.parts, self.sigs = map(np.array, (self.nodes, self.parts, self.sigs))
        self.sizes = np.array([len(s) for s in self.sets], dtype="i8")
        flat = np.concatenate(self.sets)
        order = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        self.values, starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(starts, len(flat))

    def common(self, own: np.ndarray) -> np.ndarray:
        """For each text, how many shingles it shares with ``own``."""
        at = np.minimum(np.searchsorted(self.values, own), len(self.values) - 1)
        at = at[self.values[at] == own]
        n = self.starts[at + 1] - self.starts[at]
        before = np.cumsum(n) - n
        places = np.arange(n.sum()) + np.repeat(self.starts[at] - before, n)
        return np.bincount(self.owner[places], minlength=len(self.sets))

    def links(self, tree: int, node, part, largest: bool, sig: np.ndarray, text: bytes, percent: int,
              shingle: int) -> list:
        """Nodes that the text links with, one of each group. Pairs that share a region of an earlier
        tree are left to it; a pair within none of the largest group comes by twice and is taken once."""
        if self.owner is None:
            self.close()
        ask = self.parts != part
        if not largest:
            ask &= self.nodes > node
        at = np.flatnonzero(ask)
        same = (self.sigs[at] == sig).reshape(len(at), HASHES // DEPTH, DEPTH).all(axis=2)
        at = at[same[:, tree] & ~same[:, :tree].any(axis=1)]
        if not len(at):
            return []
        own = shingles(text.lower(), shingle)
        size, n = len(own), self.sizes[at]
        at = at[(n > 0) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))]
        if 16 * len(at) < len(self.sets):
            at = [i for i in at if similar(self.sets[i], own, percent)]
        else:
            both = self.common(own)[at]
            at = at[100 * both >= percent * (self.sizes[at] + size - both)]
        return list({self.parts[i]: self.nodes[i].item() for i in at}.values())


def confirm_crowded(crowd: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int,
                    shingle: int) -> DataFrame:
    """Links (a, b) between different parts of the regions of ``crowd`` (region, tree, node, part,
    n_shingles), enough of them to connect all that is linked. What is not in a region's largest part
    waits in blocks of bounded size; all members come by, in portions."""
    bounded_batches(texts.sparkSession)
    kind = crowd.schema["node"].dataType.simpleString()
    shape = (crowd.groupBy("region", "part").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
             .groupBy("region").agg(F.max(F.struct("n", "w", "part")).alias("top"), F.sum("n").alias("n"),
                                    F.sum("w").alias("w"), F.count("*").alias("parts"))
             .where("parts > 1")
             .select("region", F.col("top.part").alias("largest"),
                     F.ceil(F.greatest((F.col("n") - F.col("top.n")) / BLOCK,
                                       (F.col("w") - F.col("top.w")) / BLOCK_SHINGLES))
                     .cast("int").alias("blocks"),
                     F.ceil(F.col("n") / (2 * BLOCK)).cast("int").alias("portions")))
    member = crowd.join(shape, "region")
    cols = ["region", "tree", "node", "part", (F.col("part") == F.col("largest")).alias("largest")]
    waits = member.where("part != largest").select(
        *cols, F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"), F.lit(0).alias("role"))
    comes = member.select(
        *cols, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("portions")).cast("int").alias("portion"),
        F.lit(1).alias("role"))
    place = ["region", "block", "portion"]
    sent = (waits.unionAll(comes).join(sigs.join(texts, "node"), "node").repartition(*place)
            .sortWithinPartitions(*place, "role")
            .select(*place, "role", "tree", "node", "part", "largest", "sig", "text"))

    def run(batches):
        at, block = None, None
        for whole in batches:
            for b in rows(whole, 256):
                found = []
                keys = zip(*[b.column(i).to_pylist() for i in range(3)])
                sig = b.column(8).flatten().to_numpy(zero_copy_only=False).reshape(-1, HASHES)
                rest = zip(keys, *[b.column(i).to_pylist() for i in range(3, 8)], sig, utf8(b.column(9)))
                for key, role, tree, node, part, largest, own, text in rest:
                    if key != at:
                        at, block = key, Block()
                    if role == 0:
                        block.add(node, part, own.copy(), shingles(text.lower(), shingle))
                    elif block.sets:
                        found += [(x, node) for x in block.links(tree, node, part, largest, own, text,
                                                                 percent, shingle)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in found], b.schema.types[5]) for i in range(2)],
                    names=["a", "b"])

    return sent.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(``id_col``, n_shingles, component_id, kept) for each row of ``docs``.

    Documents link at a similarity of ``percent`` or more; component_id is the smallest id reachable
    by links, kept says that it is the row's own. Rows with the same id are one document, linked if
    any of their texts is. Texts that are null or without words link with nothing. Rows with a null
    id take no part: component_id is null and they are kept. Other columns are not read.
    """
    docs = docs.select(id_col, text_col)
    signed = stored(signatures(docs, id_col, text_col, shingle), "sig")
    some = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = stored(some.groupBy("digest").agg(F.min("id").alias("node")), "sets")
    nodes = some.join(classes, (some["digest"] == classes["digest"]) & (F.col("id") == F.col("node"))
                      ).select("node", "n_shingles", "sig")
    tree = F.explode(F.sequence(F.lit(0), F.lit(HASHES // DEPTH - 1))).alias("tree")
    at = nodes.select("node", "n_shingles", "sig", tree)
    regions = at.select("node", "n_shingles", "tree",
                        F.xxhash64("tree", rotated(F.col("tree"), DEPTH)).alias("region"))
    crowd = regions.groupBy("region").agg(F.min("node").alias("low"), F.count("*").alias("n"),
                                          F.max("node").alias("high")).where("low < high")
    regions = stored(regions.join(crowd.select("region", "n"), "region"), "regions")
    central = regions.groupBy("node").agg(F.sum("n").alias("weight"))
    centres = (regions.join(central, "node").groupBy("region")
               .agg(F.min_by("node", F.struct(-F.col("weight"), "node")).alias("centre")))
    regions = stored(regions.join(centres, "region"), "centres")
    texts = stored(docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text"))
                   .join(central.select("node"), "node", "left_semi"), "texts")

    first = regions.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    held = some.join(classes, "digest").select("id", "node")
    several = held.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    same_id = held.join(several, "id").where("a != node").select("a", F.col("node").alias("b"))
    links = stored(confirm(first.distinct(), texts, percent, shingle)
                   .unionAll(same_id.distinct()), "links")
    found = components(links)

    # pairs that are in one region but not yet in one group
    placed = regions.join(found, "node", "left").withColumn("part", F.coalesce("component", "node"))
    several = (placed.groupBy("region").agg(F.min("part").alias("p"), F.max("part").alias("q"))
               .where("p < q").select("region"))
    level = stored(placed.drop("component").join(several, "region", "left_semi"), "open")
    sigs = nodes.select("node", "sig")
    pairs = neighbours(level, sigs, percent)
    pairs = stored(pairs.distinct(), "pairs")
    if not pairs.isEmpty():
        links = stored(links.unionAll(confirm(pairs, texts, percent, shingle)), "links")
        found = components(links)
    crowded = level.where(F.col("n") > LEAF).select("region", "tree", "node", "n_shingles")
    if not crowded.isEmpty():
        crowd = stored(crowded.join(found, "node", "left")
                       .withColumn("part", F.coalesce("component", "node")).drop("component"), "crowd")
        links3 = stored(confirm_crowded(crowd, sigs, texts, percent, shingle), "links")
        if not links3.isEmpty():
            found = components(stored(links.unionAll(links3), "links"))

    group = (classes.join(found, "node", "left")
             .select("digest", F.coalesce("component", "node").alias("component_id")))
    by_id = some.join(group, "digest").groupBy("id").agg(F.min("component_id").alias("component_id"))
    out = signed.join(by_id, "id", "left")
    component = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group does, the one with the smallest
    id; of rows with the same id the one with the smallest text. Rows with a null id all stay. All
    columns stay."""
    named, nameless = docs.where(F.col(id_col).isNotNull()), docs.where(F.col(id_col).isNull())
    own, nth = unused(docs, "_llm_kept", "_llm_rn")
    kept = (near_duplicates(docs, id_col, text_col, percent, shingle)
            .where(F.col("kept") & F.col(id_col).isNotNull())
            .select(F.col(id_col).alias(own)).distinct())
    # joined and ordered by the bare id: the texts are shuffled once for both
    stay = named.join(kept, F.col(id_col) == F.col(own), "left_semi")
    order = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last())
    return (stay.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).drop(nth)
            .unionAll(nameless))
