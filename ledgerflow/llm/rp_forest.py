"""Approximate nearest neighbours: a forest of random-projection trees with one priority queue.

The trees are fitted on a sample of at most ``sample_rows`` vectors and are complete binary trees of
hyperplanes (the direction between two sampled points of the node, cut at the median), so the model
is of bounded size. Every vector is indexed: it goes to one leaf of each tree.

A search keeps one priority queue over the nodes of all trees, ordered by the sum of the squared
distances by which a path has crossed to the far side of its hyperplanes. It first takes leaves until
they hold ``first`` times k entries; the k-th distance there gives the reach: leaves are then taken
while their sum is at most ``reach`` times that distance squared. How many leaves this needs is a
matter of the data: few where vectors have structure, most of them where distances are all alike.
No candidate of a taken leaf is left out, and all are ranked by exact distance, each once: of the trees in
which an entry lies in a leaf taken by the query, the first one ranks it. A query goes to a block of leaves
as one row, with its vector and a bit for each leaf that it takes in any tree.

Equal vectors are one index entry that holds the k + 1 smallest ids of its rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, rows, smallest_per_group, stored
from .vectors import matrix, usable

TREES = 12
LEAF = 32
SAMPLE_ROWS = 20_000
FIRST = 10
REACH = 0.01
GROUP_ROWS = 16_384


@dataclass
class Forest:
    """``normals`` trees x nodes x dims and ``cuts`` trees x nodes, nodes in heap order."""
    normals: np.ndarray
    cuts: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        out = np.zeros((len(x), len(self.normals)), dtype="i8")
        at = np.arange(len(x))
        for t, (w, c) in enumerate(zip(self.normals, self.cuts)):
            node = np.zeros(len(x), dtype="i8")
            side = x @ w.T - c
            for _ in range(self.depth):
                node = 2 * node + 1 + (side[at, node] > 0)
            out[:, t] = node - (2 ** self.depth - 1)
        return out

    def nearest_leaves(self, query: np.ndarray):
        """(sum, tree, leaf) of all leaves of all trees, nearest first, from one shared queue."""
        side = np.einsum("tnd,d->tn", self.normals, query) - self.cuts
        inner = 2 ** self.depth - 1
        queue = [(0.0, t, 0) for t in range(len(self.normals))]
        while queue:
            far, tree, node = heapq.heappop(queue)
            if node >= inner:
                yield far, tree, node - inner
                continue
            s = float(side[tree, node])
            near = 2 * node + 1 + (s > 0)
            heapq.heappush(queue, (far, tree, near))
            heapq.heappush(queue, (far + s * s, tree, 4 * node + 3 - near))


def fit(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 5) -> Forest:
    dims = sample.shape[1]
    depth = max(0, int(np.ceil(np.log2(max(1, len(sample) / leaf)))))
    rng = np.random.default_rng(seed)
    normals, cuts = np.zeros((trees, 2 ** depth - 1, dims)), np.zeros((trees, 2 ** depth - 1))
    for t in range(trees):
        members = {0: np.arange(len(sample))}
        for node in range(2 ** depth - 1):
            own = members.pop(node)
            w = np.zeros(dims)
            if len(own) > 1:
                a, b = rng.choice(own, 2, replace=False)
                w = sample[a] - sample[b]
            if not np.linalg.norm(w):
                w = rng.standard_normal(dims)
            w = w / np.linalg.norm(w)
            side = sample[own] @ w
            cut = float(np.median(side)) if len(own) else 0.0
            normals[t, node], cuts[t, node] = w, cut
            members[2 * node + 1], members[2 * node + 2] = own[side <= cut], own[side > cut]
    return Forest(normals, cuts, depth)


def _entries(vectors: DataFrame, k: int) -> DataFrame:
    """(entry, vector, ids): one row per distinct vector with its k + 1 smallest ids."""
    low = smallest_per_group(vectors.select("vector", "id").distinct(), ["vector"], "id", k + 1)
    return (low.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .select(F.element_at("ids", 1).alias("entry"), "vector", "ids"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
           vector_col: str = "embedding", trees: int = TREES, sample_rows: int = SAMPLE_ROWS,
           first: int = FIRST, reach: float = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` nearest found rows of
    ``vectors`` other than the row with its own id, nearest first, ties to the smaller id. score is
    the Euclidean distance in double precision on the given vectors.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, on either
    side, nor do rows with a null id or with another length than most vectors. Repeated rows of an id
    count once; an id with several vectors is found by its nearest. With fewer than ``k`` candidates
    there are as many rows; an empty table gives none.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)

    def clean(df):
        v = F.col("vector")
        df = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
        return df.where(usable(v) & F.col("id").isNotNull())

    valid = clean(vectors)
    length = valid.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dims = length["n"] if length else 0
    valid = valid.where(F.size("vector") == dims)
    entries = stored(_entries(valid, k), "entries")
    n = entries.count()
    sample = (entries.orderBy(F.xxhash64("entry"), "entry").limit(sample_rows).select("entry", "vector")
              .toPandas().sort_values("entry"))
    points = np.array(sample["vector"].tolist(), dtype="f8").reshape(-1, max(1, dims))
    forest = spark.sparkContext.broadcast(fit(points, trees))  # bounded by the sample
    depth = forest.value.depth
    block = max(0, depth - 6)  # leaves that share their first six turns are searched together
    salts = 1 + n // (GROUP_ROWS << min(6, depth))
    id_kind = valid.schema["id"].dataType.simpleString()

    def place(batches):
        for whole in batches:
            for b in rows(whole, 4096):
                leaves = forest.value.leaves(matrix(b.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(list(leaves), pa.list_(pa.int64()))],
                    names=["entry", "vector", "leaves"])

    vector_kind = valid.schema["vector"].dataType.simpleString()
    placed = entries.select("entry", "vector").mapInArrow(
        place, f"entry {id_kind}, vector {vector_kind}, leaves array<bigint>")
    index = (placed.select("entry", "vector", "leaves", F.posexplode("leaves").alias("tree", "leaf"))
             .withColumn("salt", F.pmod(F.xxhash64("entry"), F.lit(salts)).cast("int"))
             .withColumn("block", F.shiftright("leaf", block)))
    index = stored(index, "index")
    sizes = np.zeros((trees, 2 ** depth), dtype="i8")  # one number per leaf of the bounded model
    for r in index.groupBy("tree", "leaf").count().collect():
        sizes[r["tree"], r["leaf"]] = r["count"]
    counts = spark.sparkContext.broadcast(sizes)
    asked = clean(queries).where(F.size("vector") == dims).dropDuplicates(["id", "vector"])

    width = 2 ** depth

    def taken(batches):
        """Leaves to look into: without a distance those of the first step, else all in reach. One row per
        query and block of leaves, each with all bits of the query."""
        for whole in batches:
            for b in rows(whole, 64):
                who, places, bits = [], [], []
                limits = b.column(2).to_pylist()
                for i, q in enumerate(matrix(b.column(1))):
                    have, own = 0, np.zeros((trees, width), dtype=bool)
                    for far, tree, leaf in forest.value.nearest_leaves(q):
                        if limits[i] is None:
                            if have >= first * k:
                                break
                            have += counts.value[tree, leaf]
                        elif far > reach * limits[i] ** 2:
                            break
                        own[tree, leaf] = True
                    tree, leaf = np.nonzero(own)
                    where = np.unique(np.stack([tree, leaf >> block], axis=1), axis=0)
                    packed = np.packbits(own).tobytes()
                    who += [i] * len(where)
                    places += where.tolist()
                    bits += [packed] * len(where)
                places = np.array(places, dtype="i8").reshape(-1, 2)
                at = pa.array(np.array(who, dtype="i8"))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(places[:, 0]), pa.array(places[:, 1]),
                     pa.array(bits, pa.binary())], names=["query_id", "vector", "tree", "block", "bits"])

    def look(key, held, asks):
        """Exact distances of each query to the entries that this tree ranks for it in this group."""
        out = []
        if len(held) and len(asks):
            tree = int(key[0])
            leaves = np.array(held["leaves"].tolist(), dtype="i8")
            points = np.array(held["vector"].tolist(), dtype="f8")
            names = held["entry"].to_numpy()
            upto = np.arange(tree)
            for query, vector, bits in zip(asks["query_id"], asks["vector"], asks["bits"]):
                own = np.unpackbits(np.frombuffer(bits, dtype="u1"), count=trees * width).reshape(trees, width)
                at = np.nonzero(own[tree, leaves[:, tree]])[0]
                at = at[~own[upto, leaves[at, :tree]].any(axis=1)]
                if not len(at):
                    continue
                far = np.sqrt(((points[at] - np.asarray(vector, dtype="f8")) ** 2).sum(axis=1))
                best = np.lexsort((names[at], far))[:k + 1]
                out.append(pd.DataFrame({"query_id": query, "entry": names[at][best], "score": far[best]}))
        if not out:
            return pd.DataFrame({"query_id": [], "entry": [], "score": []})
        return pd.concat(out)

    def ranked(limits: DataFrame) -> DataFrame:
        probes = (limits.select("id", "vector", "limit").mapInArrow(
            taken, f"query_id {id_kind}, vector {vector_kind}, tree bigint, block bigint, bits binary")
            .withColumn("tree", F.col("tree").cast("int"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
        near = (index.groupBy("tree", "block", "salt").cogroup(probes.groupBy("tree", "block", "salt"))
                .applyInPandas(look, f"query_id {id_kind}, entry {id_kind}, score double"))
        near = near.groupBy("query_id", "entry").agg(F.min("score").alias("score"))
        named = near.join(entries.select("entry", "ids"), "entry").select(
            "query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id != query_id")
        named = named.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    start = ranked(asked.withColumn("limit", F.lit(None).cast("double")))
    farthest = start.groupBy(F.col("query_id").alias("id")).agg(F.max("score").alias("limit"),
                                                                F.count("*").alias("found"))
    # with fewer than k found there is no distance to go by: then every leaf is in reach
    limits = asked.join(farthest, "id", "left").withColumn(
        "limit", F.when(F.col("found") >= k, F.col("limit")).otherwise(F.lit(float("inf"))))
    found = ranked(stored(limits.select("id", "vector", "limit"), "limits"))
    return found.select("query_id", "rank", "vec_id", "score")
