"""Shared pieces: table reads, lineage-cutting tables, Arrow batches as bytes, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

BATCH_BYTES = "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at a number of bytes, so a run of very long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage: write ``df`` as a table in the shared checkpoint folder and read it back.

    Later passes read the table instead of recomputing it, and a lost executor costs only its own
    tasks. The files stay until the checkpoint folder is cleared.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have: the given ones, with underscores added as needed."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: pa.Array) -> list:
    """A text column as UTF-8 bytes; null counts as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def rows(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``size`` rows."""
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """``edges`` (a, b) -> (node, component): the smallest node reachable, for every node of an edge.

    Alternating large-star and small-star rounds: every round is a min per node (combined map-side)
    and one join, so no component is gathered anywhere. Each round is written to the shared folder.
    Ends when a round changes no edge. Self loops and repeated edges are allowed; nulls are not.
    """
    def both(e):
        return e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large_star(e):
        n = both(e)
        low = n.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        return (n.where("b > a").join(low, "a")
                .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())

    def small_star(e):
        n = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = n.groupBy("a").agg(F.min("b").alias("m"))
        up = n.join(low, "a")
        return (up.select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionAll(low.select("a", F.col("m").alias("b"))).where("a != b").distinct())

    def signature(e):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                  .alias("h")).first()
        return r.n, r.h

    nodes = both(edges).select(F.col("a").alias("node")).distinct()
    e = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"),
                                            F.least("a", "b").alias("b")).distinct(), tag)
    before = signature(e)
    while before[0]:
        e = stored(small_star(large_star(e)), tag)
        now = signature(e)
        if now == before:
            break
        before = now
    return (nodes.join(e.select(F.col("a").alias("node"), F.col("b").alias("component")), "node",
                       "left").select("node", F.coalesce("component", "node").alias("component")))


def smallest_per_group(df: DataFrame, by: list, value: str, k: int, salts: int = 64) -> DataFrame:
    """The ``k`` smallest ``value`` of each group, in two steps: per salt first, so that a group
    with a third of all rows is spread over tasks and then reduced from ``salts * k`` rows."""
    salted = df.withColumn("_llm_salt", F.pmod(F.xxhash64(value), F.lit(salts)))
    first = Window.partitionBy(*by, "_llm_salt").orderBy(value)
    then = Window.partitionBy(*by).orderBy(value)
    return (salted.withColumn("_llm_rn", F.row_number().over(first)).where(F.col("_llm_rn") <= k)
            .withColumn("_llm_rn", F.row_number().over(then)).where(F.col("_llm_rn") <= k)
            .drop("_llm_salt", "_llm_rn"))
