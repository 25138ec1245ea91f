"""Batch folders of a sink as one table: a snapshot of merged batches, named by a manifest, plus the
batches after it.

A sink writes batch N to ``root/batch_id=N`` with overwrite. :func:`compact` merges the committed batches
up to one number into ``root/_snapshots/through=N``, and only when that is complete writes the manifest
``root/_manifest/through=N``; readers take the newest complete manifest, its snapshot and the batches after
it. A compaction that is killed anywhere leaves either the old manifest, whose snapshot and batches are all
there, or the new one. Folders are removed one compaction later, so a reader that has just taken the old
manifest still finds its files. All paths go through Hadoop's file systems, as Spark's own do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH, THROUGH = "batch_id", "through"
DONE = "_SUCCESS"


def _path(spark: SparkSession, *parts: str):
    """(file system, path) of a folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path("/".join(x.rstrip("/") for x in parts))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, root: str, name: str = BATCH, complete: bool = True) -> list[int]:
    """The numbers N of the folders ``root/<name>=N``, in order; by default those written to the end."""
    fs, path = _path(spark, root)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        key, _, value = status.getPath().getName().partition("=")
        if key == name and value.isdigit() and status.isDirectory():
            if not complete or fs.exists(_path(spark, root, f"{name}={value}", DONE)[1]):
                found.append(int(value))
    return sorted(found)


def drop(spark: SparkSession, *parts: str) -> None:
    """Remove a folder of the store; one that is already gone is fine."""
    fs, path = _path(spark, *parts)
    fs.delete(path, True)


def drop_before(spark: SparkSession, root: str, number: int, name: str = BATCH) -> None:
    """Remove the folders ``root/<name>=M`` with M below ``number``."""
    for m in folders(spark, root, name, complete=False):
        if m < number:
            drop(spark, root, f"{name}={m}")


def _manifest(spark: SparkSession, root: str) -> int | None:
    done = folders(spark, f"{root.rstrip('/')}/_manifest", THROUGH)
    return done[-1] if done else None


def _swap(spark: SparkSession, root: str, through: int) -> None:
    """Make the snapshot of ``through`` the one that readers take."""
    spark.createDataFrame([(through,)], "batch long").coalesce(1).write.mode("overwrite").parquet(
        f"{root.rstrip('/')}/_manifest/{THROUGH}={through}")


def _batches(spark: SparkSession, root: str, numbers: Iterable[int]) -> DataFrame:
    root = root.rstrip("/")
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/{BATCH}={n}" for n in numbers])
    return rows.withColumn(BATCH, F.col(BATCH).cast("long"))


def _rows(spark: SparkSession, root: str, through: int | None, numbers: list[int]) -> DataFrame | None:
    parts = []
    if through is not None:
        parts.append(spark.read.parquet(f"{root.rstrip('/')}/_snapshots/{THROUGH}={through}"))
    if numbers:
        parts.append(_batches(spark, root, numbers))
    if len(parts) == 2:
        return parts[0].unionByName(parts[1])
    return parts[0] if parts else None


def read(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the store with the ``batch_id`` that wrote them."""
    through = _manifest(spark, root)
    later = [n for n in folders(spark, root) if through is None or n > through]
    rows = _rows(spark, root, through, later)
    if rows is None:
        raise ValueError(f"no batch has been written below {root}")
    return rows


def compact(spark: SparkSession, root: str, through: int,
            merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Merge the snapshot and the batches up to ``through``, which must be final: within batch N, whose
    predecessor is committed, N - 1. ``merge`` reduces their rows (columns of the batches and
    ``batch_id``) and must give the same again when applied to its own result and further batches;
    without it all rows are kept."""
    before = _manifest(spark, root)
    numbers = [n for n in folders(spark, root) if n <= through and (before is None or n > before)]
    if not numbers:
        return
    rows = _rows(spark, root, before, numbers)
    rows = merge(rows) if merge else rows
    rows.write.mode("overwrite").parquet(f"{root.rstrip('/')}/_snapshots/{THROUGH}={through}")
    _swap(spark, root, through)
    if before is not None:
        drop_before(spark, root, before + 1)
        drop_before(spark, f"{root.rstrip('/')}/_manifest", before, THROUGH)
        drop_before(spark, f"{root.rstrip('/')}/_snapshots", before, THROUGH)
