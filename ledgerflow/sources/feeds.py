"""Line and CSV feeds, batch or streaming, behind one ``source(kind, ...)`` factory.

``kafka`` and ``socket`` are the production feeds (the Kafka connector jar must be on the classpath;
it is not bundled with PySpark). ``text`` (one message per line in files) is the stand-in used by the
tests and by replays: with ``trigger(availableNow=True)`` it drains a folder exactly once and its
offsets live in the query checkpoint, like Kafka's.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_options(bootstrap: str, topic: str, streaming: bool = True, starting: str | None = None,
                  ending: str | None = None, max_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True, group_prefix: str | None = None,
                  **more: str) -> dict[str, str]:
    """Options of a Kafka read. ``starting`` and ``ending`` are 'earliest', 'latest' or the JSON text
    of offsets per topic and partition (as the offset ledger keeps them); ``ending`` bounds a batch
    read. By default a stream starts at the latest offsets and a batch at the earliest, and offsets
    that are no longer there fail the query. ``more`` is passed on as it is (``kafka.*`` settings)."""
    if streaming and ending is not None:
        raise ValueError("a stream has no ending offsets")
    if not streaming and starting == "latest":
        raise ValueError("a batch cannot start at the latest offsets")
    out = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
           "startingOffsets": starting or ("latest" if streaming else "earliest"),
           "failOnDataLoss": str(fail_on_data_loss).lower()}
    if not streaming:
        out["endingOffsets"] = ending or "latest"
    if streaming and max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group_prefix:
        out["groupIdPrefix"] = group_prefix
    return {**out, **more}


def offsets_json(ledger) -> str:
    """The ledger's rows (topic, partition, next_offset) as the JSON text that Kafka reads start from."""
    out: dict[str, dict[str, int]] = {}
    for r in ledger:
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["next_offset"]
    return json.dumps(out, sort_keys=True)


def source(spark: SparkSession, kind: str, *, streaming: bool = True, **opts) -> DataFrame:
    """Return a DataFrame with a ``value`` string column (plus feed metadata where there is any).

    kind='kafka':  the arguments of :func:`kafka_options`
    kind='socket': host, port (development only; not fault tolerant)
    kind='text':   path, max_files_per_trigger
    """
    reader = spark.readStream if streaming else spark.read
    if kind == "kafka":
        r = reader.format("kafka").options(**kafka_options(streaming=streaming, **opts))
        return r.load().select(F.col("value").cast("string").alias("value"),
                               "topic", "partition", "offset", "timestamp")
    if kind == "socket":
        if not streaming:
            raise ValueError("socket feeds are streaming only")
        return (reader.format("socket").option("host", opts["host"])
                .option("port", str(opts["port"])).load())
    if kind == "text":
        return read_lines(spark, opts["path"], streaming=streaming,
                          max_files_per_trigger=opts.get("max_files_per_trigger"))
    raise ValueError(f"unknown source kind {kind!r}")


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per text line in ``value``."""
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path)
    return spark.read.text(path)


def read_csv_feed(spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False,
                  trim: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Comma-separated feed with a fixed schema (no inference); fields trimmed."""
    r = spark.readStream if streaming else spark.read
    r = (r.schema(schema).option("header", "false")
         .option("ignoreLeadingWhiteSpace", str(trim).lower())
         .option("ignoreTrailingWhiteSpace", str(trim).lower())
         .option("mode", "PERMISSIVE"))
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(path)
