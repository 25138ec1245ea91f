"""Run a streaming job from the command line (``spark-submit -m``-style entry point).

    python -m ledgerflow dc-statistics --source text --path IN --out OUT [--trigger "5 seconds"]
    python -m ledgerflow fc-statistics --source kafka --bootstrap H:P --topic fc \\
        --exclusions PARQUET_DIR --out OUT
    python -m ledgerflow orders --path CSV_DIR --out OUT --within "15 minutes"
    python -m ledgerflow marks --source socket --host H --port P --out OUT --threshold 80

Checkpoints go below ``spark.checkpoint.dir`` unless ``--checkpoint`` is given. ``--trigger
availableNow`` drains what is there and stops (for replays and tests).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from . import streaming as S
from .functions.parse import epoch_to_ts
from .schemas import ORDER_EVENT
from .session import get_session
from .sources.feeds import read_csv_feed, source


def _lines(spark, a):
    opts = {"text": {"path": a.path, "max_files_per_trigger": a.max_files},
            "kafka": {"bootstrap": a.bootstrap, "topic": a.topic, "starting": a.starting,
                      "group_prefix": "ledgerflow"},
            "socket": {"host": a.host, "port": a.port}}[a.source]
    return source(spark, a.source, **opts)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="ledgerflow")
    p.add_argument("job", choices=["dc-statistics", "fc-statistics", "orders", "marks"])
    p.add_argument("--source", choices=["text", "kafka", "socket"], default="text")
    p.add_argument("--path")
    p.add_argument("--max-files", type=int, dest="max_files")
    p.add_argument("--bootstrap")
    p.add_argument("--topic")
    p.add_argument("--starting", default="latest")
    p.add_argument("--host")
    p.add_argument("--port", type=int)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint")
    p.add_argument("--trigger", default="5 seconds")
    p.add_argument("--exclusions")
    p.add_argument("--within", default="15 minutes")
    p.add_argument("--threshold", type=float, default=80.0)
    a = p.parse_args(argv)
    spark = get_session(app=f"ledgerflow-{a.job}")
    trig = a.trigger

    if a.job == "dc-statistics":
        q = S.dc_statistics(_lines(spark, a), a.out, a.checkpoint, trig)
    elif a.job == "fc-statistics":
        q = S.fc_statistics(_lines(spark, a), lambda s: s.read.parquet(a.exclusions), a.out,
                            a.checkpoint, trig)
    elif a.job == "orders":
        raw = read_csv_feed(spark, a.path, ORDER_EVENT, streaming=True,
                            max_files_per_trigger=a.max_files)
        o = raw.select("order_id", "event_type", epoch_to_ts("event_time", "s").alias("ts"),
                       F.col("event_time").alias("seq"))
        q = S.start(S.order_pattern_stream(o, within=a.within), "orders", a.checkpoint,
                    fmt="parquet", trigger=trig, path=a.out)
    else:  # marks: "name,mark,seq" lines, or "name,mark" from Kafka
        lines = _lines(spark, a)
        # running averages need an order: Kafka's offset, which orders the records of one partition
        # (key the topic by name, so that a name's records are in one), or else a sequence field
        m = lines.select("*", F.from_csv("value", "name STRING, mark DOUBLE, seq BIGINT").alias("r"))
        seq = F.col("offset") if "offset" in lines.columns else F.coalesce(
            "r.seq", F.raise_error(F.lit("a mark line without a sequence field has no order")))
        m = m.select("r.name", "r.mark", seq.cast("long").alias("seq"))
        q = S.start(S.running_average_stream(m, threshold=a.threshold), "marks", a.checkpoint,
                    fmt="parquet", trigger=trig, path=a.out)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
