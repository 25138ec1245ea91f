"""SparkSession construction and the few settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that change results (time zone) or plans (AQE) are pinned here; sizes stay overridable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keyed state on disk, not in the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # checkpoints that cut lineage (plans.guards.materialize) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ledgerflow",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with ledgerflow's defaults.

    ``master`` is only set when given, so on a cluster the launcher's master is kept.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it) or the context's checkpoint folder.
    With neither, a session whose executors run in the driver's process (``local``) gets a fresh
    temporary folder, as in tests; on a cluster that folder would not be shared, so it is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root and sc.getCheckpointDir():
        root = os.path.dirname(sc.getCheckpointDir().rstrip("/"))
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (never a machine-local temp dir on a cluster)."""
    return os.path.join(checkpoint_root(spark), *parts)


def scale_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Settings sized from the input volume and the cluster's cores.

    * scan splits of ``target_partition_mb`` (parquet row groups permitting);
    * an initial shuffle partition count that gives each shuffle partition about the same size
      when a shuffle carries the whole input (at least 2 per core, at most 200 000); AQE then
      coalesces small ones to the same advisory size;
    * skew: a partition five times the median and above twice the target is split (AQE skew join).

    For 100 TB on 8 000 cores at 256 MB: about 200 000 initial partitions of about 512 MB before
    coalescing, scan tasks of 256 MB.
    """
    target = target_partition_mb * 1024 * 1024
    initial = max(2 * total_cores, min(200_000, -(-input_bytes // target)))
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * target_partition_mb}m",
    }
