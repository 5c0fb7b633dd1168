"""Session helpers: a local session for tests and a shared scratch folder.

On a cluster the scratch folder comes from ``spark.checkpoint.dir`` (a shared
filesystem path the cluster names); only when that is unset, as in tests, do we
set a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: str | None = None

# Settings for the cluster runs (~100 TB of facts, ~1000 executors). The initial
# shuffle partition count is high and AQE coalesces it to ~256 MB partitions, so
# one setting serves the month aggregates (tiny) and the source join (huge);
# skewed join partitions are split at run time; file splits of 256 MB keep scan
# tasks short; broadcasts stay under 64 MB (see operators/joins.checked_broadcast).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of frames that are gone are removed from the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_session(app: str = "branchbook") -> SparkSession:
    """A session for a cluster: the master, executors and ``spark.checkpoint.dir``
    come from the submit; only the SQL settings above are added."""
    b = SparkSession.builder.appName(app)
    for k, v in CLUSTER_CONF.items():
        b = b.config(k, v)
    return b.getOrCreate()


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "branchbook") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. A cluster must name one; a local
    session that names none (tests and bench) gets a local folder, created once per
    process and registered as the checkpoint folder, so ``DataFrame.checkpoint`` works too.
    """
    global _LOCAL_SCRATCH
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="branchbook-scratch-")
    path = _LOCAL_SCRATCH
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(path, "checkpoints"))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several steps read to the shared folder and read it back: column
    pruning reaches it, the lineage is cut and a lost executor costs a re-read."""
    path = f"{scratch_dir(df.sparkSession)}/stored/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
