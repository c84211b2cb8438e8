"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast only when the measured side is under the adaptive
# threshold), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # static planner broadcast limit: only sides whose estimated size is below
    # this are broadcast; everything else is a shuffled join
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # AQE coalesces small shuffle partitions up to, and splits skewed ones
    # down to, about this size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # scan splits (Parquet row groups are packed up to this size per task)
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def sizing(input_bytes: int, total_cores: int,
           target_partition_bytes: int = 200 * 1024 * 1024) -> dict[str, str]:
    """Shuffle settings for a job reading ``input_bytes`` on ``total_cores``.

    Starts with enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the input (and at least two waves of tasks);
    AQE then merges the ones that turn out small after map-side combining.
    """
    n = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {"spark.sql.shuffle.partitions": str(n),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n)}


def get_spark(master: str | None = None, app: str = "revspark",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the defaults above.

    ``master`` is only set when given (cluster submits pass it themselves).
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
    return spark


# application id -> fallback folder for local sessions without spark.checkpoint.dir
_LOCAL_FALLBACK: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session (or a checkpoint folder the
    application already set). Only a local-mode session without either (tests,
    laptops) gets a fresh temporary folder; a cluster without it is a
    configuration error, because a machine-local folder would not survive the
    loss of that machine.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_FALLBACK.get(sc.applicationId)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        path = _LOCAL_FALLBACK.setdefault(sc.applicationId,
                                          tempfile.mkdtemp(prefix="revspark-ckpt-"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for a written table."""
    return os.path.join(checkpoint_dir(spark), name)
