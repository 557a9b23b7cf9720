"""Session construction and the shared scratch location.

On a cluster the session is created by the launcher; jobs only *read* its
settings.  ``shared_dir`` resolves the cluster-wide folder named by
``spark.checkpoint.dir`` and only invents one (under /tmp) when the setting is
absent, which is the local/test situation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI stays on (the Spark 4 default) so a bad
# cast fails the job the way a warehouse load would.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


# Settings for a large cluster (the launcher applies them; listed here so the
# jobs' assumptions are explicit).  Shuffle partitions start high and AQE
# coalesces them to ~256 MB by measured size; skewed partitions of joins and
# rebalances are split; scans read ~256 MB splits.
CLUSTER_CONF = {
    **JOB_CONF,
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the job settings.

    ``master`` is only given for local runs (tests, bench); on a cluster the
    resource manager supplies it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(JOB_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when a local session has none (tests, local bench) is a fresh folder
    under the system temp dir created and registered; on a cluster a missing
    setting is an error, as each machine would write to its own disk.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that the driver "
                               "and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    # DataFrame.checkpoint() needs the SparkContext setting as well.
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
