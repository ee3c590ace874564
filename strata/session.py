"""Session construction and the shared scratch location.

On a cluster the session is created by the platform; ``build_session`` is for local runs and
tests.  ``checkpoint_root`` is the single place where the library decides where intermediate
files go: the folder named by ``spark.checkpoint.dir`` (shared storage on a cluster).  Only
when that setting is absent on a local master (tests, laptops) does it take a folder in the session's
warehouse.  What a session writes there goes with it: the driver's file system deletes it on exit.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should run with.  AQE re-plans joins at run time
# (broadcast only when the *measured* side is small, split skewed partitions); the session
# zone is pinned so that timestamp parsing does not depend on the machine.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from *estimated* sizes: AQE broadcasts a join side only once its shuffle has
    # run and its real size is known to be under the threshold; explicit hints are kept for
    # inputs with a size bound by construction.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # reliable checkpoints (range sequencing, long snapshot chains) are deleted by the context
    # cleaner once nothing references them, instead of accumulating in spark.checkpoint.dir
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(
    input_bytes: int,
    total_cores: int,
    shuffle_partition_bytes: int = 512 << 20,
    max_shuffle_partitions: int = 200_000,
) -> dict[str, str]:
    """Settings sized for a job that reads ``input_bytes`` on ``total_cores`` cores.

    * scan splits of 256 MiB (``maxPartitionBytes``): one task per split, well inside executor
      memory with vectorised Parquet reads;
    * an initial shuffle width of ~512 MiB of *input* per partition (shuffled data is usually
      smaller after pruning and partial aggregation), at least 2 tasks per core; AQE then
      coalesces towards 128 MiB per partition, so over-partitioning costs little;
    * skewed shuffle partitions (> 5x the median and > 1 GiB) are split by AQE in joins.

    At 100 TB on 1000 executors x 8 cores this gives ~186k initial shuffle partitions, coalesced
    at run time; at sf0.1 on 8 cores it gives 16.
    """
    width = max(2 * total_cores, -(-input_bytes // shuffle_partition_bytes))
    width = min(width, max(max_shuffle_partitions, 2 * total_cores))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    Under ``spark-submit`` (a master is already configured) the cluster's master, memory and
    parallelism are left alone — size those with ``scale_conf``.  Without one, this is a local
    run: ``local[$BENCH_CPUS]`` (default 8) with matching shuffle partitions.
    """
    from pyspark import SparkConf

    submitted = SparkConf().contains("spark.master")
    conf = dict(DEFAULT_CONF)
    builder = SparkSession.builder.appName(app_name)
    if master or not submitted:
        cpus = os.environ.get("BENCH_CPUS", "8")
        builder = builder.master(master or f"local[{cpus}]")
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
        conf["spark.driver.memory"] = "16g"
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context; the server's setting applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must be set on the Spark Connect server") from None
        return configured
    configured = _conf_checkpoint_dir(spark)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
            "(checkpoints and scratch files must survive the loss of any machine)"
        )
    # Unset on a local master (tests, laptops): a folder of our own in the session's warehouse.
    local = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_strata_scratch"
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def checkpoint_root(spark: SparkSession) -> str:
    """Root of the shared scratch area (``spark.checkpoint.dir``)."""
    configured = _conf_checkpoint_dir(spark)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # SparkContext appends a random sub-folder; its parent is the configured root.
        return current.rstrip("/").rsplit("/", 1)[0]
    return ensure_checkpoint_dir(spark).rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


# Per application and root, the folder that holds its scratch folders and is deleted when the driver ends.
_OWN_ROOTS: dict[tuple[str, str], str] = {}


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared scratch root for one run of one job.  It is not created; what is
    written there lives until ``remove_path`` or the end of the driver."""
    root = checkpoint_root(spark)
    own = _OWN_ROOTS.get((spark.sparkContext.applicationId, root))
    if own is None:
        own = f"{root}/strata/{uuid.uuid4().hex[:12]}"
        fs, path = _file_system(spark, own)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _OWN_ROOTS[spark.sparkContext.applicationId, root] = own
    return f"{own}/{purpose}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)
