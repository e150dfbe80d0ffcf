"""Session helpers: configuration for tests/benchmarks and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the rollup plans.  AQE re-plans joins from measured
# shuffle sizes (broadcast only what it measured small, split skewed partitions)
# and coalesces small partitions; ANSI mode keeps decimal overflow an error.
RECOMMENDED_CONF = {
    # Broadcast bound: a join side is broadcast only when its estimated (planner) or
    # measured (AQE, after its shuffle) size is under 10 MB; otherwise sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 << 20),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, max_partitions: int = 100_000) -> dict[str, str]:
    """Settings for a cluster run sized to the input volume.

    The widest shuffles (fact lines after projection and filters) carry about a
    quarter of the input, so shuffle partitions ~ input / (4 x 256 MB), at least
    200, and at most ``max_partitions`` (map-status metadata grows with them; above
    about 100 TB of input raise it, or partitions grow beyond the target).  AQE coalesces small partitions and splits
    skewed ones: a partition 5x the median and over 256 MB is split, so one hot
    item, PO or source cannot pin a third of the data to one task.
    """
    partitions = min(max_partitions, max(200, input_bytes // (4 * target_partition_bytes)))
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    })
    return conf


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "itemrollup") -> SparkSession:
    """Local session for tests and benchmarks (the cluster supplies its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and snapshots.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint dir already set on
    the context).  When neither is set, a ``local`` master -- a test session -- gets a
    temporary folder; any other master is refused, as its executors share no such folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="itemrollup-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def drop_run_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_run_dir`` named, on whatever file system holds it."""
    if not path.startswith(f"{staging_root(spark)}/itemrollup/"):
        raise ValueError(f"{path} is no run folder under the staging root")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_run_dir(spark: SparkSession, label: str = "run") -> str:
    """A unique sub-folder of the staging root for one pipeline run."""
    return f"{staging_root(spark)}/itemrollup/{label}-{uuid.uuid4().hex[:12]}"
