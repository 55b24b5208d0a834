"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run wants.  Sizes are left to AQE: it merges small shuffle
# partitions, splits skewed join partitions and switches join strategy from
# the sizes it measures at run time.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more exchange: a hot
    # key in one task is worse than a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Frames are images: Arrow batches are bounded by their bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.ui.enabled": "false",
}

# Cluster only: shuffle partitions are merged by AQE to the advisory size.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}
# Input that a cluster session is laid out for if its size is not named.
USUAL_INPUT = 1 << 40


def shuffle_partitions(input_bytes: int) -> int:
    """One partition per 128 MB of input, 200 at least; streams keep it as their state's width."""
    return max(200, -(-input_bytes // (128 << 20)))


def build_session(app_name: str = "sparktally", master: str | None = None,
                  conf: dict[str, str] | None = None, input_bytes: int = USUAL_INPUT) -> SparkSession:
    """Session with the settings above; `conf` wins over them.

    With a local master the shuffle width follows the thread count; on a
    cluster it follows `input_bytes`, and the master comes from spark-submit.
    """
    settings = dict(COMMON_CONF)
    builder = SparkSession.builder.appName(app_name)
    if master is not None and master.startswith("local"):
        builder = builder.master(master)
        threads = master.partition("[")[2].rstrip("]")
        settings["spark.sql.shuffle.partitions"] = threads if threads.isdigit() else "8"
    else:
        settings.update(CLUSTER_CONF)
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
        if master is not None:
            builder = builder.master(master)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Machine-local scratch folders of local sessions, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def _scratch_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="sparktally-")
        root = _LOCAL_ROOTS[app]
    return f"{root.rstrip('/')}/sparktally/{app}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by spark.checkpoint.dir.

    A machine-local folder is used only on a local master that names none.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """The path and its file system, whichever that is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder; nothing happens if it is gone."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application has left below its scratch folder.

    For the end of a run: results that were not yet collected read from there.
    """
    discard(spark, _scratch_root(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give `checkpoint()` a folder when the session has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoint"))
