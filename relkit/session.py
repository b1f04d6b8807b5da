"""Session construction, the checkpoint folder and the output folder.

Nothing here is needed to *run* a query -- every query works on any
session it is handed.  ``build_session`` only bundles the settings that
make the plans behave well at scale (adaptive execution, skew-join
splitting, runtime broadcast conversion) for scripts and tests.
"""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that matter for scale.  ``shuffle.partitions`` is only a
# starting point: adaptive execution coalesces small partitions and
# splits skewed ones at every exchange.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static planning broadcasts a side only when Catalyst's size
    # estimate is under 10 MB; adaptive execution re-checks the real
    # shuffle size at runtime and converts to a broadcast join then.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files of a finished query are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def sizing_conf(input_bytes: int, scan_split_bytes: int = 256 * MB,
                shuffle_bytes_per_partition: int = 1024 * MB,
                min_partitions: int = 8) -> dict[str, str]:
    """Settings sized to the input, so that scan splits and shuffle
    partitions fit in executor memory:

    * scan tasks read ``scan_split_bytes`` of Parquet each (100 TB ->
      about 400k scan tasks);
    * shuffles start with one partition per ``shuffle_bytes_per_partition``
      of *input* (the shuffled data is smaller after pruning and partial
      aggregation) and adaptive execution coalesces them to the advisory
      size or splits skewed ones.

    The shuffle partition count is also the chunk count of the skew-safe
    running sums (:mod:`relkit.operators.scan`)."""
    parts = -(-int(input_bytes) // shuffle_bytes_per_partition)
    parts = max(min_partitions, parts)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
    }


def build_session(master: str | None = None, app: str = "relkit",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.  A cluster names a shared
    one in ``spark.checkpoint.dir``.  Only a local run that names none
    gets a local folder; elsewhere that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not _local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(conf_dir or tempfile.mkdtemp(prefix="relkit-ckpt-"))
    return sc.getCheckpointDir()


OUTPUT_DIR = "spark.relkit.output.dir"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme, dots resolved."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    full = fs.makeQualified(p).toUri()
    return f"{full.getScheme()}://{full.getAuthority() or ''}{posixpath.normpath(full.getPath())}"


def _has_executors(spark: SparkSession) -> bool:
    """Whether other processes than the driver run tasks now."""
    return len(spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()) > 1


_shared: set[tuple[str, str]] = set()


def _executors_share(spark: SparkSession, folder: str) -> bool:
    """Whether the driver and the executors see each other's files in the
    folder: a row per core is written there and read back, once per
    application.  Where the driver runs the tasks itself, or the folder
    can't be written, nothing is shown."""
    key = (spark.sparkContext.applicationId, folder)
    if key in _shared:
        return True
    probe = f"{folder}/_shared-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(probe)
    n = max(2, spark.sparkContext.defaultParallelism)
    try:
        spark.range(0, n, 1, n).write.parquet(probe)
        found = spark.read.schema("id bigint").parquet(probe).agg(F.count("id"), F.sum("id")).first()
        if tuple(found) == (n, n * (n - 1) // 2) and _has_executors(spark):
            _shared.add(key)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except (PySparkException, Py4JJavaError):
        return False
    return key in _shared


def output_dir(spark: SparkSession) -> str:
    """Where written tables live: the folder named by
    ``spark.relkit.output.dir``, or else the session's warehouse.  On a
    cluster a warehouse on a local file system may not be shared: it is
    used if the executors are seen to share it, else the folder that
    ``spark.checkpoint.dir`` names, and if that is not shared either the
    output folder must be named."""
    named = spark.conf.get(OUTPUT_DIR, None)
    if named:
        return named.rstrip("/")
    warehouse = qualified(spark, spark.conf.get("spark.sql.warehouse.dir"))
    # local-cluster has executors of its own
    if not warehouse.startswith("file:") or (_local(spark) and not spark.sparkContext.master.startswith("local-cluster")):
        return f"{warehouse}/relkit"
    checkpoints = spark.conf.get("spark.checkpoint.dir", None)
    for folder in [warehouse] + ([qualified(spark, checkpoints)] if checkpoints else []):
        if _executors_share(spark, f"{folder}/relkit"):
            return f"{folder}/relkit"
    raise RuntimeError(f"set {OUTPUT_DIR} to a folder that driver and executors share")
