"""Session helpers: settings the operators assume, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are designed around. On a cluster pass them to spark-submit;
# `local_session` applies them for tests and the bench.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join partition even when the per-key aggregate after the
    # join then needs one more (partially aggregated, so small) shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the sampled visitors' ids prune the hit side of the wide join before its shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
}


def apply_recommended(spark: SparkSession) -> None:
    """Set the recommended settings on a running session (all of them are runtime settings)."""
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)


def cluster_conf(expected_shuffle_bytes: int, advisory_bytes: int = 128 << 20,
                 max_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the largest expected shuffle.

    The initial shuffle partition count gives about one advisory-size block
    per partition at the largest shuffle (the hit join); AQE then coalesces
    the smaller shuffles and splits skewed ones. Scan splits stay at 128 MB.
    """
    partitions = max(200, -(-expected_shuffle_bytes // advisory_bytes))
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
    })
    return conf


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "attrition",
                  driver_memory: str = "8g", event_log_dir: str | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is only read here; without
    it, executors would write to their own disks, so that is an error. Under a
    local master, which has one disk, a fresh folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if sc is None or not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="attrition-ckpt-")
    if sc is None:
        return conf
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def is_local(master: str) -> bool:
    """True for ``local``, ``local[4]`` ...; ``local-cluster[...]`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def app_key(spark: SparkSession) -> str:
    """Identifies the running application (for per-session memo tables)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return str(id(spark))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver has imported it from (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="attrition-py-"), "attrition.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


_SCOPES: list[list[str]] = []


def materialise(df: DataFrame, enabled: bool = True, name: str = "rows") -> DataFrame:
    """Compute an intermediate once for several consumers.

    Written as Parquet under the shared checkpoint folder and read back: the
    result survives executor loss, cuts the lineage, and later stages read only
    the columns they need. Inside a ``scratch_scope`` it is deleted at the end.
    ``enabled=False`` returns the lazy plan unchanged.
    """
    if not enabled:
        return df
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """A job whose result is stored when the block ends: its intermediates are deleted then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")
