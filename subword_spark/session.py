"""Session helpers: a local session for tests and benches, and the checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "subword_spark") -> SparkSession:
    """A local session configured like the cluster one (AQE on, Arrow on, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SUBWORD_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``subword_spark`` importable in the Python workers (``SparkContext.addPyFile``).

    UDFs and ``mapInArrow`` functions refer to this package's modules by name; workers
    that did not start from a directory holding it (any cluster, or a driver started
    elsewhere) would fail to import them. The package is zipped once per process and
    added once per application.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect: ship the package with the server's job config
        return
    if app in _SHIPPED:
        return
    global _ZIP
    if _ZIP is None:
        root = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="subword-pkg-"), "subword_spark.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            for dirpath, dirnames, filenames in os.walk(root):
                dirnames[:] = [d for d in dirnames if d != "__pycache__"]
                for f in filenames:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        zf.write(full, os.path.join("subword_spark", os.path.relpath(full, root)))
        _ZIP = out
    sc.addPyFile(_ZIP)
    _SHIPPED.add(app)


_ZIP: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Only in
    local mode with nothing configured (tests) is a private temporary folder set; a cluster
    without the setting is an error, since a machine-local folder is not shared.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns spark.checkpoint.dir
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="subword-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder shared by all executors "
            "(HDFS, object store) so training state survives executor loss"
        )
    return sc.getCheckpointDir()


_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for what a job writes and reads back.

    It is deleted by :func:`remove_path`, or at the end of the driver process: a DataFrame
    that still reads it may outlive the function that wrote it.
    """
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH[path] = spark
    return path


def shared_table(df: DataFrame, name: str, **options) -> tuple[DataFrame, str]:
    """Write ``df`` to a scratch path and read it back: ``(table, path)``. Later actions read
    the table and never run what made it again, also after the loss of an executor.
    ``options``: the Parquet writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path through Spark's file systems; nothing happens if it is not there."""
    _SCRATCH.pop(path, None)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def has_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a glob, names a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return any(x.isDirectory() for x in found or [])


@atexit.register
def _remove_scratch() -> None:
    for path, spark in list(_SCRATCH.items()):
        with contextlib.suppress(Exception):  # the JVM may have ended before
            remove_path(spark, path)
