"""Session helpers: a sane local session for tests and the bench, and the
shared scratch location every job writes to.

On a cluster the session is created by the platform and ``spark.checkpoint.dir``
names a shared, reliable folder (HDFS/S3/...). Everything this library pins or
publishes lives below that folder. Without the setting a local session (tests)
gets a temporary folder; on a cluster its absence is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_CKPT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "starloom",
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session with the settings the library is tuned for.

    AQE stays on so that partition counts, skewed as-of joins and small
    dimension broadcasts are re-planned at runtime from real statistics.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster's ``spark.checkpoint.dir`` is used as is. Only a session whose
    master is local gets a fresh temporary folder if none is named; any other
    one would write where its executors can't read."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: the server owns the checkpoint dir
        configured = spark.conf.get(_CKPT_CONF, None)
        if not configured:
            raise RuntimeError(f"set {_CKPT_CONF} to a shared folder for this session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(_CKPT_CONF, None)
    if not configured:
        configured = temporary_folder(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def temporary_folder(master: str) -> str:
    """A fresh folder on this machine, for local masters only."""
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError(f"set {_CKPT_CONF} to a folder that all machines share (master: {master})")
    return tempfile.mkdtemp(prefix="starloom-ckpt-")


def session_id(spark: SparkSession) -> str:
    """Identifier of the application behind ``spark`` (for per-app caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/starloom/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system): metadata calls, no Spark job."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_folder(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder, or ``None`` if there is no such folder."""
    p, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else None


def read_small_file(spark: SparkSession, path: str) -> str:
    p, fs = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_small_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; ``False``, and nothing written, if it exists."""
    p, fs = _file_system(spark, path)
    if fs.exists(p):
        return False
    try:
        stream = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):  # another writer was first
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this library made, with what is in it."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)
