"""Session construction and the shared folder for materialised data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "hearth", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read and write: ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and only read here. Where it
    is unset, a local session (tests) gets a scratch folder, registered as the
    checkpoint dir so that ``DataFrame.checkpoint`` works as well; any other
    master is refused, since its executors could not see the driver's folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="hearth-shared-")
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001 - a session may refuse runtime changes; the context dir suffices
        pass
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-path of the shared folder (never reused, never cleared)."""
    base = shared_dir(spark)
    return "/".join([base, *parts, uuid.uuid4().hex[:12]])


def materialise(spark: SparkSession, df, name: str):
    """Write ``df`` as Parquet to a fresh path of the shared folder and read it back.

    Cuts lineage and lets repeated passes read compressed columns instead of
    recomputing the plan; survives executor loss (unlike a cache).
    """
    path = scratch_path(spark, "materialised", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file-system metadata only)."""
    return path_signature(spark, path)[0]


def path_signature(spark: SparkSession, path: str) -> tuple[int, int]:
    """(total bytes, latest modification time) of ``path`` from file-system metadata."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(jpath).getLength()), int(fs.getFileStatus(jpath).getModificationTime())


__all__ = ["local_session", "shared_dir", "scratch_path", "materialise", "path_bytes", "path_signature", "path_exists"]
