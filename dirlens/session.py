"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale. Partition counts are left to AQE; the
# caller sizes spark.sql.shuffle.partitions for the cluster.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # page HTML can be large: keep Arrow batches to the Python workers small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # delete checkpoint files (dedup rounds) once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "dirlens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Uses the cluster's ``spark.checkpoint.dir``. When it is unset, a local master
    gets a fresh temp folder (tests); on a cluster that folder would be private
    to each machine, so a clear error names the missing setting instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="dirlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and go on from the copy."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path inside the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    import uuid
    return os.path.join(base.rstrip("/"), "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``dirlens`` importable in executor Python workers (page parsing and
    other Python steps reference it by module). Zips the package once per
    application and distributes it with ``addPyFile``; harmless when the package
    is already installed on the executors."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="dirlens-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
