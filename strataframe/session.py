"""Spark session construction used by tests, the bench and the entry point."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MiB splits keep each scan task's working set small at any table size.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "strataframe", extra: dict | None = None) -> SparkSession:
    """Session for local runs. On a cluster, use the cluster's session instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's ``spark.checkpoint.dir``, else the
    folder that the context already checkpoints to.

    Only a local session without either gets a scratch folder of its own, which goes when Python
    ends. On a cluster each executor would write such a folder on its own disk: that is an error.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="strataframe-ckpt-", dir="/tmp")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``strataframe`` importable by the Python workers that run its ``mapInPandas`` /
    ``applyInPandas`` steps: zip the package once and ``addPyFile`` it (Spark distributes it
    to every executor, on a cluster as in local mode)."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="strataframe-pkg-", dir="/tmp")
    atexit.register(shutil.rmtree, out_dir, ignore_errors=True)
    path = os.path.join(out_dir, "strataframe.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
