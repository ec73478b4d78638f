"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "fairstream", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench.

    On a cluster the submitter sets these; nothing in the library changes a session it is given.
    """
    settings = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for streaming checkpoints and staged output.

    It lies under ``spark.checkpoint.dir`` or, where that is unset, in the warehouse, both of which
    every executor can reach. ``remove_scratch`` removes the folder of a finished run.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, folder: str) -> None:
    """Removes a folder made under a name from ``scratch_dir``, wherever the cluster stores it."""
    path, files = file_system(spark, folder)
    files.delete(path, True)


def file_system(spark: SparkSession, folder: str):
    """A folder's path and the file system that holds it, as the cluster knows them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def finished_batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the ``batch=<id>`` folders whose write was committed, in order."""
    path, files = file_system(spark, folder)
    if not files.exists(path):
        return []
    of = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(s.getPath().getName().removeprefix("batch=")) for s in files.listStatus(path)
                  if s.getPath().getName().startswith("batch=")
                  and files.exists(of(s.getPath(), "_SUCCESS")))
