"""Session helpers.

Library code never creates a session; it only reads settings from the one it
is given.  ``local_session`` is for tests, the bench and the command line.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark") -> SparkSession:
    """A local session with AQE on, UI off and a UTC clock."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset and the master is ``local`` (tests) a private
    scratch folder is made, removed when the process ends; any other master
    without the setting is an error, as executors cannot read a folder of the
    driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return path


def _scratch_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to this application's folder below the shared checkpoint folder and read it back.

    Cuts the lineage like a checkpoint, and the planner knows the size of what it reads."""
    path = f"{_scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Delete what :func:`scratch_table` wrote in this application; results still read from it must be saved before."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidemark-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tidemark.zip")
    with zipfile.ZipFile(path, "w") as out:
        for at, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                out.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
