"""Session settings the library relies on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Timestamps carry no zone, so UTC keeps every wall-clock value unchanged.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", name: str = "tallyhawk", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Wide feature lists build thousands of expressions; noting where in
        # Python each was made costs more than making it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for data all executors must reach.

    Only a local master may fall back to a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        # The setting is fixed once a session runs, so the folder is kept here.
        context = spark.sparkContext.applicationId
        if context not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context] = tempfile.mkdtemp(prefix="tallyhawk-")
        shared = _LOCAL_FOLDERS[context]
    return shared


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder of its own in the shared folder; it does not exist yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder and go on from there.

    Unlike a checkpoint, which computes its input a second time to write it, this
    computes the rows once; lost executors cost nothing that was stored.
    """
    path = new_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package.

    On a cluster the package is installed or passed with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED or not context.master.startswith("local"):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tallyhawk-package-"), "tallyhawk")
    context.addPyFile(
        shutil.make_archive(target, "zip", os.path.dirname(root), os.path.basename(root))
    )
    _SHIPPED.add(context.applicationId)
