"""Session construction and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "lanewarden", master: str | None = None, **conf: str) -> SparkSession:
    """A session pinned to UTC with adaptive execution; ``conf`` keys use ``__`` for dots.

    Python call sites are not recorded in column expressions: looking them up took over half of the time in
    which a small micro-batch is planned.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, which need it for the functions that run in Python."""
    _ship_once(spark.sparkContext.applicationId)
    return spark


@functools.cache
def _ship_once(application: str) -> None:
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lanewarden-package-"), "lanewarden")
    zipped = shutil.make_archive(archive, "zip", os.path.dirname(here), os.path.basename(here))
    SparkSession.active().sparkContext.addPyFile(zipped)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only on a local master without one."""
    root = spark.conf.get(_CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"name a shared folder in {_CHECKPOINT_CONF}: executors do not see the driver's own")
    return _local_scratch()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="lanewarden-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that no other call returns."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back; ``options`` are the writer's.

    Cuts the lineage in storage that survives the loss of executors, and fixes the values of
    columns that a second evaluation could compute differently (row positions, range bounds).
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it lies."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
