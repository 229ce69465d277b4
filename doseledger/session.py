"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "doseledger", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; partition counts are left to it."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, else one beside the tables.

    A cluster whose warehouse is on local disks has no folder that all executors see, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        jpath, fs = _path(spark, spark.conf.get("spark.sql.warehouse.dir"))
        if fs.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{fs.makeQualified(jpath).toString()}/_scratch"
    return root.rstrip("/")


_mine: dict[str, tuple] = {}


def new_scratch(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that no other run uses; what is still there at the end of the driver goes then."""
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    _mine[path] = _path(spark, path)
    return path


@atexit.register
def _clear_scratch() -> None:
    for jpath, fs in _mine.values():
        # the JVM may have gone first
        with contextlib.suppress(Exception):
            fs.delete(jpath, True)


def write_scratch(df, tag: str):
    """Write a frame to scratch and read it back.

    Cuts the lineage with files that outlive executors, and gives the planner the true size.
    """
    spark = df.sparkSession
    path = new_scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_scratch(df) -> None:
    """Delete a written scratch table that no later step reads."""
    files = df.inputFiles()
    if files:
        delete_path(df.sparkSession, files[0].rpartition("/")[0])


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.exists(jpath)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under ``path``, sorted; empty when it does not exist."""
    jpath, fs = _path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob pattern matches at least one path."""
    jpath, fs = _path(spark, pattern)
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0


def delete_path(spark: SparkSession, path: str) -> None:
    jpath, fs = _path(spark, path)
    if fs.exists(jpath):
        fs.delete(jpath, True)
