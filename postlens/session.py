"""Session set-up and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "postlens", **conf: str) -> SparkSession:
    """Get or create a session; master and memory come from ``spark-submit``.

    Keyword arguments use ``_`` for ``.`` in the option name after ``spark.``, for
    example ``get_session(sql_shuffle_partitions="8")``.
    """
    builder = SparkSession.builder.appName(app_name)
    builder = builder.config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in conf.items():
        builder = builder.config("spark." + key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session, whose executors share the driver's disk, may go without it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="postlens-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library has written itself."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> Iterator[DataFrame]:
    """Write ``df`` as a table in the shared folder and read it back, which cuts its lineage.

    For data that an iterative job reads many times: a lost executor then costs a re-read of its
    files, not a re-run of the scans and shuffles above. Parquet also packs the partitions by
    size, however many tasks wrote them. ``options`` are those of the Parquet writer, for rows that
    are not small. The table goes when the block ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.options(**(options or {})).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_folder(spark, path)
