"""Small tables that are replaced as a whole: numbered versions in folders of their own.

A version counts once its marker stands, and the marker is written last. So a reader meets a version whole or not at all, and a
writer that fails, or repeats a version, leaves the ones before as they were. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MARKER = "_committed"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, folder = _path(spark, path)
    if not files.exists(folder):
        return []
    return sorted(int(f.getPath().getName()[2:]) for f in files.listStatus(folder) if f.getPath().getName().startswith("v="))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the committed versions, ascending."""
    files, _ = _path(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    return [n for n in _numbers(spark, path) if files.exists(jpath(f"{path}/v={n}/{MARKER}"))]


def write_version(spark: SparkSession, path: str, number: int, tables: dict[str, DataFrame], keep: int = 2) -> None:
    """Write ``tables`` as version ``number`` and make it current; versions before the ``keep`` newest go.

    A reader of a version has until ``keep`` newer ones are there. What a failed writer left of a version is written over.
    """
    files, folder = _path(spark, f"{path}/v={number}")
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    files.delete(jpath(f"{path}/v={number}/{MARKER}"), False)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/v={number}/{name}")
    files.create(jpath(f"{path}/v={number}/{MARKER}"), True).close()
    for old in versions(spark, path)[:-keep]:
        files.delete(jpath(f"{path}/v={old}"), True)


def read_version(spark: SparkSession, path: str, name: str, before: int | None = None) -> DataFrame | None:
    """Table ``name`` of the newest committed version, or of the newest before a number; ``None`` while there is none."""
    known = [n for n in versions(spark, path) if before is None or n < before]
    return spark.read.parquet(f"{path}/v={known[-1]}/{name}") if known else None
