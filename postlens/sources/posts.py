"""Posts files: CSV for exchange, Parquet as the table to query."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_POSTS
from ..session import drop_folder, scratch_path, written
from ..shipping import ship_code
from .csv_splits import MOST_RECORD, read_records

# One dialect for the batch reader, the stream reader and the writer.
CSV_DIALECT = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}


def csv_read_options(trim: bool = True) -> dict[str, str]:
    blank = str(trim).lower()
    return CSV_DIALECT | {
        "multiLine": "true",
        "enforceSchema": "false",
        "ignoreLeadingWhiteSpace": blank,
        "ignoreTrailingWhiteSpace": blank,
    }


def read_posts(spark: SparkSession, path: str, trim: bool = True) -> DataFrame:
    """Raw posts, all columns text, from a CSV file or folder; columns are taken by header name.

    The columns may stand in any order, the same in every file, and others are ignored. A missing one, or a
    file whose header differs from the first one's, is an error.

    Quoted fields may hold line breaks, so Spark reads a file in one task: keep a corpus in many
    files (``write_csv`` does), or better in the table of ``write_table``. ``read_posts_in_splits`` reads large files.
    """
    names = spark.read.options(**csv_read_options(trim)).csv(path).columns
    missing = [f for f in RAW_POSTS.fieldNames() if f not in names]
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).options(**csv_read_options(trim))
    return reader.csv(path).select(*RAW_POSTS.fieldNames())


def read_posts_in_splits(spark: SparkSession, path: str, trim: bool = True, most_record: int = MOST_RECORD) -> DataFrame:
    """What ``read_posts`` gives, with as many tasks for a file as it has splits, at the price of reading it twice.

    The first reading takes place at once. Files are UTF-8 with records that end in a line feed, or both in a carriage return and one. A quote
    stands around a field, with white space at most between it and the comma, or is doubled inside one; a record with any other is
    an error, since the cuts follow from the quotes. A record may be ``most_record`` bytes long in each split.
    """
    names = spark.read.options(**csv_read_options(trim)).csv(path).columns
    missing = [f for f in RAW_POSTS.fieldNames() if f not in names]
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    records, headers = read_records(spark, path, most_record)
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {k: v for k, v in csv_read_options(trim).items() if k not in ("header", "enforceSchema")}
    told = headers.dropna().select(F.from_csv("first", fields, options).alias("h")).distinct().limit(2).collect()
    if any(list(r.h) != names for r in told):
        raise ValueError(f"files with different headers in {path}")
    value = F.when(F.col("value").endswith("\r"), F.regexp_replace("value", r"\r(?=\n|\z)", "")).otherwise(F.col("value"))
    sound = F.when(stray_quotes(value), F.raise_error(F.concat(F.lit("a quote inside an unquoted field: "), F.left(value, F.lit(200))))).otherwise(value)
    # A generator, so that the optimizer neither repeats the parsing for each column nor for each filter above.
    rows = records.select(F.inline(F.array(F.from_csv(sound, fields, options))))
    return rows.select(*[F.col(f"c{names.index(n)}").alias(n) for n in RAW_POSTS.fieldNames()])


def stray_quotes(record: Column) -> Column:
    """Whether a record has a quote that neither begins or ends a field nor is doubled inside one."""
    single = F.replace(record, F.lit('""'), F.lit(""))
    bare = F.regexp_replace(single, r'(^|,)[\x00-\x20]*"[^"]*"[\x00-\x20]*(?=,|\z)', "$1")
    return F.contains(record, F.lit('"')) & F.contains(bare, F.lit('"'))


def write_csv(posts: DataFrame, path: str) -> None:
    """Write posts as CSV files sorted by id, every field quoted.

    The sort is one range partitioning over all executors. Date and a row number follow the id in
    the key, so that one id, or one group of copies, with a large part of the rows spreads over
    many ranges.

    The rows are written to the shared folder first. A row number must come out the same when a
    lost executor makes Spark repeat a task, which it does over files and not over a shuffle;
    and the sort, which reads its input twice, does not run the plan above twice.
    """
    options = CSV_DIALECT | {
        "quoteAll": "true",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    with written(posts.select(*RAW_POSTS.fieldNames()), "csv-rows") as rows:
        ordered = (
            rows.withColumn("row", F.monotonically_increasing_id())
            .orderBy("id", "date", "row")
            .drop("row")
        )
        ordered.write.mode("overwrite").options(**options).csv(path)


def write_one_csv(posts: DataFrame, path: str) -> None:
    """Write posts as a folder with one CSV file, the layout of an exported table, by many tasks.

    Spark writes headless pieces to the shared folder, and as many tasks put each piece in its place in the file. What passes the driver is the
    name and size of each piece. The folder must be one that every executor has mounted; on other file systems one task writes the file.
    """
    spark = posts.sparkSession
    options = CSV_DIALECT | {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows = posts.select(*RAW_POSTS.fieldNames())
    pieces = scratch_path(spark, "csv-pieces")
    if any(urlparse(p).scheme not in ("", "file") for p in (path, pieces)):
        rows.coalesce(1).write.options(**options).csv(path)
        return
    ship_code(spark)
    rows.write.options(**options | {"header": "false"}).csv(pieces)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(pieces).select("path", "length")
    os.makedirs(_mounted(path))
    head = f"{_mounted(path)}/part-00000.csv"
    placed = []
    with open(head, "wb") as file:
        file.write((",".join(rows.columns) + "\n").encode())
        at = file.tell()
        for row in found.where("length > 0").orderBy("path").toLocalIterator():
            placed.append((row.path, at))
            at += row.length
        file.truncate(at)
    if placed:
        tasks = spark.sparkContext.parallelize(placed, len(placed)).toDF("path string, at long")
        tasks.mapInArrow(lambda batches: _put(batches, head), "bytes long").agg(F.sum("bytes")).collect()
    drop_folder(spark, pieces)


def _mounted(path: str) -> str:
    """A path of the shared folder as the operating system has it."""
    return "/" + path.removeprefix("file:").lstrip("/")


def _put(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    """Copy each file to its place in ``target``; a task that is repeated writes the same bytes again."""
    for batch in batches:
        for row in batch.to_pylist():
            with open(_mounted(row["path"]), "rb") as source, open(target, "r+b") as file:
                file.seek(row["at"])
                shutil.copyfileobj(source, file, 1 << 20)
                yield pa.RecordBatch.from_pydict({"bytes": pa.array([file.tell() - row["at"]], pa.int64())})


def write_table(posts: DataFrame, path: str) -> None:
    """Write cleaned posts as Parquet by label, with ``ts`` and ``total_len`` stored.

    Queries then read the columns they name, a class filter reads only its folder, and a time filter skips row groups,
    as the posts of a file are sorted by time. Posts are brought together by label before the write, so that a
    label has as many files as its size asks for; Spark splits the shuffle partitions of a large label among tasks.
    """
    by_label = posts.hint("rebalance", "label").sortWithinPartitions("label", "ts")
    by_label.write.mode("overwrite").partitionBy("label").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
