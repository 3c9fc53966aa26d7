"""A stored posts table that can be searched without a look at every text.

Beside the posts lie their trigrams: for each run of three characters of a lower-cased title or text the numbers of the posts that have it.
Posts are stored in order of id and date and numbered in that order, in folders by the task that wrote them and in small
pages, so a search opens the files and pages that its candidates are in.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

SIZE = 3
#: Folders of postings, and posts in a page of the stored table.
PARTS, PAGE_ROWS = 64, 128
POSTINGS = "gram string, row long, part int"

# Fixed value: every run of three characters, overlapping ones too.
RUNS = r"(?s)(?=(.{3}))"


class SearchIndex(NamedTuple):
    """``posts`` with their number ``row`` and folder ``task``; ``postings`` (part, gram, row); ``counts`` (gram, n), "" for all posts."""

    posts: DataFrame
    postings: DataFrame
    counts: DataFrame


def grams(title: Column, text: Column) -> Column:
    """The different runs of three characters of a lower-cased title or text."""
    found = [F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(RUNS), F.lit(1)) for c in (title, text)]
    return F.array_distinct(F.concat(*found))


def part_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(PARTS)).cast("int")


def write_search_index(posts: DataFrame, path: str) -> None:
    """Store ``posts`` and their trigrams below ``path``.

    Both are range-sorted over all executors. A row number ends each key, so that one id with a large part of the posts, or a trigram that
    most posts have, spreads over many ranges; the rows are written first, so that a repeated task numbers them alike.
    """
    with written(posts, "index-rows") as rows:
        key = ("id", "date", "__n")
        ordered = rows.withColumn("__n", F.monotonically_increasing_id()).repartitionByRange(*key).sortWithinPartitions(*key).drop("__n")
        numbered = ordered.withColumns({"row": F.monotonically_increasing_id(), "task": F.spark_partition_id()})
        paged = numbered.write.mode("overwrite").partitionBy("task").option("parquet.page.row.count.limit", PAGE_ROWS)
        paged.parquet(f"{path}/posts")
        numbered.limit(0).write.mode("overwrite").parquet(f"{path}/schema")  # a table without rows has no files
    spark = posts.sparkSession
    stored = _stored(spark, path)
    postings = stored.select("row", F.explode(grams(F.col("title"), F.col("text"))).alias("gram")).withColumn("part", part_of(F.col("gram")))
    key = ("part", "gram", "row")
    # Second version of the format: sorted numbers are stored as differences.
    sorted_ = postings.repartitionByRange(*key).sortWithinPartitions(*key)
    sorted_.write.mode("overwrite").partitionBy("part").option("parquet.writer.version", "PARQUET_2_0").parquet(f"{path}/postings")
    counts = spark.read.schema(POSTINGS).parquet(f"{path}/postings").groupBy("gram").agg(F.count("*").alias("n"))
    counts = counts.unionByName(stored.agg(F.count("*").alias("n")).select(F.lit("").alias("gram"), "n"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/counts")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/posts")


def read_search_index(spark: SparkSession, path: str) -> SearchIndex:
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    return SearchIndex(_stored(spark, path), postings, spark.read.parquet(f"{path}/counts"))
