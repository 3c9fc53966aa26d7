"""Keyword search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT = ("id", "title", "date", "text", "label")
ORDER = ("id", "date", "title", "text", "label")


def matches(keyword: str) -> Column:
    """Whether title or text contains ``keyword``, taken literally and ignoring case."""
    needle = keyword.lower()
    return F.lower("title").contains(needle) | F.lower("text").contains(needle)


def search_count(posts: DataFrame, keyword: str) -> DataFrame:
    """How many posts ``keyword_search`` finds without a limit, in one pass and without a sort."""
    return posts.where(matches(keyword)).agg(F.count("*").alias("hits"))


def keyword_search(
    posts: DataFrame, keyword: str, limit: int = 100, ordered: bool = True
) -> DataFrame:
    """Posts whose title or text contains ``keyword``, taken literally and ignoring case.

    ``ordered`` gives the first ``limit`` hits by id and date: the same answer every time, at the
    price of a full scan. Without it Spark stops at the first partitions that fill the limit.

    A frequent word hits in every scan task, and ``limit`` whole texts from each would be too
    much for one place. So each task keeps its first hits (a ranking that Spark applies before the
    shuffle), groups of tasks, as many as the session has shuffle partitions, keep theirs, and only those meet.
    """
    hits = posts.where(matches(keyword)).select(*RESULT)
    if not ordered:
        return hits.limit(limit)
    groups = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank = F.row_number().over(Window.partitionBy("merge_group").orderBy(*ORDER))
    return (
        hits.withColumn("merge_group", F.spark_partition_id() % groups)
        .withColumn("merge_rank", rank)
        .where(F.col("merge_rank") <= limit)
        .select(*RESULT)
        .orderBy(*ORDER)
        .limit(limit)
    )
