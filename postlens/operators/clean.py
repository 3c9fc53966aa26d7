"""From raw posts to the typed posts table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse_ts
from ..schema import LABEL_NAMES


def text_length(df: DataFrame) -> DataFrame:
    """Add ``total_len``, the characters of title and text."""
    size = F.length(F.coalesce("title", F.lit(""))) + F.length(F.coalesce("text", F.lit("")))
    return df.withColumn("total_len", size)


def clean_posts(raw: DataFrame) -> DataFrame:
    """Type the label, drop rows without one, fill missing text, add ``ts`` and ``total_len``.

    ``total_len`` is taken as given when the input has it, so that a stored table, or a join
    whose text side measured itself, never reads or moves the text for it.
    """
    df = raw.withColumn("label", F.col("label").try_cast("int"))
    df = df.where(F.col("label").isNotNull())
    if "total_len" not in df.columns:
        df = text_length(df)
    return df.fillna("").withColumn("ts", parse_ts(F.col("date")))


def dated(posts: DataFrame) -> DataFrame:
    """Posts with a usable date. An empty one never parses, so ``ts`` alone tells."""
    return posts.where(F.col("ts").isNotNull())


def of_label(posts: DataFrame, label: int | str | None = None) -> DataFrame:
    """Posts of one class, given by number or display name, or all of them for ``None``."""
    if label is None:
        return posts
    by_name = {name: value for value, name in LABEL_NAMES.items()}
    return posts.where(F.col("label") == int(by_name.get(label, label)))


def cache_posts(posts: DataFrame) -> tuple[DataFrame, int]:
    """Keep the table on the executors for a session of many queries; returns it and its rows."""
    kept = posts.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()
