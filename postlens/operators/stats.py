"""Counts, lengths and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def overview(posts: DataFrame) -> DataFrame:
    """One row: number of posts and of distinct users."""
    return posts.agg(
        F.count("*").alias("total_posts"), F.count_distinct("id").alias("unique_users")
    )


def label_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("label").count().orderBy("label")


def label_length_stats(posts: DataFrame) -> DataFrame:
    """Mean and sample variance of the post length per label, in one pass."""
    return (
        posts.groupBy("label")
        .agg(
            F.avg("total_len").alias("normalized_volume"),
            F.var_samp("total_len").alias("variance"),
        )
        .orderBy("label")
    )


def label_summary(posts: DataFrame) -> DataFrame:
    """Posts, mean length and length variance per label in one pass, with the share of each."""
    per_label = posts.groupBy("label").agg(
        F.count("*").alias("count"),
        F.avg("total_len").alias("normalized_volume"),
        F.var_samp("total_len").alias("variance"),
    )
    shares = with_share(per_label, "count", "count_share")
    return with_share(shares, "normalized_volume", "volume_share").orderBy("label")


def with_share(per_label: DataFrame, col: str, name: str = "share") -> DataFrame:
    """Add each row's part of the column total. For tables of one row per class."""
    total = F.sum(col).over(Window.partitionBy())
    return per_label.withColumn(name, F.try_divide(F.col(col), total))


def top_users(posts: DataFrame, limit: int = 30) -> DataFrame:
    """The users who wrote most characters, by (id, label)."""
    return (
        posts.groupBy("id", "label")
        .agg(F.sum("total_len").alias("total_length"))
        .orderBy(F.desc("total_length"), "id", "label")
        .limit(limit)
    )


def with_box(histogram: DataFrame, value: str, by: str = "label") -> DataFrame:
    """Add each group's ``n, min, q1, median, q3, max`` to a histogram ``(by, value, count)``.

    The quartiles are exact, with linear interpolation. Working on counts keeps the state of a hot
    group at its number of distinct values, however many rows it has.
    """
    group = Window.partitionBy(by)
    quartiles = F.percentile(value, [0.25, 0.5, 0.75], F.col("count"))
    return histogram.select(
        "*",
        F.sum("count").over(group).alias("n"),
        F.min(value).over(group).alias("min"),
        F.max(value).over(group).alias("max"),
        quartiles.over(group).alias("q"),
    ).select(
        *histogram.columns,
        "n",
        "min",
        *[F.col("q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))],
        "max",
    )


def box_summary(histogram: DataFrame, value: str, by: str = "label") -> DataFrame:
    """Box-plot numbers per group: those of ``with_box``, the 1.5 IQR fences, the whiskers (the
    last values inside the fences) and the number of outliers."""
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    numbers = ("n", "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence")
    inside = F.col(value).between(F.col("lower_fence"), F.col("upper_fence"))
    return (
        with_box(histogram, value, by)
        .withColumns({"lower_fence": F.col("q1") - spread, "upper_fence": F.col("q3") + spread})
        .groupBy(by)
        .agg(
            *[F.first(c).alias(c) for c in numbers],
            F.min(F.when(inside, F.col(value))).alias("lower_whisker"),
            F.max(F.when(inside, F.col(value))).alias("upper_whisker"),
            F.sum(F.when(inside, 0).otherwise(F.col("count"))).alias("outliers"),
        )
        .orderBy(by)
    )


def length_box(posts: DataFrame) -> DataFrame:
    """Box-plot numbers of the post length per label, over all posts."""
    histogram = posts.groupBy("label", "total_len").count()
    return box_summary(histogram, "total_len")
