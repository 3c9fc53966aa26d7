"""Uniform samples of a fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import dated


def uniform_sample(df: DataFrame, n: int, key: Sequence[str] | None, seed: int) -> DataFrame:
    """``n`` rows of ``df`` without replacement, in one pass over it.

    Each row draws a number, and the rows with the ``n`` smallest make the sample, so that copies are drawn one by one.
    ``key`` names a unique column (or several) to draw by: the sample is then the same however the rows are spread.

    Each task keeps its first ``n`` before the shuffle, groups of tasks keep theirs, and only those meet in the last sort:
    at most ``n`` rows a group, with as many groups as the session has shuffle partitions, whatever the size of the table.
    """
    if key is None:
        draw, ties = F.rand(seed), []
    else:
        draw = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
        ties = list(key)
    groups = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["sample_draw", *ties]
    rank = F.row_number().over(Window.partitionBy("sample_group").orderBy(*order))
    return (
        df.withColumns({"sample_draw": draw, "sample_group": F.spark_partition_id() % groups})
        .withColumn("sample_rank", rank)
        .where(F.col("sample_rank") <= n)
        .orderBy(*order)
        .limit(n)
        .drop("sample_draw", "sample_group", "sample_rank")
    )


def sample_features(
    posts: DataFrame, n: int = 5000, seed: int = 42, key: Sequence[str] | None = None
) -> DataFrame:
    """A random sample of ``(label, total_len, hour)`` over the dated posts; no text is read.

    ``key`` names a unique column of the posts, for a sample that does not depend on how they are stored.
    """
    features = dated(posts).select("label", "total_len", F.hour("ts").alias("hour"), *(key or ()))
    return uniform_sample(features, n, key, seed).select("label", "total_len", "hour")
