"""Activity by hour, day, month and year.

All operators below ``daily_posts`` take its result, one row per day, so their windows and
sorts run over days and not over posts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import dated
from .stats import with_box


def _hour_counts(posts: DataFrame) -> DataFrame:
    return dated(posts).groupBy("label", F.hour("ts").alias("hour")).count()


def hourly_profile(posts: DataFrame, fill_hours: bool = False) -> DataFrame:
    """Posts per (label, hour) and their percentage within the label.

    Hours without posts are absent; ``fill_hours`` adds them as zero.
    """
    counts = _hour_counts(posts)
    if fill_hours:
        by_hour = F.map_from_entries(F.collect_list(F.struct("hour", "count")))
        counts = (
            counts.groupBy("label")
            .agg(by_hour.alias("by_hour"))
            .select("label", "by_hour", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
            .select(
                "label",
                "hour",
                F.coalesce(F.try_element_at("by_hour", "hour"), F.lit(0)).alias("count"),
            )
        )
    in_label = F.sum("count").over(Window.partitionBy("label"))
    return counts.withColumn("percentage", F.col("count") / in_label * 100).orderBy("hour", "label")


def hour_density(posts: DataFrame) -> DataFrame:
    """24-bin density of the posting hour per label, with the label's box-plot numbers."""
    return (
        with_box(_hour_counts(posts), "hour")
        .withColumn("density", F.col("count") / F.col("n"))
        .orderBy("label", "hour")
    )


def hour_density_smooth(posts: DataFrame, steps: int = 4) -> DataFrame:
    """``(label, at, density)``: a smooth density of the posting hour per label, ``steps`` points an hour, in posts' share per hour.

    The day is a circle, so late posts also count as near to early ones. Each post spreads with a von Mises kernel, which depends on the angle between
    two times of day. Its width is the normal rule's, ``1.06 s n^(-1/5)``, for the circular deviation ``s`` of the label's hours, at most that
    of evenly spread ones, and not under half an hour, since hours are all that is counted. The densities of a label sum to ``steps``.

    All work is on 24 counts a label.
    """
    counts = _hour_counts(posts).withColumn("angle", F.col("hour") * (2 * math.pi / 24))
    sums = counts.groupBy("label").agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.cos("angle")).alias("c"), F.sum(F.col("count") * F.sin("angle")).alias("s"))
    resultant = F.sqrt(F.col("c") * F.col("c") + F.col("s") * F.col("s")) / F.col("n")
    spread = F.least(F.sqrt(-2 * F.log(F.least(F.greatest(resultant, F.lit(1e-12)), F.lit(1.0)))), F.lit(math.pi / math.sqrt(3)))
    width = F.greatest(1.06 * spread * F.pow("n", F.lit(-0.2)), F.lit(math.pi / 24))
    sums = sums.select("label", "n", (1 / (width * width)).alias("kappa"))
    places = F.explode(F.sequence(F.lit(0), F.lit(24 * steps - 1))).alias("place")
    grid = sums.select("label", "n", "kappa", places)
    angle = F.col("place") * (2 * math.pi / (24 * steps))
    raised = F.exp(F.col("kappa") * (F.cos(angle - F.col("angle")) - 1))
    heights = grid.join(counts, "label").groupBy("label", "place").agg(F.sum(F.col("count") * raised).alias("height"))
    share = F.col("height") / F.sum("height").over(Window.partitionBy("label")) * steps
    return heights.select("label", (F.col("place") / steps).alias("at"), share.alias("density")).orderBy("label", "at")


def daily_posts(posts: DataFrame) -> DataFrame:
    return (
        dated(posts)
        .groupBy(F.to_date("ts").alias("post_date"))
        .agg(F.count("*").alias("post_count"))
        .orderBy("post_date")
    )


def available_years(daily: DataFrame) -> DataFrame:
    return daily.select(F.year("post_date").alias("year")).distinct().orderBy(F.desc("year"))


def available_months(daily: DataFrame, year: int) -> DataFrame:
    return (
        daily.where(F.year("post_date") == year)
        .select(F.month("post_date").alias("month"))
        .distinct()
        .orderBy("month")
    )


def period_slice(daily: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """The days of a year, or of one month of it; all days without a year."""
    if year is not None:
        daily = daily.where(F.year("post_date") == year)
        if month is not None:
            daily = daily.where(F.month("post_date") == month)
    return daily.orderBy("post_date")


def _with_delta(df: DataFrame) -> DataFrame:
    """Percentage change; NULL where there is no previous volume."""
    current, previous = F.col("post_count"), F.col("prev_count")
    return df.withColumn(
        "delta_pct", F.when(previous > 0, (current - previous) / previous * 100)
    )


def period_totals(
    daily: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """One row: posts of the period, of the same period a year before, and the change.

    Without a year the period is all days, which has nothing before it.
    """
    if year is None:
        whole = daily.agg(F.coalesce(F.sum("post_count"), F.lit(0)).alias("post_count"))
        return _with_delta(whole.withColumn("prev_count", F.lit(0).cast("bigint")))
    same = F.lit(True) if month is None else F.month("post_date") == month

    def total(y: int):
        hit = F.when((F.year("post_date") == y) & same, F.col("post_count"))
        return F.coalesce(F.sum(hit), F.lit(0))

    return _with_delta(
        daily.agg(total(year).alias("post_count"), total(year - 1).alias("prev_count"))
    )


def year_over_year(daily: DataFrame, by: str = "year") -> DataFrame:
    """Every year (``by="year"``) or month (``by="month"``) against the one a year before.

    The frame is a range of year values, so a gap year is not matched with an older one.
    """
    if by not in ("year", "month"):
        raise ValueError("by must be 'year' or 'month'")
    keys = ["year"] if by == "year" else ["year", "month"]
    periods = (
        daily.select(
            F.year("post_date").alias("year"), F.month("post_date").alias("month"), "post_count"
        )
        .groupBy(*keys)
        .agg(F.sum("post_count").alias("post_count"))
    )
    previous = Window.partitionBy(*keys[1:]).orderBy("year").rangeBetween(-1, -1)
    periods = periods.withColumn(
        "prev_count", F.coalesce(F.sum("post_count").over(previous), F.lit(0))
    )
    return _with_delta(periods).orderBy(*keys)
