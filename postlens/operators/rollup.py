"""Posts by label, day and hour, kept up to date file by file, and the overview and time pages from them.

A row holds counts and sums, which add up exactly, and sketches of users and lengths, which merge within their stated error. Only new
files are read, so a page costs as many rows as there are labels, days and hours, however many posts there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.snapshots import read_version, versions, write_version
from .stats import with_share

KEYS = ("label", "day", "hour")
#: Logarithm of the registers of the user sketch, with a standard error of 1.04 / sqrt(2 ** 12) = 1.6 %.
USER_BITS = 12
#: Size of the length sketch: the rank of a quantile is off by 1.7 % at most, 99 times in 100.
LENGTH_K = 200


def rollup(posts: DataFrame) -> DataFrame:
    """``(label, day, hour, posts, length_sum, length_squares, users, lengths)``; posts without a usable date have a null day and hour."""
    length = F.col("total_len").cast("long")
    return posts.groupBy("label", F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(
        F.count("*").alias("posts"),
        F.sum(length).alias("length_sum"),
        F.sum((length * length).cast("decimal(38,0)")).cast("decimal(38,0)").alias("length_squares"),
        F.hll_sketch_agg("id", F.lit(USER_BITS)).alias("users"),
        F.kll_sketch_agg_bigint(length, F.lit(LENGTH_K)).alias("lengths"),
    )


def merged(rollups: DataFrame) -> DataFrame:
    """Rows of one label, day and hour put together."""
    return rollups.groupBy(*KEYS).agg(
        F.sum("posts").alias("posts"),
        F.sum("length_sum").alias("length_sum"),
        F.sum("length_squares").cast("decimal(38,0)").alias("length_squares"),
        F.hll_union_agg("users").alias("users"),
        F.kll_merge_agg_bigint("lengths").alias("lengths"),
    )


def _files(spark: SparkSession, table: str) -> DataFrame:
    """``(path, length, modified)`` of the files of a stored table; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(table)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def update_rollup(spark: SparkSession, table: str, path: str) -> int:
    """Fold the new files of the stored posts table ``table`` into the rollup at ``path``; gives their number.

    Each version holds the rollup and the files in it, and counts only once both are written: a run that fails is repeated
    without harm, and a file is never counted twice. Files may be added to the table but neither changed nor removed, which is an error;
    start a rollup at a new path then. The list of new files passes the driver, as Spark's plan of their scan does.
    """
    known = read_version(spark, path, "files")
    now = _files(spark, table)
    if known is None:
        known = now.limit(0)
    if not known.join(now, ["path", "length", "modified"], "left_anti").isEmpty():
        raise ValueError(f"files of {table} were changed or removed since they were counted")
    new = [r.path for r in now.join(known, "path", "left_anti").select("path").collect()]
    if not new:
        return 0
    before = read_version(spark, path, "rollup")
    added = rollup(spark.read.option("basePath", table).parquet(*new))
    counted = now.where(F.col("path").isin(new)) if len(new) < 1000 else now.join(spark.createDataFrame([(p,) for p in new], "path string"), "path", "left_semi")
    rows = added if before is None else merged(before.unionByName(added))
    write_version(spark, path, (versions(spark, path) or [-1])[-1] + 1, {"rollup": rows, "files": known.unionByName(counted)})
    return len(new)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    found = read_version(spark, path, "rollup")
    if found is None:
        raise FileNotFoundError(f"no rollup at {path}; update one first")
    return found


def rollup_overview(rows: DataFrame) -> DataFrame:
    """What ``overview`` gives; the number of users is an estimate."""
    users = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0))
    return rows.agg(F.coalesce(F.sum("posts"), F.lit(0)).alias("total_posts"), users.alias("unique_users"))


def rollup_label_summary(rows: DataFrame) -> DataFrame:
    """What ``label_summary`` gives. The variance comes from exact whole sums, so nothing cancels."""
    sums = rows.groupBy("label").agg(
        F.sum("posts").alias("count"), F.sum("length_sum").cast("decimal(38,0)").alias("s"), F.sum("length_squares").cast("decimal(38,0)").alias("q")
    )
    n = F.col("count").cast("decimal(20,0)")
    variance = (n * F.col("q") - F.col("s") * F.col("s")).cast("double") / (F.col("count").cast("double") * (F.col("count") - 1))
    per_label = sums.select(
        "label", "count", (F.col("s").cast("double") / F.col("count")).alias("normalized_volume"), F.when(F.col("count") > 1, variance).alias("variance")
    )
    shares = with_share(per_label, "count", "count_share")
    return with_share(shares, "normalized_volume", "volume_share").orderBy("label")


def rollup_hourly_profile(rows: DataFrame) -> DataFrame:
    """What ``hourly_profile`` gives."""
    counts = rows.where("day IS NOT NULL").groupBy("label", "hour").agg(F.sum("posts").alias("count"))
    in_label = F.sum("count").over(Window.partitionBy("label"))
    return counts.withColumn("percentage", F.col("count") / in_label * 100).orderBy("hour", "label")


def rollup_daily_posts(rows: DataFrame) -> DataFrame:
    """What ``daily_posts`` gives, for the operators of days, months and years."""
    return rows.where("day IS NOT NULL").groupBy(F.col("day").alias("post_date")).agg(F.sum("posts").alias("post_count")).orderBy("post_date")


def rollup_length_quartiles(rows: DataFrame) -> DataFrame:
    """``(label, users, q1, median, q3)``: estimates of the users and of the quartiles of the post length."""
    sketches = rows.groupBy("label").agg(F.hll_union_agg("users").alias("u"), F.kll_merge_agg_bigint("lengths").alias("k"))
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = [F.kll_sketch_get_quantile_bigint("k", F.lit(share)).alias(name) for name, share in shares.items()]
    return sketches.select("label", F.hll_sketch_estimate("u").alias("users"), *quartiles).orderBy("label")
