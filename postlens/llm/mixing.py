"""Mix sources to target weights.

Every document gets a hash-random key. Within a source the documents stand in key order, and the
running sum of their sizes in that order is compared with the source's target: whole epochs first, then the
documents up to the budget. The running sum has two levels, so that no task needs a whole source: sums of
key ranges, and the sum inside a range. The number of ranges grows with the square root of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .columns import with_new, with_old

#: Fixed value: what separates the words that are counted.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    """``(source, source_size)`` with each ``target``: ``share`` of all sizes dealt by weight, ``most`` times the size at most.

    What is above a limit is dealt again by weight, which ends where every target is the smaller of its limit and
    of one common level times its weight. Sorted by limit over weight, the sources at their limit come first, so the level
    follows from running sums. One row for each source goes through these windows, never a document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    ranked = (
        sizes.withColumn("nth", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", F.lit(most) * F.col("source_size"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("all", F.lit(share) * F.sum("source_size").over(every))
        .withColumn("before", F.coalesce(F.sum("limit").over(ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all") - F.col("before")) / F.col("rest"))
    )
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"]
    target = F.least("limit", F.coalesce(level * F.col("weight"), F.col("limit")))
    return ranked.withColumn("target", target).select("source", "source_size", "target")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = 1.5,
    most: float = 2.0,
    weights: tuple[int, ...] = (5, 2, 1),
    seed: int = 0,
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target``, ``times`` it is in the mix and ``taken`` = times * size.

    A whole document is taken or not; the document over which the budget falls is taken if that brings the source nearer
    to its target. A null text has size 0; a null source is a source; a source of size 0 has target 0. Rows alike in id, text and
    source are rows of their own, any of which may be the one that is taken. An empty table gives an empty mix.
    Columns of ``docs`` that have one of the new names are replaced.
    """
    return with_new(docs, (id_col, text, source), lambda plain: _dealt(plain, id_col, text, source, share, most, weights, seed))


def _dealt(docs: DataFrame, id_col: str, text: str, source: str, share: float, most: float, weights: tuple[int, ...], seed: int) -> DataFrame:
    spark = docs.sparkSession
    columns = docs.columns
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    sized = docs.select(*columns, F.col(source).alias("__source"), word_count(text).alias("size"), key.alias("__key"), F.xxhash64(text).alias("__tie"))
    totals = sized.groupBy(F.col("__source").alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    path = scratch_path(spark, "mix-totals")
    totals.write.parquet(path)  # the rows are counted once; the size of the file tells Spark if it may be broadcast
    totals = spark.read.schema(totals.schema).parquet(path)
    rows = totals.agg(F.sum("n")).first()[0] or 0
    ranges = 1 << max(0, (int(rows).bit_length() + 1) // 2)
    targets = source_targets(totals.drop("n"), share, most, weights)
    path = scratch_path(spark, "mix-targets")
    targets.write.parquet(path)
    targets = spark.read.schema(targets.schema).parquet(path).withColumnRenamed("source", "__of")

    start = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
    ranged = sized.withColumn("__range", F.floor(start * F.lit(ranges) / F.lit(float(1 << 32))))
    sums = ranged.groupBy("__source", "__range").agg(F.sum("size").alias("in_range"))
    earlier = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__source").alias("__s"), F.col("__range").alias("__r"), F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("__earlier"))
    inside = Window.partitionBy("__source", "__range").orderBy("__key", "size", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("__inside", F.sum("size").over(inside))
    placed = placed.join(sums, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r")))
    placed = placed.join(targets, F.col("__source").eqNullSafe(F.col("__of")))

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - whole * F.col("source_size")
    upto = F.col("__earlier") + F.col("__inside")
    extra = (upto <= rest) | ((upto - F.col("size") < rest) & (upto - rest <= rest - (upto - F.col("size"))))
    times = whole + F.when((F.col("source_size") > 0) & (rest > 0) & extra, 1).otherwise(0)
    dealt = placed.withColumn("times", times.cast("int"))
    return dealt.select(*columns, "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, whatever their names, each row as often as the mix takes it."""

    def copies(plain: DataFrame) -> DataFrame:
        dealt = mix(plain, id_col, text, source, **options).where("times > 0")
        return dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))

    return with_old(docs, (id_col, text, source), copies)
