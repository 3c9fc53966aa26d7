"""Whether a trained classifier is the best one: the gradient of its training loss, worked out from posts, words and weights.

Training minimises the mean log loss plus ``reg / 2`` times the squares of the weights, each in units of the deviation of its word. That loss
is convex, so a model whose gradient is zero in every component is the one best model, whatever the optimiser did. Nothing here comes from
the optimiser: words are counted again, and the sums are joins and aggregations.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, IDFModel, StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, written
from .classifier import _stage
from .terms import training_tokens


class Parameters(NamedTuple):
    labels: list[str]
    words: list[str]
    idf: list[float]
    weights: list[list[float]]
    intercepts: list[float]


def parameters(model: PipelineModel) -> Parameters:
    """What a model multiplies with; a single class has an infinite intercept, which decides nothing and counts as zero."""
    regression = _stage(model, LogisticRegressionModel)
    intercepts = [b if math.isfinite(b) else 0.0 for b in regression.interceptVector.toArray().tolist()]
    labels, words = _stage(model, StringIndexerModel).labels, _stage(model, CountVectorizerModel).vocabulary
    return Parameters(list(labels), list(words), _stage(model, IDFModel).idf.toArray().tolist(), regression.coefficientMatrix.toArray().tolist(), intercepts)


def gradient(model: PipelineModel, posts: DataFrame, reg: float = 0.05) -> DataFrame:
    """``(class, word, weight, gradient)`` for every class and word, and for each class a row with a null word for its intercept.

    ``gradient`` is the change of the training loss with a weight in units of the word's deviation. Posts of a class that the model does not
    know take no part, as in training; a word that has no deviation has no gradient.

    The features are written once as rows (post, word, value). Weights, classes x vocabulary, are bounded by the training cap; what is summed by post
    meets in the task that read the post first, so one number for each post and class is shuffled, and the features once.
    """
    spark = posts.sparkSession
    labels, words, idf, matrix, intercepts = parameters(model)
    terms = spark.createDataFrame([(i, w, x, list(c)) for i, (w, x, c) in enumerate(zip(words, idf, zip(*matrix)))], "term int, word string, idf double, weights array<double>")

    known = posts.select(F.col("label").cast("string").alias("class"), "text").where(F.col("class").isin(labels))
    tokens = training_tokens(known).select(F.monotonically_increasing_id().alias("post"), "class", "filtered")
    with written(tokens.select("post", "class", F.col("filtered").alias("words")), "certificate-words") as tokens:
        counted = tokens.select("post", F.explode("words").alias("word")).groupBy("post", "word").agg(F.count("*").alias("tf"))
        features = counted.join(terms, "word").select("post", "term", (F.col("tf") * F.col("idf")).alias("x"))
        with written(features, "certificate-features") as features:
            n = tokens.count()
            classes = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(b).alias("b")) for k, b in enumerate(intercepts)])
            every = tokens.select("post", F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("class")).alias("own"), F.inline(classes))
            parts = features.join(terms.select("term", F.posexplode("weights").alias("k", "w")), "term")
            scores = parts.groupBy("post", "k").agg(F.sum(F.col("x") * F.col("w")).alias("score"))
            scored = every.join(scores, ["post", "k"], "left").withColumn("z", F.coalesce("score", F.lit(0.0)) + F.col("b"))
            post = Window.partitionBy("post")
            shifted = scored.withColumn("e", F.exp(F.col("z") - F.max("z").over(post)))
            share = F.col("e") / F.sum("e").over(post)
            rest = shifted.select("post", "k", (share - F.when(F.col("own") == F.col("k") + 1, 1.0).otherwise(0.0)).alias("r"))

            slopes = features.join(rest, "post").groupBy("term", "k").agg((F.sum(F.col("x") * F.col("r")) / n).alias("slope"))
            moments = features.groupBy("term").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
            deviation = F.sqrt(F.greatest(F.col("q") - F.col("s") * F.col("s") / n, F.lit(0.0)) / (n - 1))
            weights = terms.select("term", "word", F.posexplode("weights").alias("k", "weight"))
            each = weights.join(slopes, ["term", "k"], "left").join(moments.select("term", deviation.alias("d")), "term", "left")
            of_words = each.select("k", "word", "weight", F.when(F.col("d") > 0, F.col("slope") / F.col("d") + reg * F.col("d") * F.col("weight")).alias("gradient"))
            starts = spark.createDataFrame(list(enumerate(intercepts)), "k int, weight double")
            of_starts = rest.groupBy("k").agg((F.sum("r") / n).alias("gradient")).join(starts, "k").select("k", F.lit(None).cast("string").alias("word"), "weight", "gradient")
            names = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("k") + 1).alias("class")
            path = scratch_path(spark, "gradient")
            of_words.unionByName(of_starts).select(names, "word", "weight", "gradient").write.parquet(path)
    return spark.read.parquet(path)


def certificate(slopes: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """``(class, components, largest, optimal)``: the weights of each class, the largest slope, and whether none is over ``tolerance``."""
    largest = F.max(F.abs("gradient"))
    return slopes.groupBy("class").agg(F.count("*").alias("components"), largest.alias("largest"), (largest <= tolerance).alias("optimal")).orderBy("class")
