"""TF-IDF and multinomial logistic regression, and what the model's weights say."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, CountVectorizerModel, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import IMPORTANCE
from ..session import written
from .terms import training_stages, training_tokens, vocabulary, vocabulary_words


def train(
    posts: DataFrame, path: str | None = None, vocab_size: int = 2000, reg: float = 0.05
) -> PipelineModel:
    """Fit the six-stage pipeline; with ``path``, save it there, replacing an older model.

    The text is read and tokenised once; its tokens are written to the shared folder for the vocabulary
    and for the sparse counts. The counts, at most ``vocab_size`` numbers a post, are written too, so that
    IDF and the iterations of the regression read those and never the text. Posts without any word are a ValueError.
    """
    posts = posts.select("label", "text")
    indexer = StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="skip")
    indexed = indexer.fit(posts)
    tokenizer, remover = training_stages()
    tokens = training_tokens(indexed.transform(posts)).select("label_index", "filtered")
    with written(tokens, "tokens") as tokens:
        words = vocabulary_words(vocabulary(tokens, vocab_size))
        if not words:
            raise ValueError("no post has a word to train on")
        counter = CountVectorizerModel.from_vocabulary(
            words, inputCol="filtered", outputCol="raw_features"
        )
        counts = counter.transform(tokens).select("label_index", "raw_features")
        with written(counts, "term-counts") as counts:
            idf = IDF(inputCol="raw_features", outputCol="features").fit(counts)
            regression = LogisticRegression(
                labelCol="label_index", featuresCol="features", regParam=reg, family="multinomial"
            ).fit(idf.transform(counts))

    model = PipelineModel([indexed, tokenizer, remover, counter, idf, regression])
    if path is not None:
        model.write().overwrite().save(path)
    return model


def _stage(model: PipelineModel, kind: type):
    return next(stage for stage in model.stages if isinstance(stage, kind))


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """``(word, coefficient, class)`` for every class and word, largest coefficient first.

    The rows come from model metadata: classes x vocabulary, bounded by the training cap.
    """
    labels = _stage(model, StringIndexerModel).labels
    matrix = _stage(model, LogisticRegressionModel).coefficientMatrix.toArray().tolist()
    classes = spark.createDataFrame(list(zip(labels, matrix)), "class string, weights array<double>")
    words = list(enumerate(_stage(model, CountVectorizerModel).vocabulary))
    names = spark.createDataFrame(words, "term_index int, word string")
    weights = classes.select("class", F.posexplode("weights").alias("term_index", "coefficient"))
    importance = weights.join(names, "term_index").select(*IMPORTANCE.fieldNames())
    return importance.orderBy(F.desc("coefficient"), "class", "word")


def importance_classes(importance: DataFrame) -> DataFrame:
    return importance.select("class").distinct().orderBy("class")


def top_terms(importance: DataFrame, n: int = 20, label: str | int | None = None) -> DataFrame:
    """The ``n`` heaviest words of each class, or of one class."""
    if label is not None:
        importance = importance.where(F.col("class") == str(label))
    rank = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("coefficient"), "word"))
    return (
        importance.withColumn("rank", rank).where(F.col("rank") <= n).orderBy("class", "rank")
    )
