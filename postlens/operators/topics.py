"""Topic modelling."""

from __future__ import annotations

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TOPICS
from ..session import written
from .clean import of_label
from .terms import topic_tokens, vocabulary, vocabulary_words

VOCABULARY = 1000
MIN_DOCUMENTS = 2
MAX_SHARE = 0.90


def topics(
    posts: DataFrame,
    label: int | str | None = None,
    k: int = 5,
    words: int = 10,
    seed: int = 42,
    max_iter: int = 20,
    sample: float = 0.05,
    vocab_size: int = VOCABULARY,
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """``(topic_id, terms)`` of an LDA model over all posts or one class.

    ``sample`` is the share of the posts that the online optimiser draws in each of its ``max_iter``
    rounds, so that with the default some posts reach no round; 1.0 reads all of them in each. The
    vocabulary is the ``vocab_size`` most frequent words in ``min_documents`` posts or more and in at
    most ``max_share`` of them.

    No posts, or no word that passes the document-frequency limits, give an empty table. The
    term counts are written out first: every iteration of the optimiser samples them again.
    """
    spark = posts.sparkSession
    tokens = topic_tokens(of_label(posts, label).select("text"))
    vocab = vocabulary_words(vocabulary(tokens, vocab_size, min_documents, max_share))
    if not vocab:
        return spark.createDataFrame([], TOPICS)
    counter = CountVectorizerModel.from_vocabulary(
        vocab, inputCol="filtered", outputCol="features"
    )
    with written(counter.transform(tokens).select("features"), "topic-counts") as counts:
        model = LDA(k=k, maxIter=max_iter, seed=seed, subsamplingRate=sample).fit(counts)

    names = spark.createDataFrame(list(enumerate(vocab)), "term_index int, term string")
    ranked = model.describeTopics(words).select(
        F.col("topic").alias("topic_id"), F.posexplode("termIndices").alias("rank", "term_index")
    )
    return (
        ranked.join(names, "term_index")
        .groupBy("topic_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("ranked"))
        .select("topic_id", F.concat_ws(", ", F.col("ranked.term")).alias("terms"))
        .orderBy("topic_id")
    )


def topic_titles(topic_table: DataFrame, words: int = 3) -> DataFrame:
    """A short title per topic: its first words."""
    first = F.slice(F.split("terms", ", "), 1, words)
    return topic_table.select("topic_id", F.concat_ws(" / ", first).alias("title"))
