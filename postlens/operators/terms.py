"""Tokens, term and document frequencies, and vocabularies."""

from __future__ import annotations

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import unmarked

# Frequent words removed on top of Spark's English stop words.
TRAINING_STOPS = (
    "like", "get", "one", "think", "really", "know", "even", "actually",
    "also", "good", "well", "would", "could", "haha", "yea", "yup",
)
TOPIC_STOPS = (
    "like", "just", "know", "think", "really", "want", "people", "make", "good", "time",
)

# What a token is.
TRAINING_TOKEN = "[a-zA-Z]{3,}"
TOPIC_TOKEN = "[a-z]{4,}"


def _stop_words(extra: tuple[str, ...]) -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english") + list(extra)


def training_stages() -> list:
    """Tokeniser and stop-word remover of a saved model: ``text`` to ``filtered``."""
    tokenizer = RegexTokenizer(
        inputCol="text", outputCol="raw_words", pattern=TRAINING_TOKEN, gaps=False
    )
    remover = StopWordsRemover(
        inputCol="raw_words", outputCol="filtered", stopWords=_stop_words(TRAINING_STOPS)
    )
    return [tokenizer, remover]


def _tokens(text: Column, pattern: str, stops: list[str]) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.filter(found, lambda word: ~word.isin(*stops))


def training_tokens(posts: DataFrame) -> DataFrame:
    """Add ``filtered``, the classification tokens of ``text``: what ``training_stages`` give.

    Built-in expressions keep the arrays in Spark's own format; the ML stages copy each token
    to an object and back, which makes what reads them three times slower.
    """
    stops = _stop_words(TRAINING_STOPS)
    return posts.withColumn("filtered", _tokens(F.lower(F.coalesce("text", F.lit(""))), TRAINING_TOKEN, stops))


def topic_tokens(posts: DataFrame) -> DataFrame:
    """Add ``filtered``, the topic-model tokens of ``text``.

    They are the words of ``topic_text`` with four letters or more, read straight from the runs
    of letters.
    """
    stops = _stop_words(TOPIC_STOPS)
    return posts.withColumn("filtered", _tokens(unmarked(F.coalesce("text", F.lit(""))), TOPIC_TOKEN, stops))


def term_stats(tokens: DataFrame, column: str = "filtered") -> DataFrame:
    """Every term with its occurrences ``tf``, its documents ``df`` and ``idf = ln((m+1)/(df+1))``.

    One aggregation: each occurrence counts for ``tf`` and each distinct term of a document for
    ``df``, so no (document, term) pairs are shuffled and a term that fills a third of the corpus
    is summed before the exchange.
    """
    both = F.array(
        F.struct(F.col(column).alias("words"), F.lit(False).alias("distinct")),
        F.struct(F.array_distinct(column).alias("words"), F.lit(True).alias("distinct")),
    )
    counted = (
        tokens.select(F.inline(both))
        .select("distinct", F.explode("words").alias("term"))
        .groupBy("term")
        .agg(
            F.count_if(~F.col("distinct")).alias("tf"), F.count_if(F.col("distinct")).alias("df")
        )
    )
    m = tokens.agg(F.count("*").alias("m")).scalar()
    return counted.withColumn("idf", F.log((m + 1) / (F.col("df") + 1)))


def vocabulary(
    tokens: DataFrame,
    size: int,
    min_df: int = 1,
    max_df_share: float = 1.0,
    column: str = "filtered",
) -> DataFrame:
    """The ``size`` most frequent terms within the document-frequency limits.

    Ties at the cut go to the alphabetically first term.
    """
    m = tokens.agg(F.count("*").alias("m")).scalar()
    return (
        term_stats(tokens, column)
        .where((F.col("df") >= min_df) & (F.col("df") <= m * max_df_share))
        .orderBy(F.desc("tf"), "term")
        .limit(size)
    )


def vocabulary_words(vocab: DataFrame) -> list[str]:
    """The words of a vocabulary in rank order; its size is the caller's parameter."""
    rows = vocab.select("term", "tf").orderBy(F.desc("tf"), "term").collect()
    return [row["term"] for row in rows]
