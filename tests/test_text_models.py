import math
from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizer, RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F

from postlens import operators as ops
from postlens.functions import topic_text
from postlens.operators import classifier, terms
from postlens.operators.terms import TOPIC_STOPS, training_stages, vocabulary_words
from postlens.plans import catalog, oracle
from postlens.schema import IMPORTANCE
from postlens.plans.catalog import separation
from postlens.session import scratch_path
from postlens.sources import read_model

from .conftest import plan_of

SF = "/root/testdata/sf0.01"
TEXTS = [
    ("The CAT sat, the cat's mat; aa über", 0),
    ("cat dog dog DOG http://dog.org/cat [removed] x", 1),
    ("mouse", 1),
    ("", 2),
    ("dog mouse bird birds [Deleted]http://bird", 2),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "text string, label int")


@pytest.fixture(scope="module")
def corpus(spark):
    return catalog.texts(spark, SF).cache()


def test_training_tokens_are_those_of_the_saved_stages(texts, corpus):
    tokenizer, remover = training_stages()
    for df in (texts, corpus):
        ours = ops.training_tokens(df.select("text"))
        stages = remover.transform(tokenizer.transform(df.select("text"))).select("text", "filtered")
        assert ours.exceptAll(stages).count() == stages.exceptAll(ours).count() == 0
    assert ops.training_tokens(texts).first().filtered == ["cat", "sat", "cat", "mat", "ber"]


def test_topic_tokens_are_those_of_the_cleaned_text(texts, corpus):
    split = RegexTokenizer(inputCol="clean", outputCol="w", pattern=r"\s+", minTokenLength=4)
    stops = StopWordsRemover.loadDefaultStopWords("english") + list(TOPIC_STOPS)
    remover = StopWordsRemover(inputCol="w", outputCol="filtered", stopWords=stops)
    for df in (texts, corpus):
        ours = ops.topic_tokens(df.select("text"))
        cleaned = df.select("text", topic_text(F.col("text")).alias("clean"))
        wanted = remover.transform(split.transform(cleaned)).select("text", "filtered")
        assert ours.exceptAll(wanted).count() == wanted.exceptAll(ours).count() == 0


def test_stop_words_of_the_sql_twin():
    spark_words = [w for w in StopWordsRemover.loadDefaultStopWords("english") if w.isalpha() and len(w) > 2]
    assert sorted(oracle.STOPS) == sorted(spark_words)


def test_term_stats_by_brute_force(corpus):
    tokens = ops.training_tokens(corpus)
    docs = [r.filtered for r in tokens.select("filtered").collect()]
    tf, df = Counter(w for d in docs for w in d), Counter(w for d in docs for w in set(d))
    got = {r.term: r for r in ops.term_stats(tokens).collect()}
    assert set(got) == set(tf)
    for word, r in got.items():
        assert (r.tf, r.df) == (tf[word], df[word])
        assert r.idf == pytest.approx(math.log((len(docs) + 1) / (df[word] + 1)))


def test_vocabulary_matches_count_vectorizer(corpus):
    tokens = ops.topic_tokens(corpus).cache()
    words = vocabulary_words(ops.vocabulary(tokens, 300, 2, 0.9))
    fitted = CountVectorizer(inputCol="filtered", outputCol="f", vocabSize=300, minDF=2.0, maxDF=0.9).fit(tokens)
    tf = {r.term: r.tf for r in ops.term_stats(tokens).collect()}
    # Ties at the cut are free, so frequencies are compared.
    assert [tf[w] for w in words] == [tf[w] for w in fitted.vocabulary]
    assert words == sorted(words, key=lambda w: (-tf[w], w))


def test_train_inspect_and_reload(spark, corpus):
    path = scratch_path(spark, "model")
    ops.train(corpus, path, vocab_size=50)
    model = ops.train(corpus, path, vocab_size=60)
    kinds = [type(s).__name__ for s in read_model(spark, path).stages]
    assert kinds == [
        "StringIndexerModel", "RegexTokenizer", "StopWordsRemover", "CountVectorizerModel", "IDFModel", "LogisticRegressionModel",
    ]
    importance = ops.feature_importance(read_model(spark, path), spark)
    assert importance.schema == IMPORTANCE and importance.count() == 3 * 60
    rows = importance.collect()
    assert [r.coefficient for r in rows] == sorted((r.coefficient for r in rows), reverse=True)
    assert {tuple(r) for r in rows} == {tuple(r) for r in ops.feature_importance(model, spark).collect()}
    assert [r["class"] for r in ops.importance_classes(importance).collect()] == ["0", "1", "2"]
    top = ops.top_terms(importance, 7).collect()
    assert Counter(r["class"] for r in top) == {"0": 7, "1": 7, "2": 7}
    best = max((r for r in rows if r["class"] == "2"), key=lambda r: r.coefficient)
    assert ops.top_terms(importance, 1, label=2).first().word == best.word
    # The saved pipeline takes raw posts: its own tokeniser stages lead to the same features.
    scored = read_model(spark, path).transform(corpus.select("label", "text"))
    assert scored.count() == corpus.count()


def test_train_on_two_classes(spark):
    rows = [("good happy day", 0), ("happy sunny", 0), ("sad rainy", 1), ("sad grey day", 1)] * 5
    model = ops.train(spark.createDataFrame(rows, "text string, label int"), vocab_size=10)
    weights = {(r["class"], r.word): r.coefficient for r in ops.feature_importance(model, spark).collect()}
    assert {c for c, _ in weights} == {"0", "1"}
    assert weights["1", "sad"] > 0 > weights["0", "sad"]
    assert weights["0", "happy"] > 0 > weights["1", "happy"]


def test_missing_model(spark):
    with pytest.raises(FileNotFoundError):
        read_model(spark, scratch_path(spark, "none"))


def test_topics(spark, corpus):
    first = ops.topics(corpus, k=3, words=6, max_iter=5).collect()
    again = ops.topics(corpus, k=3, words=6, max_iter=5).collect()
    assert first == again and [r.topic_id for r in first] == [0, 1, 2]
    words = set(vocabulary_words(ops.vocabulary(ops.topic_tokens(corpus), 1000, 2, 0.9)))
    assert all(len(r.terms.split(", ")) == 6 and set(r.terms.split(", ")) <= words for r in first)
    titles = ops.topic_titles(spark.createDataFrame(first)).collect()
    assert titles[0].title == " / ".join(first[0].terms.split(", ")[:3])


def test_topics_of_nothing(spark, texts):
    assert ops.topics(texts, label=9).collect() == []
    assert ops.topics(texts, label=0).collect() == []  # one post: no word in two of them
    assert ops.topics(texts, label=9).columns == ["topic_id", "terms"]


def test_a_spoilt_model_is_not_recognised(spark, corpus):
    from pyspark.ml.linalg import DenseMatrix

    model = ops.train(corpus, vocab_size=60)
    assert all(r.recognised for r in separation(model, corpus).collect())
    path = scratch_path(spark, "model")
    regression = model.stages[-1]
    regression.save(path)
    data = spark.read.parquet(f"{path}/data").collect()[0]
    wrong = -data.coefficientMatrix.toArray()
    spoilt = [(data.numClasses, data.numFeatures, data.interceptVector, DenseMatrix(*wrong.shape, wrong.ravel("F").tolist()), data.isMultinomial)]
    again = scratch_path(spark, "model")
    regression.save(again)
    schema = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame(spoilt, schema).coalesce(1).write.mode("overwrite").parquet(f"{again}/data")
    model.stages[-1] = type(regression).load(again)
    assert not any(r.recognised for r in separation(model, corpus).collect())


def test_training_needs_a_word(make_posts):
    with pytest.raises(ValueError, match="no post has a word"):
        ops.train(make_posts(("u", "t", "2020-01-01 00:00:00", "a 1 !", "0"), ("v", "t", "2020-01-01 00:00:00", "", "1")))


def test_training_tokenises_once(spark, make_posts, monkeypatch):
    """Vocabulary and counts read stored tokens; no text is tokenised for each of them."""
    plans = []
    monkeypatch.setattr(classifier, "vocabulary", lambda tokens, size: plans.append(plan_of(tokens)) or terms.vocabulary(tokens, size))
    model = ops.train(make_posts(*[(f"u{i}", "", "", "apple pear fig" if i % 2 else "stone gravel", str(i % 2)) for i in range(20)]))
    assert sorted(model.stages[3].vocabulary) == ["apple", "fig", "gravel", "pear", "stone"]
    assert len(plans) == 1 and "regexp_extract_all" not in plans[0]
