"""The registered queries: each takes a session and a folder of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import operators as ops
from .. import sources, streaming
from ..functions import FIRST_PERSON, clean_field, strip
from ..schema import label_dimension, with_label_name
from ..session import scratch_path, shared_dir
from . import posts_view

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(build: Query) -> Query:
    CATALOG[build.__name__] = build
    return build


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_posts(posts_view.raw_posts(spark, sf_dir))


def texts(spark: SparkSession, sf_dir: str, measure=None) -> DataFrame:
    raw = posts_view.raw_texts(spark, sf_dir, measure)
    typed = raw.withColumn("label", F.col("label").try_cast("int"))
    return typed.where(F.col("label").isNotNull()).fillna("")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles for the value comparison."""
    return df.select(
        *[
            F.round(c, digits).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


@query
def clean_posts(spark, sf_dir):
    return posts(spark, sf_dir)


@query
def overview(spark, sf_dir):
    return ops.overview(posts(spark, sf_dir))


@query
def cached_overview(spark, sf_dir):
    """The rows of a table kept on the executors, as counted when it was cached and from the cache, which is then given back."""
    path = scratch_path(spark, "cached-overview")
    kept, rows = ops.cache_posts(posts(spark, sf_dir))
    ops.overview(kept).withColumn("cached_rows", F.lit(rows)).write.parquet(path)
    kept.unpersist()
    return spark.read.parquet(path)


@query
def empty_topics(spark, sf_dir):
    """Topics asked of a class without posts: an empty table of the usual columns, counted."""
    found = ops.topics(texts(spark, sf_dir), label=9, sample=1.0)
    return found.agg(F.count("*").alias("topics"), F.count("terms").alias("terms"))


@query
def label_counts_share(spark, sf_dir):
    counts = ops.with_share(ops.label_counts(texts(spark, sf_dir)), "count")
    return rounded(with_label_name(counts))


@query
def label_names_joined(spark, sf_dir):
    """The name lookup as a join with the label dimension."""
    counts = ops.label_counts(texts(spark, sf_dir))
    return counts.join(label_dimension(spark), "label", "left")


@query
def label_length_stats(spark, sf_dir):
    stats = ops.label_length_stats(texts(spark, sf_dir))
    return rounded(with_label_name(ops.with_share(stats, "normalized_volume")), 3)


@query
def label_summary(spark, sf_dir):
    """Counts and lengths of the overview page in one pass instead of three."""
    return rounded(with_label_name(ops.label_summary(texts(spark, sf_dir))), 3)


@query
def top_users(spark, sf_dir):
    return with_label_name(ops.top_users(posts(spark, sf_dir)))


@query
def length_box(spark, sf_dir):
    return rounded(ops.length_box(texts(spark, sf_dir)))


@query
def eda_sample(spark, sf_dir):
    return ops.sample_features(posts(spark, sf_dir), key=["post_id"])


@query
def eda_sample_small(spark, sf_dir):
    """A sample smaller than the table, so that the choice of rows is tested too."""
    return ops.sample_features(posts(spark, sf_dir), n=100, seed=7, key=["post_id"])


@query
def lexicon_ratio(spark, sf_dir):
    measured = texts(spark, sf_dir, ops.with_lexicon)
    return rounded(with_label_name(ops.lexicon_ratio(measured)), 9)


@query
def lexicon_ratio_articles(spark, sf_dir):
    """The same measure for another word list."""
    words = ["the", "la", "der", "el", "été", "è"]
    measured = texts(spark, sf_dir, lambda docs: ops.with_lexicon(docs, words))
    return rounded(ops.lexicon_ratio(measured, words, "avg_articles"), 9)


LEXICONS = {"self": FIRST_PERSON, "articles": ["the", "la", "der", "el", "été", "è"], "phrases": ["i told", "it was mine", "told myself", "see http"]}


@query
def lexicon_ratios(spark, sf_dir):
    """Several word lists, one with phrases, in one reading of the texts."""
    measured = texts(spark, sf_dir, lambda docs: ops.with_lexicons(docs, LEXICONS))
    return rounded(ops.lexicon_ratios(measured, LEXICONS), 9)


@query
def hourly_profile(spark, sf_dir):
    return rounded(ops.hourly_profile(posts(spark, sf_dir)))


@query
def hourly_profile_filled(spark, sf_dir):
    return rounded(ops.hourly_profile(posts(spark, sf_dir), fill_hours=True))


@query
def hour_density(spark, sf_dir):
    return rounded(ops.hour_density(posts(spark, sf_dir)))


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup of a stored table that grows once, folded in after each load."""
    table, path = scratch_path(spark, "posts-table"), scratch_path(spark, "rollup")
    typed = posts(spark, sf_dir)
    sources.write_table(typed.where("ts IS NULL OR hour(ts) < 12"), table)
    ops.update_rollup(spark, table, path)
    typed.where("hour(ts) >= 12").write.mode("append").partitionBy("label").parquet(table)
    ops.update_rollup(spark, table, path)
    return ops.read_rollup(spark, path)


@query
def rollup_hourly_profile(spark, sf_dir):
    return rounded(ops.rollup_hourly_profile(_rollup(spark, sf_dir)))


@query
def rollup_label_summary(spark, sf_dir):
    return rounded(with_label_name(ops.rollup_label_summary(_rollup(spark, sf_dir))), 3)


@query
def hour_density_smooth(spark, sf_dir):
    return rounded(ops.hour_density_smooth(posts(spark, sf_dir)))


@query
def daily_posts(spark, sf_dir):
    return ops.daily_posts(posts(spark, sf_dir))


@query
def available_years(spark, sf_dir):
    return ops.available_years(ops.daily_posts(posts(spark, sf_dir)))


@query
def available_months(spark, sf_dir):
    return ops.available_months(ops.daily_posts(posts(spark, sf_dir)), 2023)


@query
def period_slice(spark, sf_dir):
    return ops.period_slice(ops.daily_posts(posts(spark, sf_dir)), 2023, 11)


@query
def period_totals_year(spark, sf_dir):
    return rounded(ops.period_totals(ops.daily_posts(posts(spark, sf_dir)), 2023))


@query
def period_totals_month(spark, sf_dir):
    return rounded(ops.period_totals(ops.daily_posts(posts(spark, sf_dir)), 2023, 1))


@query
def period_totals_all(spark, sf_dir):
    return rounded(ops.period_totals(ops.daily_posts(posts(spark, sf_dir))))


@query
def yoy_year(spark, sf_dir):
    return rounded(ops.year_over_year(ops.daily_posts(posts(spark, sf_dir)), "year"))


@query
def yoy_month(spark, sf_dir):
    return rounded(ops.year_over_year(ops.daily_posts(posts(spark, sf_dir)), "month"))


@query
def keyword_search(spark, sf_dir):
    return ops.keyword_search(posts(spark, sf_dir), "MYSELF it was", limit=100)


@query
def keyword_search_literal(spark, sf_dir):
    """Pattern characters in the keyword stand for themselves."""
    return ops.keyword_search(posts(spark, sf_dir), "a?b=1", limit=300)


@query
def search_count(spark, sf_dir):
    return ops.search_count(posts(spark, sf_dir), "the")


@query
def search_indexed(spark, sf_dir):
    """The same search in a stored table with trigrams, which reads the pages of the candidates."""
    path = scratch_path(spark, "search-index")
    sources.write_search_index(posts(spark, sf_dir), path)
    return ops.search_indexed(sources.read_search_index(spark, path), "MYSELF it was", limit=100)


@query
def url_clean(spark, sf_dir):
    raw = posts_view.raw_posts(spark, sf_dir)
    return raw.select(
        "post_id",
        clean_field(F.col("title")).alias("title"),
        strip(F.col("date")).alias("date"),
        clean_field(F.col("text")).alias("text"),
        strip(F.col("info")).alias("info"),
    )


@query
def url_clean_pages(spark, sf_dir):
    """The same cleaning over whole web pages, which hold many links."""
    pages = posts_view.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", clean_field(F.col("url")).alias("url"), clean_field(F.col("html")).alias("html")
    )


@query
def truth_labels(spark, sf_dir):
    """Truth lines from the events, in event order: repeated ids, short and long lines."""
    line = F.concat_ws(
        " ",
        F.concat(F.lit("u"), F.col("user_id").cast("string")),
        F.when(F.col("event_type") != "error", F.floor("value").cast("string")),
        F.when(F.col("event_type") == "signup", F.lit("extra")),
    )
    path = scratch_path(spark, "truth")
    events = posts_view.table(spark, sf_dir, "events")
    events.orderBy("event_id").select(line.alias("value")).write.text(path)
    return sources.read_truth(spark, path)


def _write_document_corpus(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Every document as XML, one writing per line of its text, and a truth file per task."""
    docs = posts_view.text_side(spark, sf_dir)
    events = posts_view.event_side(spark, sf_dir).select("post_id", "date")
    writings = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            F.col("title").alias("TITLE"),
            F.col("date").alias("DATE"),
            line.alias("TEXT"),
            F.col("info").alias("INFO"),
        ),
    )
    corpus = scratch_path(spark, "corpus")
    (
        docs.join(events, "post_id")
        .select(
            F.concat(F.lit("subject"), F.col("post_id").cast("string")).alias("ID"),
            writings.alias("WRITING"),
        )
        .write.format("xml")
        .option("rootTag", "CORPUS")
        .option("rowTag", "INDIVIDUAL")
        .save(corpus)
    )
    labels = posts_view.table(spark, sf_dir, "labels")
    paths = []
    for column in ("quality", "toxic"):
        path = scratch_path(spark, column)
        labels.select(
            F.concat(F.lit("subject"), F.col("doc_id").cast("string"), F.lit(" "), F.col(column).cast("string"))
        ).write.text(path)
        paths.append(path)
    return corpus, *paths


@query
def etl_flatten(spark, sf_dir):
    """XML corpus and truth files on disk to posts, for both tasks."""
    corpus, depression, anorexia = _write_document_corpus(spark, sf_dir)
    parts = [(corpus, depression, "depression"), (corpus, anorexia, "anorexia")]
    return sources.build_corpus(spark, parts, row_tag="INDIVIDUAL")


@query
def etl_parse(spark, sf_dir):
    """XML documents held as text, any root tag, to posts of one task."""
    docs = posts_view.text_side(spark, sf_dir)
    xml = docs.select(
        F.to_xml(
            F.struct(
                F.concat(F.lit("subject"), F.col("post_id").cast("string")).alias("ID"),
                F.array(
                    F.struct(
                        F.col("title").alias("TITLE"),
                        F.col("text").alias("TEXT"),
                        F.col("info").alias("INFO"),
                    )
                ).alias("WRITING"),
            ),
            {"rowTag": "AUTHOR"},
        ).alias("value")
    )
    truth = posts_view.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("subject"), F.col("doc_id").cast("string")).alias("id"),
        F.col("toxic").cast("string").alias("raw_label"),
    )
    return sources.flatten_documents(sources.parse_documents(xml), truth, "anorexia")


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "posts-csv")
    sources.write_csv(posts(spark, sf_dir), path)
    return ops.clean_posts(sources.read_posts(spark, path, trim=False)).drop("ts")


@query
def csv_one_file(spark, sf_dir):
    """All posts as one large quoted CSV file, the layout of an exported table, read by splits."""
    path = scratch_path(spark, "posts-one-csv")
    sources.write_one_csv(posts_view.raw_posts(spark, sf_dir), path)
    return ops.clean_posts(sources.read_posts_in_splits(spark, path, trim=False)).drop("ts")


@query
def table_roundtrip(spark, sf_dir):
    """The stored table: one class, read from its folder, with stored lengths."""
    path = scratch_path(spark, "posts-table")
    sources.write_table(posts(spark, sf_dir), path)
    depression = ops.of_label(sources.read_table(spark, path), 1)
    return depression.select("post_id", "id", "label", "ts", "total_len")


@query
def term_stats(spark, sf_dir):
    """Training vocabulary of 2,000 terms with term and document frequencies."""
    return rounded(ops.vocabulary(ops.training_tokens(texts(spark, sf_dir)), 2000))


@query
def topic_terms(spark, sf_dir):
    """Topic vocabulary of 1,000 terms within the document-frequency limits."""
    return rounded(ops.vocabulary(ops.topic_tokens(texts(spark, sf_dir)), 1000, 2, 0.90))


@query
def topic_tokens(spark, sf_dir):
    tokens = ops.topic_tokens(texts(spark, sf_dir))
    return tokens.select("post_id", F.concat_ws(" ", "filtered").alias("tokens"))


def _model(spark: SparkSession, sf_dir: str):
    """The classifier of all posts, trained by the first query that asks for it and saved under what it was trained on."""
    return sources.stored_model(texts(spark, sf_dir).select("label", "text"), f"{shared_dir(spark)}/models", ops.train)


@query
def feature_importance(spark, sf_dir):
    return ops.feature_importance(_model(spark, sf_dir), spark)


@query
def importance_pairs(spark, sf_dir):
    """The words and classes of a model that was saved and read again."""
    return ops.feature_importance(_model(spark, sf_dir), spark).select("word", "class")


@query
def importance_classes(spark, sf_dir):
    return ops.importance_classes(ops.feature_importance(_model(spark, sf_dir), spark))


@query
def weights_certificate(spark, sf_dir):
    """For each class the number of its weights, and whether the training loss is least there."""
    slopes = ops.gradient(_model(spark, sf_dir), texts(spark, sf_dir).select("label", "text"))
    return ops.certificate(slopes).select("class", "components", "optimal")


@query
def top_terms(spark, sf_dir):
    importance = ops.feature_importance(_model(spark, sf_dir), spark)
    return ops.top_terms(with_label_name(importance, "class"), 20)


@query
def topics(spark, sf_dir):
    found = ops.topics(texts(spark, sf_dir), sample=1.0)
    return found.join(ops.topic_titles(found), "topic_id")


@query
def topics_of_label(spark, sf_dir):
    return ops.topics(texts(spark, sf_dir), label=1, k=3, sample=1.0)


@query
def class_separation(spark, sf_dir):
    """Whether a model that was saved and read again gives posts with text more weight for their own class than others do."""
    worded = texts(spark, sf_dir).where("text <> ''")
    path = scratch_path(spark, "model")
    ops.train(worded, path)
    return separation(sources.read_model(spark, path), worded)


def separation(model, posts: DataFrame) -> DataFrame:
    """``(class, posts, recognised)``: the posts of each class, and whether they are told from the rest, if there is one."""
    names = model.stages[0].labels
    scored = model.transform(posts).select(
        F.col("label").cast("string").alias("label"),
        F.posexplode(vector_to_array("probability")).alias("at", "probability"),
        F.element_at(F.lit(names), F.col("at") + 1).alias("class"),
    )
    own = F.col("label") == F.col("class")
    recognised = F.avg(F.when(own, F.col("probability"))) > F.avg(F.when(~own, F.col("probability")))
    return scored.groupBy("class").agg(F.count_if(own).alias("posts"), F.coalesce(recognised, F.lit(True)).alias("recognised"))


@query
def top_terms_ranks(spark, sf_dir):
    """The ranks of one class: as many as asked for, weights falling, words of the training vocabulary."""
    posts = texts(spark, sf_dir)
    top = ops.top_terms(ops.feature_importance(_model(spark, sf_dir), spark), 20, label=1)
    known = ops.vocabulary(ops.training_tokens(posts), 2000).select(F.col("term").alias("word"))
    before = F.lag("coefficient").over(Window.partitionBy("class").orderBy("rank"))
    falling = F.coalesce(before >= F.col("coefficient"), F.lit(True))
    return top.join(known, "word").select("class", "rank", falling.alias("falling"))


@query
def topic_shapes(spark, sf_dir):
    """Words of each topic, those of them in the topic vocabulary, and whether its title is its first three."""
    posts = texts(spark, sf_dir)
    found = ops.topics(posts, sample=1.0)
    known = ops.vocabulary(ops.topic_tokens(posts), 1000, 2, 0.90).select("term", F.lit(1).alias("known"))
    words = found.select("topic_id", F.posexplode(F.split("terms", ", ")).alias("at", "term"))
    first = F.array_sort(F.collect_list(F.when(F.col("at") < 3, F.struct("at", "term"))))
    shapes = words.join(known, "term", "left").groupBy("topic_id").agg(
        F.count("*").alias("n_terms"),
        F.count("known").alias("n_known"),
        F.concat_ws(" / ", first["term"]).alias("expected"),
    )
    titles = ops.topic_titles(found)
    titled = F.col("title") == F.col("expected")
    return shapes.join(titles, "topic_id").select("topic_id", "n_terms", "n_known", titled.alias("titled"))


@query
def csv_import(spark, sf_dir):
    """A trimmed read of files whose columns stand in another order and among others."""
    path = scratch_path(spark, "posts-csv")
    raw = posts_view.raw_posts(spark, sf_dir)
    padded = [F.concat(F.lit("  "), c, F.lit(" ")).alias(c) for c in ("label", "info", "date", "id")]
    other = raw.select(*padded, F.lit(" a text ").alias("text"), F.lit("x").alias("more"), F.lit(" t").alias("title"))
    other.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return ops.clean_posts(sources.read_posts(spark, path)).select("id", "title", "text", "info", "label", "total_len", "ts")


@query
def stream_label_counts(spark, sf_dir):
    """The running count over files of raw posts, read to the end of what is there."""
    source = scratch_path(spark, "stream")
    sources.write_csv(posts_view.raw_posts(spark, sf_dir), source)
    name = f"counts_{uuid.uuid4().hex}"
    running = streaming.stream_label_counts(
        spark, source, name, scratch_path(spark, "stream-state"), {"availableNow": True}
    )
    running.awaitTermination()
    return with_label_name(streaming.read_counts(spark, name))


@query
def adhoc_sql(spark, sf_dir):
    text = """
        SELECT info, label, count(*) AS posts, max(total_len) AS longest
        FROM {posts}
        WHERE total_len >= :shortest AND ts >= :since
        GROUP BY info, label
    """
    return ops.adhoc_sql(posts(spark, sf_dir), text, shortest=500, since="2022-01-01 00:00:00")
