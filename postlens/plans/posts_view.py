"""A posts table derived from ``documents``, ``events`` and ``labels``.

An event is a post: it has an author and a time, the document of the same number is its text, and
the author's label row is its class. Most events have no document, and so no title and text. The raw tables hold no pronouns, links, removal marks or bad dates, so each is added to
the posts of some sources or events. Text is measured and rewritten on the documents side, below
the joins: a query that needs only lengths moves no text through a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import text_length

# The columns the queries use. A stated schema saves the job that reads it from a file footer.
TABLES = {
    "documents": "doc_id bigint, text string, source string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


# What is added to the texts of some sources.
ADDITION = r"""
    CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4') THEN ' I told myself it was mine'
         WHEN source IN ('src5', 'src6', 'src7', 'src8')
         THEN ' see http://ex.org/a?b=1 or WWW.ex.org now'
         WHEN source IN ('src9', 'src10', 'src11') THEN ' [removed]'
         ELSE '' END
"""

# The class of a label row; a contradictory one is no label.
LABEL = """
    CASE WHEN toxic = 1 AND quality = 0 THEN 'n/a' WHEN toxic = 1 THEN '2'
         WHEN quality = 1 THEN '1' WHEN quality = 0 THEN '0' END
"""

# How many months a post moves back, and which dates are spoilt.
MONTHS_BACK = """
    12 * CAST(least(floor(value / 30), 3) AS INT)
    + CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 0 END
"""
DATE = f"""
    CASE WHEN event_type = 'error' AND value < 20 THEN ''
         WHEN event_type = 'error' AND value >= 100 THEN '2024-13-01 00:00:00'
         ELSE substring(CAST(ts - make_interval(0, {MONTHS_BACK}) AS STRING), 1, 19) END
"""


def text_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS post_id",
        "substring_index(text, '\n', 1) AS title",
        f"concat(text, {ADDITION}) AS text",
        "source AS info",
    )
    return text_length(docs)


def label_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr("doc_id AS user_id", f"{LABEL} AS label")


def author_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id AS post_id", "user_id")


def event_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS post_id", "user_id", "concat('u', user_id) AS id", f"{DATE} AS date"
    )


def _length() -> Column:
    """An event without a document has a length of 0."""
    return F.coalesce("total_len", F.lit(0)).alias("total_len")


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All posts, as read: text columns, unlabelled rows included."""
    return (
        event_side(spark, sf_dir)
        .join(label_side(spark, sf_dir), "user_id", "left")
        .join(text_side(spark, sf_dir), "post_id", "left")
        .select("post_id", "id", "title", "date", "text", "info", "label", _length())
    )


def raw_texts(
    spark: SparkSession, sf_dir: str, measure: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The same posts without author and date, for queries over text and label alone.

    ``measure`` runs on the documents side of the join.
    """
    documents = text_side(spark, sf_dir)
    if measure is not None:
        documents = measure(documents)
    authors = author_side(spark, sf_dir).join(label_side(spark, sf_dir), "user_id", "left")
    posts = authors.join(documents, "post_id", "left").drop("user_id")
    return posts.withColumn("total_len", _length())
