"""A corpus pipeline over ``documents``: language, near duplicates, benchmark passages, source mix, shards.

Each stage takes and returns documents, written as Parquet in between, so that a stage is repeated from files. Columns that no stage
uses go through as they are, whatever their names; only the last stage replaces a ``shard`` and a ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import decontam, language, mixing, neardup, sharding
from postlens.llm.columns import with_old
from postlens.llm.shipping import ship_code
from postlens.session import scratch_path

SHARDS = 24
#: Least proportion of the main language of a document that stays.
MAIN_LANGUAGE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of one main language stay; those without letters or that are a medley without a main language go."""
    ship_code(spark)

    def found(plain: DataFrame) -> DataFrame:
        known = language.predict(plain, language.train(plain))
        return known.where((F.col("lang_pred") != "und") & (F.col("score") >= MAIN_LANGUAGE))

    return with_old(docs, ("text", "lang"), found)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    ship_code(spark)
    return neardup.without_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one word in twenty inside windows of benchmark items go, the others stay as they are."""
    benchmark = ship_code(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return with_old(docs, ("text",), lambda plain: decontam.find_hits(plain, benchmark).where(~decontam.contaminated()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it."""
    return sharding.shuffle_to_shards(docs, SHARDS)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: No SQL twin: the language model and the near-duplicate classes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
