"""Extra columns: names that operators use themselves, and names with dots."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postlens.llm import decontam, language, linededup, mixing, sharding, tokens, toxicity
from postlens.llm.columns import with_new, with_old
from postlens.llm.queries import VOCABULARY

NAMES = [
    "key", "n", "row", "part", "pos", "u", "own", "id", "lo", "hi", "node", "lang_pred", "Score", "languages", "size", "source_size", "target", "times",
    "taken", "copy", "shard", "slot", "block", "start", "cuts", "n_words", "n_hit", "items", "spans", "k1", "k2", "removed", "n_lines", "class", "a.b",
]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(30)
    rows = rows.unionByName(rows.limit(2)).unionByName(rows.limit(1).withColumn("text", F.lit(None).cast("string")))
    path = str(tmp_path_factory.mktemp("columns") / "docs")
    rows.select("*", *[F.lit(f"own {c}").alias(c) for c in NAMES]).write.parquet(path)
    return spark.read.parquet(path)


def test_names_are_given_back(spark):
    df = spark.createDataFrame([(1, "x", "y")], ["id", "a.b", "New"])
    made = with_new(df, ("id",), lambda plain: plain.withColumn("new", F.col("id") + 1))
    assert made.columns == ["id", "a.b", "new"] and made.first()["new"] == 2
    same = with_old(df, ("id",), lambda plain: plain.withColumn("New", F.lit(5)))
    assert same.first().asDict() == {"id": 1, "a.b": "x", "New": "y"}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_hand_on_columns(spark, docs, name, stage):
    found = stage(spark, docs, SF)
    kept = [c for c in NAMES if name != "sharding" or c not in ("shard", "slot")]
    rows = found.select("doc_id", *[f"`{c}`" for c in kept]).collect()
    assert rows and all(list(r)[1:] == [f"own {c}" for c in kept] for r in rows)
    assert name == "sharding" or found.columns == docs.columns


def test_operators_replace_only_their_own_columns(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("*", *[F.lit(1).alias(c) for c in ("id", "doc", "fold")])
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").select("*", F.lit(1).alias("id"))
    made = {
        "lang_pred": language.predict(docs, language.train(docs)),
        "n_hit": decontam.find_hits(docs, benchmark, pass_bytes=5000),
        "taken": mixing.mix(docs),
        "n_lines": linededup.without_repeated_lines(docs),
        "n": tokens.with_token_counts(docs, VOCABULARY, name="n"),
        "toxic_pred": toxicity.score(docs, toxicity.train(docs, labels, ["quality", "toxic"])),
        "slot": sharding.shuffle_to_shards(docs, 3),
    }
    for new, df in made.items():
        rows = df.select(F.col(f"`{new}`").alias("new"), "`a.b`", "key").collect()
        assert len(rows) == 33 and all(r["a.b"] == "own a.b" and r["key"] == "own key" and r["new"] != f"own {new}" for r in rows)
