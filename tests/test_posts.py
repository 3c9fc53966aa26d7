import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens import operators as ops
from postlens.schema import RAW_POSTS, with_label_name

from .conftest import plan_of


def test_clean_posts(spark):
    rows = [
        ("a", None, "2020-01-01 00:00:00", "xy", None, " 1 "),
        ("b", "t", "", None, "i", "0"),
        ("c", "t", None, "x", "i", "n/a"),
        ("d", "t", None, "x", "i", ""),
        ("e", "t", None, "x", "i", None),
        ("f", "été", "2020-02-30 00:00:00", "x", "i", "2"),
        ("g", "t", "", "x", "i", "1.0"),
    ]
    got = ops.clean_posts(spark.createDataFrame(rows, RAW_POSTS)).orderBy("id").collect()
    assert [(r.id, r.title, r.text, r.info, r.label, r.total_len) for r in got] == [
        ("a", "", "xy", "", 1, 2),
        ("b", "t", "", "i", 0, 1),
        ("f", "été", "x", "i", 2, 4),
    ]
    assert [r.ts is None for r in got] == [False, True, True]


def test_clean_keeps_a_given_length(spark):
    df = spark.createDataFrame([("a", "", "", "text", "1", 99)], "id string, title string, date string, text string, label string, total_len int")
    assert ops.clean_posts(df).first().total_len == 99


def test_cache_and_filter(make_posts):
    posts = make_posts(("a", "t", "", "x", "1"), ("b", "t", "", "x", "0"), ("c", "t", "", "x", "bad"))
    kept, rows = ops.cache_posts(posts)
    assert rows == 2 and kept.is_cached
    kept.unpersist()
    assert [r.id for r in ops.of_label(posts, "1").collect()] == ["a"]
    assert [r.id for r in ops.of_label(posts, "Control (Sani)").collect()] == ["b"]
    assert ops.of_label(posts).count() == 2


def test_counts_and_shares(make_posts):
    posts = make_posts(
        ("a", "", "", "x" * 4, "0"), ("a", "", "", "x" * 8, "0"), ("b", "t", "", "x", "1"), ("c", "", "", "", "7")
    )
    row = ops.overview(posts).first()
    assert (row.total_posts, row.unique_users) == (4, 3)
    counts = with_label_name(ops.with_share(ops.label_counts(posts), "count")).collect()
    assert [tuple(r) for r in counts] == [
        (0, 2, 0.5, "Control (Sani)"), (1, 1, 0.25, "Depression"), (7, 1, 0.25, None),
    ]
    stats = {r.label: (r.normalized_volume, r.variance) for r in ops.label_length_stats(posts).collect()}
    assert stats == {0: (6.0, 8.0), 1: (2.0, None), 7: (0.0, None)}


def test_top_users(make_posts):
    posts = make_posts(
        ("b", "", "", "xx", "0"), ("a", "", "", "xx", "0"), ("a", "", "", "xx", "1"), ("c", "", "", "xxx", "0")
    )
    got = [tuple(r) for r in ops.top_users(posts, 3).collect()]
    assert got == [("c", 0, 3), ("a", 0, 2), ("a", 1, 2)]


def test_box_summary_against_numpy(spark):
    rng = np.random.default_rng(5)
    values = {k: (rng.lognormal(3, 1.2, n).astype(int)).tolist() for k, n in ((0, 1), (1, 2), (2, 501), (3, 4000))}
    values[4] = [9] * 3000 + [1, 2, 50]
    rows = [(k, v) for k, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "label int, total_len int")
    got = {r.label: r for r in ops.length_box(df).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        q1, q2, q3 = np.percentile(vs, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = [v for v in vs if low <= v <= high]
        r = got[k]
        assert (r.n, r.min, r.max) == (len(vs), min(vs), max(vs))
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, q2, q3))
        assert (r.lower_whisker, r.upper_whisker, r.outliers) == (min(inside), max(inside), len(vs) - len(inside))


def test_lexicon_ratio(make_posts):
    posts = make_posts(("a", "", "", "i am me", "0"), ("a", "", "", "", "0"), ("b", "", "", "no", "1"))
    got = {r.label: r.avg_self_ref for r in ops.lexicon_ratio(posts).collect()}
    assert got == {0: pytest.approx((2 / 3 + 0) / 2), 1: 0.0}
    early = ops.lexicon_ratio(ops.with_lexicon(posts, ["am"]), name="r")
    assert {r.label: r.r for r in early.collect()} == {0: pytest.approx(1 / 6), 1: 0.0}


DATED = [
    ("a", "", "2019-05-01 10:00:00", "x", "0"),
    ("a", "", "2019-05-01 10:59:59", "x", "0"),
    ("a", "", "2020-05-02 23:00:00", "x", "0"),
    ("b", "", "2020-06-01 00:00:00", "x", "1"),
    ("b", "", "2022-05-01 00:30:00", "x", "1"),
    ("b", "", "", "x", "1"),
    ("b", "", "2022-05-32 00:00:00", "x", "1"),
]


def test_hourly_profile(make_posts):
    posts = make_posts(*DATED)
    got = [(r.label, r.hour, r["count"], round(r.percentage, 3)) for r in ops.hourly_profile(posts).collect()]
    assert got == [(1, 0, 2, 100.0), (0, 10, 2, 66.667), (0, 23, 1, 33.333)]
    filled = ops.hourly_profile(posts, fill_hours=True).collect()
    assert len(filled) == 48 and sum(r["count"] for r in filled) == 5
    density = ops.hour_density(posts).collect()
    assert [(r.label, r.hour, r.n, r.median) for r in density] == [(0, 10, 3, 10.0), (0, 23, 3, 10.0), (1, 0, 2, 0.0)]


def test_days_and_periods(make_posts):
    daily = ops.daily_posts(make_posts(*DATED))
    assert [(str(r.post_date), r.post_count) for r in daily.collect()] == [
        ("2019-05-01", 2), ("2020-05-02", 1), ("2020-06-01", 1), ("2022-05-01", 1),
    ]
    assert [r.year for r in ops.available_years(daily).collect()] == [2022, 2020, 2019]
    assert [r.month for r in ops.available_months(daily, 2020).collect()] == [5, 6]
    assert ops.period_slice(daily).count() == 4
    assert ops.period_slice(daily, 2020).count() == 2
    assert [str(r.post_date) for r in ops.period_slice(daily, 2020, 6).collect()] == ["2020-06-01"]
    assert tuple(ops.period_totals(daily, 2020).first()) == (2, 2, 0.0)
    assert tuple(ops.period_totals(daily, 2020, 5).first()) == (1, 2, -50.0)
    assert tuple(ops.period_totals(daily, 2022).first()) == (1, 0, None)
    assert tuple(ops.period_totals(daily, 1999).first()) == (0, 0, None)
    assert tuple(ops.period_totals(daily).first()) == (5, 0, None)


def test_year_over_year_skips_gap_years(make_posts):
    daily = ops.daily_posts(make_posts(*DATED))
    assert [tuple(r) for r in ops.year_over_year(daily).collect()] == [
        (2019, 2, 0, None), (2020, 2, 2, 0.0), (2022, 1, 0, None),
    ]
    assert [tuple(r) for r in ops.year_over_year(daily, "month").collect()] == [
        (2019, 5, 2, 0, None), (2020, 5, 1, 2, -50.0), (2020, 6, 1, 0, None), (2022, 5, 1, 0, None),
    ]
    with pytest.raises(ValueError):
        ops.year_over_year(daily, "week")


def test_keyword_search(make_posts):
    posts = make_posts(
        ("b", "Title A.B", "", "x", "0"), ("a", "", "", "has a.b!", "1"), ("c", "axb", "", "none", "0")
    )
    assert [r.id for r in ops.keyword_search(posts, "A.b").collect()] == ["a", "b"]
    assert [r.id for r in ops.keyword_search(posts, "A.b", 1).collect()] == ["a"]
    assert ops.keyword_search(posts, "A.b", 1, ordered=False).count() == 1
    assert ops.keyword_search(posts, "zzz").count() == 0
    assert ops.keyword_search(posts, "a").columns == ["id", "title", "date", "text", "label"]


def test_keyword_search_merges_many_tasks(spark):
    """One user with a third of the hits, spread over more tasks than merge groups."""
    from postlens.operators import search

    n = 6000
    posts = spark.range(n, numPartitions=300).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("id"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("date"),
        F.lit("").alias("title"),
        F.lit("the word").alias("text"),
        F.lit(1).alias("label"),
    )
    got = ops.keyword_search(posts, "WORD", 50)
    assert [tuple(r)[:3:2] for r in got.collect()] == [("hot", f"{3 * i:06d}") for i in range(50)]
    assert "row_number(), 50, Partial" in plan_of(ops.keyword_search(posts, "WORD", 50))


def test_sample(spark):
    posts = spark.range(20000, numPartitions=20).select(
        F.col("id").alias("post_id"),
        (F.col("id") % 3).cast("int").alias("label"),
        F.col("id").cast("int").alias("total_len"),
        F.when(F.col("id") < 19000, F.timestamp_seconds("id").cast("timestamp_ntz")).alias("ts"),
    )
    got = [r.total_len for r in ops.sample_features(posts, 1000, 42, ["post_id"]).collect()]
    assert len(got) == len(set(got)) == 1000 and max(got) < 19000
    again = [r.total_len for r in ops.sample_features(posts.repartition(3), 1000, 42, ["post_id"]).collect()]
    assert sorted(got) == sorted(again)
    other = [r.total_len for r in ops.sample_features(posts, 1000, 43, ["post_id"]).collect()]
    assert len(set(got) & set(other)) < 200
    assert abs(statistics.mean(got) - 9500) < 600
    assert all(abs(c - 333) < 80 for c in Counter(g % 3 for g in got).values())
    assert ops.sample_features(posts, 50000, 1, ["post_id"]).count() == 19000


def test_sample_of_copies_and_of_nothing(make_posts):
    posts = make_posts(*[("a", "", "2020-01-01 05:00:00", "same", "1")] * 40)
    assert [tuple(r) for r in ops.sample_features(posts, 7).collect()] == [(1, 4, 5)] * 7
    assert ops.sample_features(posts.where("label = 9"), 7).count() == 0


def test_adhoc_sql(make_posts):
    posts = make_posts(("a", "", "", "x", "0"), ("b", "", "", "xyz", "1"))
    got = ops.adhoc_sql(posts, "SELECT id FROM {posts} WHERE total_len > :n AND id <> :evil", n=2, evil="' OR 1=1")
    assert [r.id for r in got.collect()] == ["b"]
    assert ops.adhoc_sql(posts, "SELECT count(*) AS n FROM {posts}").first().n == 2
    with pytest.raises(ValueError):
        ops.adhoc_sql(posts, "DROP VIEW posts")


def test_hits_are_counted_without_a_limit(spark, make_posts):
    posts = make_posts(*[(f"u{i}", "A b", "", "the x" if i % 2 else "", "0") for i in range(700)])
    assert ops.search_count(posts, "The").first().hits == 350 and ops.search_count(posts, "a B").first().hits == 700
    assert "Sort" not in ops.search_count(posts, "the")._jdf.queryExecution().executedPlan().toString()


def test_missing_texts_count_as_empty(spark):
    raw = spark.createDataFrame([(0, "i am", 1), (0, None, 2)], "label int, text string, post_id int")
    assert ops.lexicon_ratio(raw).first().avg_self_ref == 0.25
    assert [len(r.filtered) for r in ops.training_tokens(raw).collect()] == [0, 0] and ops.topic_tokens(raw).count() == 2
    words = spark.createDataFrame([(i % 2, "alpha bravo" if i % 3 else None) for i in range(30)], "label int, text string")
    assert ops.feature_importance(ops.train(words), spark).count() == 4 and ops.topics(words, k=2).count() in (0, 2)


def test_sample_takes_copies_one_by_one(spark):
    """Half of the posts are copies of one: about half of the sample is, whatever the seed, and no text is read."""
    posts = spark.range(2000, numPartitions=8).select(
        F.lit(1).alias("label"),
        F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).cast("int").alias("total_len"),
        F.lit("t").alias("text"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("ts"),
    )
    for seed in range(6):
        copies = [r.total_len for r in ops.sample_features(posts, 200, seed).collect()].count(7)
        assert 60 < copies < 140
    plan = plan_of(ops.sample_features(posts, 200, 1))
    assert "text" not in plan and "rank" in plan and plan.count("Range (") == 1


REFUSED = [
    "FROM {posts} INSERT OVERWRITE DIRECTORY '%s' USING parquet SELECT id",
    "WITH q AS (SELECT id FROM {posts}) INSERT OVERWRITE DIRECTORY '%s' USING parquet SELECT * FROM q",
    "FROM {posts} INSERT INTO t SELECT id",
    "FROM {posts} INSERT INTO t SELECT id INSERT INTO u SELECT id",
    "/* SELECT */ DROP TABLE t",
    "-- a query\nSET spark.sql.ansi.enabled = false",
    "SELECT TRANSFORM(id) USING 'touch %s' AS (b) FROM {posts}",
    "SELECT * FROM {posts} WHERE id IN (WITH q AS (SELECT TRANSFORM(id) USING 'cat' AS (b) FROM {posts}) SELECT b FROM q)",
    "SELECT reflect('java.lang.System', 'getenv', 'HOME')",
    "EXECUTE IMMEDIATE 'DROP TABLE t'",
    "BEGIN SELECT 1; END",
    "CALL system.run()",
    "EXPLAIN SELECT 1",
]


@pytest.mark.parametrize("text", REFUSED)
def test_adhoc_sql_only_reads(make_posts, tmp_path, text):
    posts = make_posts(("a", "t", "", "x", "1"))
    target = tmp_path / "written"
    with pytest.raises(ValueError, match="only queries are run"):
        ops.adhoc_sql(posts, text.replace("%s", str(target)))
    assert not target.exists()


@pytest.mark.parametrize(
    "text",
    ["FROM {posts} SELECT id", "WITH q AS (SELECT id FROM {posts}) SELECT * FROM q", "(SELECT id FROM {posts}) UNION ALL (VALUES ('b'))", "TABLE {posts}",
     "/* DROP */ SELECT 'INSERT INTO t' AS id, transform(array(1), x -> x) AS b FROM {posts}"],
)
def test_adhoc_sql_runs_any_query(make_posts, text):
    assert ops.adhoc_sql(make_posts(("a", "t", "", "x", "1")), text).first()[0] in ("a", "INSERT INTO t")
