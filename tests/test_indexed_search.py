"""Search by trigrams against the plain search, and what it reads."""

import random

import pytest

from postlens import operators as ops
from postlens import sources
from postlens.operators import indexed_search
from postlens.plans import catalog

from .conftest import plan_of

SF = "/root/testdata/sf0.01"


def index_of(spark, posts, tmp_path):
    sources.write_search_index(posts, str(tmp_path / "index"))
    return sources.read_search_index(spark, str(tmp_path / "index"))


def read_rows(df):
    """Rows that the scans of a query gave, after its run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan
    leaves, rows = [plan], 0
    while leaves:
        node = leaves.pop()
        if "Scan" in node.getClass().getSimpleName() and node.metrics().contains("numOutputRows"):
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        leaves += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            leaves.append(node.plan())
    return rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    posts = catalog.posts(spark, SF)
    return posts, index_of(spark, posts, tmp_path_factory.mktemp("search"))


@pytest.mark.parametrize("keyword", ["MYSELF it was", "a?b=1", "the", "e", "", "th", "zzzz", "www.", "été", "und ", "\n", "told myself it was mine"])
@pytest.mark.parametrize("limit", [1, 7, 100000])
def test_same_rows_as_the_plain_search(stored, keyword, limit):
    posts, index = stored
    found = [tuple(r) for r in ops.search_indexed(index, keyword, limit).collect()]
    assert found == [tuple(r) for r in ops.keyword_search(posts, keyword, limit).collect()]
    if limit == 1:
        assert ops.search_count_indexed(index, keyword).first() == ops.search_count(posts, keyword).first()


def test_ties_case_and_odd_characters(spark, make_posts, tmp_path):
    rng = random.Random(2)
    words = ["İstanbul", "straße", "𝔘𝔫𝔦", "a𝔘b", "日本語", "AbC", "abcd", "x\ny", "$^.", "tail"]
    rows = [("same", " ".join(rng.sample(words, 2)), "2023-01-01 00:00:00", " ".join(rng.choices(words, k=4)), str(i % 3)) for i in range(60)]
    rows += [(f"u{i}", "", "", rng.choice(words), "1") for i in range(40)] + [("u1", "ab", "", "c ab", "1")] * 5
    posts = make_posts(*rows).repartition(5)
    index = index_of(spark, posts, tmp_path)
    for keyword in [*words, "abc", "bc", "ABCD", "𝔘𝔫𝔦 ", "ab\nc", "b a"]:
        for limit in (3, 10, 500):
            found = [tuple(r) for r in ops.search_indexed(index, keyword, limit).collect()]
            assert found == [tuple(r) for r in ops.keyword_search(posts, keyword, limit).collect()], keyword


def test_a_rare_word_reads_few_posts(spark, make_posts, tmp_path):
    rng = random.Random(3)
    rows = [(f"u{i:05}", "", "", " ".join(rng.choice(["some", "plain", "words", "here"]) for _ in range(20)), "1") for i in range(6000)]
    rows[4321] = ("u04321", "", "", "one needle here", "1")
    index = index_of(spark, make_posts(*rows).repartition(4), tmp_path)
    df = ops.search_indexed(index, "needle")
    assert [r.id for r in df.collect()] == ["u04321"]
    assert 0 < read_rows(ops.search_indexed(index, "needle")) <= 600
    assert indexed_search.candidate_pages(index, "needle plain") == [] or len(indexed_search.candidate_pages(index, "needle")) == 1
    assert indexed_search.candidate_pages(index, "plain") is None
    assert ops.search_indexed(index, "no such words").count() == 0


def test_texts_stay_below_the_first_exchange(stored):
    _, index = stored
    hits = index.posts.where(indexed_search.matches("the")).select("row", "id", "date").orderBy("row").limit(100)
    top = plan_of(hits).splitlines()
    assert not any("text#" in line for line in top[: next(i for i, x in enumerate(top) if "TakeOrdered" in x) + 1])


def test_empty_table_and_many_pages(spark, stored, make_posts, tmp_path, monkeypatch):
    empty = index_of(spark, make_posts(("a", "b", "", "c", "1")).where("false"), tmp_path / "e")
    assert ops.search_indexed(empty, "abc").count() == 0 and ops.search_count_indexed(empty, "abc").first().hits == 0
    posts, index = stored
    monkeypatch.setattr(indexed_search, "MOST_PAGES", 2)
    assert ops.search_indexed(index, "told myself", 5).collect() == ops.keyword_search(posts, "told myself", 5).collect()


def test_ranges():
    assert indexed_search.ranges([]) == []
    assert indexed_search.ranges([1, 2, 3, 10, 11, 50], 2) == [(1, 11), (50, 50)]
    assert indexed_search.ranges([1, 2, 3, 10, 11, 50], 9) == [(1, 3), (10, 11), (50, 50)]
