"""Every registered query against its SQL twin, and the shape of the plans."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as driver
from postlens.plans.catalog import CATALOG
from postlens.plans.oracle import ORACLE

from .conftest import plan_of

SF = "/root/testdata/sf0.01"
WITHOUT_SQL = {"feature_importance", "top_terms", "topics", "topics_of_label"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    return con


def plain(value):
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else value


def test_twins_are_complete():
    assert set(CATALOG) - set(ORACLE) == WITHOUT_SQL and set(ORACLE) <= set(CATALOG)
    assert CATALOG.items() <= driver.queries().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = CATALOG[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = duck.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)
    assert ours == theirs and ours


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_model_query_runs(spark, name):
    rows = CATALOG[name](spark, SF).collect()
    sizes = {"feature_importance": None, "top_terms": 60, "topics": 5, "topics_of_label": 3}
    assert rows and sizes[name] in (None, len(rows))


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["label", "hour", "count", "percentage"] and df.count() > 0


@pytest.fixture
def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


LAZY = sorted(
    set(ORACLE) - {"truth_labels", "etl_flatten", "csv_roundtrip", "csv_one_file", "search_indexed", "rollup_hourly_profile", "rollup_label_summary", "table_roundtrip", "stream_label_counts", "importance_pairs", "importance_classes",
                   "weights_certificate", "cached_overview"}
)


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_on_the_jvm_and_join_by_key(spark, without_broadcast, name):
    plan = plan_of(CATALOG[name](spark, SF))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["overview", "hourly_profile", "daily_posts", "yoy_month", "label_counts_share"])
def test_no_text_is_read_where_none_is_needed(spark, without_broadcast, name):
    plan = plan_of(CATALOG[name](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint>" in plan and "text:string" not in plan


@pytest.mark.parametrize("name", ["label_length_stats", "length_box", "lexicon_ratio", "top_users"])
def test_texts_are_measured_below_the_shuffle(spark, without_broadcast, name):
    """Above the exchange of the documents side only numbers are left."""
    plan = plan_of(CATALOG[name](spark, SF)).splitlines()
    scan = next(i for i, line in enumerate(plan) if "text:string" in line)
    exchange = max(i for i in range(scan) if "Exchange hashpartitioning" in plan[i])
    assert not any("text#" in line for line in plan[:exchange])
