"""The rollup against the operators on the posts, file by file."""

import pytest
from pyspark.sql import functions as F

from postlens import operators as ops
from postlens import sources
from postlens.operators import rollup as r
from postlens.plans import catalog
from postlens.sources import snapshots

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def posts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("posts") / "table")
    sources.write_table(catalog.posts(spark, SF), path)
    return sources.read_table(spark, path)


def rows_of(df, digits=6):
    return sorted((tuple(round(x, digits) if isinstance(x, float) else x for x in row) for row in df.collect()), key=repr)


def same_answers(rows, posts):
    assert rows_of(ops.rollup_label_summary(rows), 4) == rows_of(ops.label_summary(posts), 4)
    assert rows_of(ops.rollup_hourly_profile(rows)) == rows_of(ops.hourly_profile(posts))
    daily = ops.rollup_daily_posts(rows)
    assert rows_of(daily) == rows_of(ops.daily_posts(posts))
    assert rows_of(ops.year_over_year(daily, "month")) == rows_of(ops.year_over_year(ops.daily_posts(posts), "month"))
    exact, found = ops.overview(posts).first(), ops.rollup_overview(rows).first()
    assert found.total_posts == exact.total_posts
    assert abs(found.unique_users - exact.unique_users) <= 4 * 0.017 * exact.unique_users


def test_files_are_folded_in_once(spark, posts, tmp_path):
    table, path = str(tmp_path / "table"), str(tmp_path / "rollup")
    third = F.col("post_id") % 3
    for i in range(3):
        posts.where(third == i).write.mode("append").partitionBy("label").parquet(table)
        assert ops.update_rollup(spark, table, path) > 0
        assert ops.update_rollup(spark, table, path) == 0
        same_answers(ops.read_rollup(spark, path), posts.where(third <= i))
    assert len(snapshots.versions(spark, path)) == 2 and len(list((tmp_path / "rollup").iterdir())) == 2


def test_estimates_keep_their_error(spark, posts):
    rows = r.merged(r.rollup(posts.where("post_id % 2 = 0")).unionByName(r.rollup(posts.where("post_id % 2 = 1"))))
    found = {x.label: x for x in ops.rollup_length_quartiles(rows).collect()}
    for label, n, users in posts.groupBy("label").agg(F.count("*"), F.count_distinct("id")).collect():
        assert abs(found[label].users - users) <= max(1, 4 * 0.017 * users)
        for share, value in ((0.25, found[label].q1), (0.5, found[label].median), (0.75, found[label].q3)):
            below, upto = posts.where(F.col("label") == label).agg(F.count_if(F.col("total_len") < value), F.count_if(F.col("total_len") <= value)).first()
            assert below / n - 0.03 <= share <= upto / n + 0.03


def test_a_failed_run_is_repeated_without_harm(spark, posts, tmp_path, monkeypatch):
    table, path = str(tmp_path / "table"), str(tmp_path / "rollup")
    posts.where("post_id % 2 = 0").write.partitionBy("label").parquet(table)
    ops.update_rollup(spark, table, path)
    posts.where("post_id % 2 = 1").write.mode("append").partitionBy("label").parquet(table)
    write = snapshots.write_version

    def broken(spark, path, number, tables, keep=2):
        tables["rollup"].write.parquet(f"{path}/v={number}/rollup")
        raise OSError("lost")

    monkeypatch.setattr(r, "write_version", broken)
    with pytest.raises(OSError):
        ops.update_rollup(spark, table, path)
    same_answers(ops.read_rollup(spark, path), posts.where("post_id % 2 = 0"))
    monkeypatch.setattr(r, "write_version", write)
    assert ops.update_rollup(spark, table, path) > 0
    same_answers(ops.read_rollup(spark, path), posts)


def test_changed_and_removed_files_are_errors(spark, posts, tmp_path):
    table, path = tmp_path / "table", str(tmp_path / "rollup")
    posts.where("label = 1").coalesce(1).write.parquet(str(table))
    with pytest.raises(FileNotFoundError):
        ops.read_rollup(spark, path)
    ops.update_rollup(spark, str(table), path)
    next(table.glob("*.parquet")).unlink()
    with pytest.raises(ValueError, match="changed or removed"):
        ops.update_rollup(spark, str(table), path)


def test_lengths_without_spread_and_single_posts(spark, make_posts):
    posts = make_posts(*[(f"u{i}", "", "2023-01-01 10:00:00", "x" * 10**5, "1") for i in range(50)], ("v", "", "", "", "2"))
    rows = r.rollup(posts)
    assert rows_of(ops.rollup_label_summary(rows)) == rows_of(ops.label_summary(posts))
    assert ops.rollup_overview(rows.limit(0)).first() == (0, 0)
