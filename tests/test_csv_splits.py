"""CSV files read by splits against the reader that reads a file in one task."""

import collections
import csv
import os
import random

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from postlens import sources
from postlens.plans.catalog import CATALOG
from postlens.schema import RAW_POSTS
from postlens.sources import csv_splits

HEADER = ["id", "title", "date", "text", "info", "label"]
PIECES = ["a", "word ", "\n", "\n\n", '"', '""', ",", '",', '\n"', '"\n', "é日", "'", "\\", " ", "x" * 80, '\n","\n']


@pytest.fixture
def split_bytes(spark):
    def put(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield put
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def written(path, rows, quoting=csv.QUOTE_MINIMAL, end="\n", header=HEADER):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, quoting=quoting, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


def random_rows(seed, n, most=12):
    rng = random.Random(seed)
    return [[f"u{i}"] + ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, most))) for _ in range(4)] + [str(i % 3)] for i in range(n)]


@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
@pytest.mark.parametrize("trim", [True, False])
def test_any_split_gives_the_same_rows(spark, tmp_path, split_bytes, quoting, trim):
    written(tmp_path / "p.csv", random_rows(1, 80), quoting)
    expected = rows_of(sources.read_posts(spark, str(tmp_path), trim))
    assert sum(expected.values()) == 80
    for size in (311, 1000, 1 << 20):
        split_bytes(size)
        df = sources.read_posts_in_splits(spark, str(tmp_path), trim)
        assert rows_of(df) == expected
        assert size > 1000 or df.rdd.getNumPartitions() > 8


def test_records_longer_than_splits_and_batches(spark, tmp_path, split_bytes):
    rows = [["u0", "t", "d", "line\n" * 3000, "i", "1"], ["u1", "t", "d", 'a "b"\n\n' * 500, "i", "1"], ["u2", "t", "d", "x", "i", "1"]]
    written(tmp_path / "p.csv", rows)
    expected = rows_of(sources.read_posts(spark, str(tmp_path)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for size in (900, 1 << 20):
            split_bytes(size)
            assert rows_of(sources.read_posts_in_splits(spark, str(tmp_path))) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_many_files_blank_lines_and_line_ends(spark, tmp_path, split_bytes):
    split_bytes(400)
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(5):
        written(folder / f"{i}.csv", random_rows(i, 20, 3))
    (folder / "blank.csv").write_text(",".join(HEADER) + '\n\nu,"a\n\nb",,,,1\n\n\nv,,,"",,2')
    (folder / "only.csv").write_text(",".join(HEADER) + "\n")
    (folder / "none.csv").write_text("")
    assert rows_of(sources.read_posts_in_splits(spark, str(folder))) == rows_of(sources.read_posts(spark, str(folder)))
    crlf = tmp_path / "crlf"
    crlf.mkdir()
    written(crlf / "p.csv", [[f"u{i}", "t", "d", 'two\r\nlines, "quoted"', "i", "1"] for i in range(30)], end="\r\n")
    assert rows_of(sources.read_posts_in_splits(spark, str(crlf))) == rows_of(sources.read_posts(spark, str(crlf)))


def test_columns_by_name_and_headers_alike(spark, tmp_path, split_bytes):
    split_bytes(100)
    mixed = ["label", "extra", "id", "title", "date", "text", "info"]
    rows = [[str(i % 3), "e", f"u{i}", "t", "d", "a\nb", "i"] for i in range(30)]
    written(tmp_path / "a.csv", rows, header=mixed)
    assert rows_of(sources.read_posts_in_splits(spark, str(tmp_path))) == rows_of(sources.read_posts(spark, str(tmp_path)))
    written(tmp_path / "b.csv", rows, header=mixed[::-1])
    with pytest.raises(ValueError, match="different headers"):
        sources.read_posts_in_splits(spark, str(tmp_path))
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "a.csv").write_text("id,title\nu,t\n")
    with pytest.raises(ValueError, match="columns missing"):
        sources.read_posts_in_splits(spark, str(bad))


def test_header_across_splits(spark, tmp_path, split_bytes):
    wide = HEADER + ["much\nmore " * 40]
    written(tmp_path / "a.csv", [[f"u{i}", "t", "d", "x", "i", "1", "z"] for i in range(9)], header=wide)
    expected = rows_of(sources.read_posts(spark, str(tmp_path)))
    split_bytes(99)
    assert rows_of(sources.read_posts_in_splits(spark, str(tmp_path))) == expected and sum(expected.values()) == 9


def test_stray_quotes_and_long_records_are_errors(spark, tmp_path, split_bytes):
    split_bytes(300)
    (tmp_path / "a.csv").write_text(",".join(HEADER) + '\nu,5" by 6",d,x,i,1\n')
    with pytest.raises(Exception, match="a quote inside an unquoted field"):
        sources.read_posts_in_splits(spark, str(tmp_path)).collect()
    long = tmp_path / "long"
    long.mkdir()
    written(long / "a.csv", [["u", "t", "d", "line\n" * 1000, "i", "1"]])
    with pytest.raises(Exception, match="a record is too long"):
        sources.read_posts_in_splits(spark, str(long), most_record=100).collect()


def test_splits_that_change_between_passes_are_noticed(spark, tmp_path, split_bytes):
    written(tmp_path / "p.csv", random_rows(3, 100))
    split_bytes(500)
    df = sources.read_posts_in_splits(spark, str(tmp_path))
    split_bytes(333)
    with pytest.raises(Exception, match="have changed between two passes"):
        df.collect()


def test_no_text_of_whole_records_is_shuffled(spark, tmp_path, split_bytes):
    """Between the splits go only the pieces at their ends."""
    written(tmp_path / "p.csv", random_rows(3, 100))
    lines = csv_splits.lines_of(spark, str(tmp_path))
    assert "Exchange" not in csv_splits.inner_records(lines, {})._jdf.queryExecution().executedPlan().toString()


def test_one_file_is_written_by_many_tasks(spark, tmp_path):
    """Pieces of all partitions, empty ones too, stand behind one header in one file; so that file is the work of as many tasks."""
    rows = [(f"u{i}", 'a "t"\n, ', "", "x\n" * (i % 5), None, str(i % 3)) for i in range(300)]
    for n, given in enumerate((rows, [])):
        path = f"{tmp_path}/one {n}"
        sources.write_one_csv(spark.createDataFrame(given, RAW_POSTS).repartition(7), path)
        (file,) = [f for f in os.listdir(path) if f.endswith(".csv")]
        assert open(f"{path}/{file}", newline="").read().startswith("id,title,date,text,info,label\n")
        for read in (sources.read_posts, sources.read_posts_in_splits):
            got = [tuple(v or "" for v in r) for r in read(spark, path, trim=False).collect()]
            assert sorted(got) == sorted(tuple(v or "" for v in r) for r in given)


def test_the_one_file_query_gathers_nothing_in_one_task(spark, monkeypatch):
    """No plan of the export brings all rows together."""
    seen = []
    monkeypatch.setattr(DataFrame, "coalesce", lambda df, n: seen.append(n) or df)
    CATALOG["csv_one_file"](spark, "/root/testdata/sf0.001")
    assert seen == []
