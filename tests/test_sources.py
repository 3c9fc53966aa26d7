import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postlens import operators as ops
from postlens import sources
from postlens.schema import RAW_POSTS
from postlens.session import scratch_path, shared_dir, written

from .conftest import plan_of

TRICKY = [
    ("u1", 'a "quoted", title', "2020-01-01 00:00:00", "line one\nline two\r\nthree", "i", "1"),
    ("u0", "", "", "", "", "0"),
    ("u2", "back\\slash", "x", '"', "i,j", "2"),
    ("u2", "tab\there", "x", '""a""', "\\", "n/a"),
    ("u3", "end\\", "x", "été   \U0001f600", "i", "0"),
]


def test_csv_round_trip(spark):
    path = scratch_path(spark, "csv")
    sources.write_csv(spark.createDataFrame(TRICKY, RAW_POSTS), path)
    back = sources.read_posts(spark, path, trim=False)
    assert back.schema == RAW_POSTS
    got = [tuple(v or "" for v in r) for r in back.collect()]
    assert Counter(got) == Counter(TRICKY)
    assert [g[0] for g in got] == ["u0", "u1", "u2", "u2", "u3"]


def test_csv_round_trip_of_random_text(spark):
    rng = random.Random(3)
    alphabet = '",\\\n\r\t ;\'aé\u2028\U0001f600#'

    def text():
        return "".join(rng.choices(alphabet, k=rng.randrange(7)))

    rows = [(f"u{i}", text(), text(), text(), text(), "1") for i in range(3000)]
    path = scratch_path(spark, "csv")
    sources.write_csv(spark.createDataFrame(rows, RAW_POSTS), path)
    got = {tuple(v or "" for v in r) for r in sources.read_posts(spark, path, trim=False).collect()}
    assert got == set(rows)


def test_csv_dialect_and_trimming(spark, tmp_path):
    text = 'id,title,date,text,info,label\n"a","x ""y""","d","l1\nl2, l2"," i "," 1 "\n b , t ,,w,,0\n'
    (tmp_path / "p.csv").write_text(text)
    trimmed = sources.read_posts(spark, str(tmp_path)).collect()
    assert tuple(trimmed[0]) == ("a", 'x "y"', "d", "l1\nl2, l2", " i ", " 1 ")
    assert (trimmed[1].id, trimmed[1].title) == ("b", "t")
    raw = sources.read_posts(spark, str(tmp_path), trim=False).collect()
    assert (raw[1].id, raw[1].title) == (" b ", " t ")
    posts = ops.clean_posts(sources.read_posts(spark, str(tmp_path)))
    assert [(r.label, r.date) for r in posts.orderBy("id").collect()] == [(1, "d"), (0, "")]


def test_csv_spreads_one_hot_id(spark):
    """A third of the rows, all alike, belong to one user: no file holds them all."""
    n = 30000
    posts = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("id"),
        *[F.lit("same").alias(c) for c in ("title", "date", "text", "info", "label")],
    )
    path = scratch_path(spark, "csv")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sources.write_csv(posts, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sources.read_posts(spark, path).groupBy(F.input_file_name(), F.col("id") == "hot").count().collect()
    hot = [r["count"] for r in files if r[1]]
    assert sum(r["count"] for r in files) == n and sum(hot) == n // 3
    assert max(hot) < n // 5


def test_table_prunes(spark, make_posts):
    path = scratch_path(spark, "table")
    sources.write_table(make_posts(("a", "t", "2020-01-01 00:00:00", "x", "1"), ("b", "t", "", "xy", "2")), path)
    table = sources.read_table(spark, path)
    assert {(r.label, r.total_len) for r in table.collect()} == {(1, 2), (2, 3)}
    plan = plan_of(ops.label_length_stats(ops.of_label(table, 1)))
    assert "ReadSchema: struct<total_len:int>" in plan
    assert "PartitionFilters: [isnotnull(label" in plan
    plan = plan_of(ops.hourly_profile(table))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan and "PushedFilters: [IsNotNull(ts)]" in plan


DOC = """<?xml version="1.0" encoding="UTF-8"?>
<{root}>
<ID> {id} </ID>
<WRITING><TITLE> See WWW.x.org NOW </TITLE><DATE> 2020-01-01 00:00:00 </DATE><INFO> forum </INFO>
<TEXT>  Tom &amp; I\nat http://a.b/c?d=e end </TEXT></WRITING>
<WRITING><TITLE></TITLE><TEXT>Second</TEXT></WRITING>
</{root}>"""


@pytest.fixture
def corpus_dir(tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "one.xml").write_text(DOC.format(root="INDIVIDUAL", id="u1"))
    (tmp_path / "deep" / "er" / "two.xml").write_text(DOC.format(root="OTHER", id="u1"))
    (tmp_path / "single.xml").write_text("<A><ID>u2</ID><WRITING><TEXT>Only</TEXT></WRITING></A>")
    (tmp_path / "none.xml").write_text("<A><ID>u2</ID></A>")
    (tmp_path / "unknown.xml").write_text(DOC.format(root="A", id="u9"))
    (tmp_path / "badlabel.xml").write_text(DOC.format(root="A", id="u3"))
    (tmp_path / "broken.xml").write_text("<A><ID>u2</ID><WRITING><TEXT>Half</TEXT></WRITING><WRITING>")
    (tmp_path / "noid.xml").write_text("<A><WRITING><TEXT>Half</TEXT></WRITING></A>")
    (tmp_path / "skipped.txt").write_text(DOC.format(root="A", id="u1"))
    return str(tmp_path)


def test_corpus(spark, corpus_dir, tmp_path_factory):
    truth = tmp_path_factory.mktemp("truth") / "t.txt"
    truth.write_text("u1 1\nu2 0 extra\nshort\n\nu3 x\n")
    parts = [(corpus_dir, str(truth), "depression"), (corpus_dir, str(truth), "anorexia")]
    got = Counter(tuple(r) for r in sources.build_corpus(spark, parts).collect())
    first = ("u1", "see  now", "2020-01-01 00:00:00", "tom & i\nat  end", "forum")
    second = ("u1", "", "", "second", "")
    only = ("u2", "", "", "only", "")
    assert got == Counter(
        {(*first, 1): 2, (*second, 1): 2, (*only, 0): 2, (*first, 2): 2, (*second, 2): 2} 
    )


def test_corpus_of_packed_files(spark, tmp_path, tmp_path_factory):
    one = "<U><ID>u{}</ID><WRITING><TEXT>A</TEXT></WRITING><WRITING><TEXT>B</TEXT></WRITING></U>"
    (tmp_path / "many.xml").write_text("<C>" + "".join(one.format(i) for i in range(50)) + "</C>")
    docs = sources.read_documents(spark, str(tmp_path), row_tag="U")
    truth = spark.createDataFrame([(f"u{i}", "1") for i in range(0, 50, 2)], "id string, raw_label string")
    posts = sources.flatten_documents(docs, truth, "anorexia")
    assert posts.count() == 50 and {r.label for r in posts.collect()} == {2}


def test_packed_files_split_and_lose_one_document(spark, tmp_path):
    one = "<U a='1'>\n<ID>u{}</ID><WRITING><TITLE>first</TITLE><TITLE>later</TITLE><TEXT>é {}</TEXT></WRITING></U>\n"
    docs = [one.format(i, "x" * 200) for i in range(2000)]
    docs[7] = "<U><ID>u7</ID><WRITING><TEXT>half</WRITING></U>"
    docs[9] = "<U><ID>u9</ID><WRITING><TEXT>never closed"
    docs[11] = "<U><ID>u11</ID><WRITING><TEXT>a &lt; b<b>mark</b>tail</TEXT></WRITING></U>"
    (tmp_path / "many.xml").write_text("<?xml version='1.0' encoding='utf-8'?><C>" + "".join(docs) + "</C>")
    (tmp_path / "empty.xml").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        read = sources.read_documents(spark, str(tmp_path), row_tag="U")
        assert read.rdd.getNumPartitions() > 3
        got = {r.ID: r.WRITING[0] for r in read.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert set(got) == {f"u{i}" for i in range(2000)} - {"u7", "u9"}
    assert got["u8"].TITLE == "first" and got["u8"].TEXT.startswith("é x") and got["u11"].TEXT == "a < b"


def test_xml_encodings(spark, tmp_path):
    text = "<?xml version='1.0' encoding='{}'?><A><ID>u</ID><WRITING><TEXT>été</TEXT></WRITING></A>"
    for name in ("ISO-8859-1", "utf-8", "utf-16"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.xml").write_bytes(text.format(name).encode(name))
        assert [r.WRITING[0].TEXT for r in sources.read_documents(spark, str(tmp_path / name)).collect()] == ["été"]
    with pytest.raises(Exception, match="not supported"):
        sources.read_documents(spark, str(tmp_path / "ISO-8859-1"), row_tag="A").collect()


def test_table_files_do_not_grow_with_tasks(spark, tmp_path):
    posts = spark.range(4000, numPartitions=40).selectExpr(
        "CAST(id % 3 AS INT) AS label", "CAST('2020-01-01' AS TIMESTAMP_NTZ) + make_interval(0,0,0,0,0,0,(id * 37) % 4000) AS ts", "id"
    )
    sources.write_table(posts, str(tmp_path / "t"))
    files = list((tmp_path / "t").glob("label=*/*.parquet"))
    assert len(files) <= 6 and sources.read_table(spark, str(tmp_path / "t")).count() == 4000
    for file in files:
        times = [r.ts for r in spark.read.parquet(str(file)).collect()]
        assert times == sorted(times)


def test_truth_last_line_wins_over_file_splits(spark, tmp_path):
    """Many ids, each several times, in a file that is read in several splits."""
    lines = [f"u{i % 97}\t {i}" for i in range(20000)] + ["short", "", "  u5   last  more "]
    (tmp_path / "t.txt").write_text("\r\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        truth = sources.read_truth(spark, str(tmp_path / "t.txt"))
        assert spark.read.text(str(tmp_path / "t.txt")).rdd.getNumPartitions() > 4
        got = {r.id: r.raw_label for r in truth.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = {}
    for line in lines:
        parts = line.split()
        if len(parts) >= 2:
            wanted[parts[0]] = parts[1]
    assert got == wanted


def test_missing_truth_is_empty(spark, tmp_path):
    truth = sources.read_truth(spark, str(tmp_path / "none.txt"))
    assert truth.columns == ["id", "raw_label"] and truth.count() == 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    with written(spark.range(5).toDF("a"), "cut") as cut:
        folder = os.path.dirname(cut.inputFiles()[0].removeprefix("file://"))
        assert cut.count() == 5 and folder.startswith(shared_dir(spark)) and os.path.isdir(folder)
        assert "Range" not in plan_of(cut)
    assert not os.path.exists(folder)


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('label,id,title,date,text,info,extra\n1,u1,t,d,x,i,z\n')
    assert [tuple(r) for r in sources.read_posts(spark, str(tmp_path)).collect()] == [("u1", "t", "d", "x", "i", "1")]
    other = tmp_path / "short"
    other.mkdir()
    (other / "a.csv").write_text("label,id,title,date,text\n1,u1,t,d,x\n")
    with pytest.raises(ValueError, match="info"):
        sources.read_posts(spark, str(other))
