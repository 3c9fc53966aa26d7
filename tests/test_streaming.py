import shutil

import pytest

from postlens import operators as ops
from postlens import sources, streaming
from postlens.streaming import counts

HEADER = "id,title,date,text,info,label\n"
ONCE = {"availableNow": True}


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    src, state = tmp_path / "in", str(tmp_path / "state")
    src.mkdir()
    (src / "a.csv").write_text(HEADER + '"u","t","d","two\nlines, ""q""","i","1"\n"u","t","d","x","i","0"\n')
    (src / "b.csv").write_text(HEADER + '"u","t","d","x","i"," 1 "\n"u","t","d","x","i","n/a"\n')
    (src / "c.csv").write_text(HEADER + '"u","t","d","x","i",""\n"u","t","d","x","i","2"\n')

    def run():
        query = streaming.stream_label_counts(spark, str(src), "seen", state, ONCE)
        query.awaitTermination()
        batch = ops.label_counts(ops.clean_posts(sources.read_posts(spark, str(src))))
        got = {tuple(r) for r in streaming.read_counts(spark, "seen").collect()}
        assert got == {tuple(r) for r in batch.collect()}
        return got, [p for p in query.recentProgress if p["numInputRows"] > 0]

    counts, progress = run()
    assert counts == {(0, 1), (1, 2), (2, 1)} and len(progress) == 3
    shutil.copy(src / "a.csv", src / "d.csv")
    counts, progress = run()
    assert counts == {(0, 2), (1, 3), (2, 1)} and len(progress) == 1


def test_larger_batches(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.csv").write_text(HEADER + '"u","t","d","x","i","1"\n')
    query = streaming.stream_label_counts(spark, str(tmp_path), "larger", trigger=ONCE, max_files=3)
    query.awaitTermination()
    assert [tuple(r) for r in streaming.read_counts(spark, "larger").collect()] == [(1, 6)]
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 2


def test_counts_before_the_stream_starts(spark):
    assert streaming.read_counts(spark, "never_started").collect() == []


def test_few_state_partitions(spark, tmp_path):
    src, state = tmp_path / "in", tmp_path / "state"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + '"u","t","d","x","i","1"\n')
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = streaming.stream_label_counts(spark, str(src), "few", str(state), ONCE, state_partitions=2)
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    stores = [p.name for p in (state / "state" / "0").iterdir() if p.name.isdigit()]
    assert sorted(stores) == ["0", "1"]


def test_saved_counts_survive_a_fault_in_every_place(spark, tmp_path, monkeypatch):
    """A query that dies before, in the middle of or after a version goes on with equal counts, in bounded space."""
    src, out, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")
    src.mkdir()
    for i in range(8):
        (src / f"{i}.csv").write_text(HEADER + f'"u","t","d","x","i","{i % 3}"\n' * 2)
    write = counts.write_version
    faults = []

    def broken(spark, path, number, tables, keep=2):
        if (number, len(faults)) in ((1, 0), (4, 2)):
            faults.append(number)
            raise OSError("before")
        if (number, len(faults)) == (2, 1):
            tables["counts"].write.mode("overwrite").parquet(f"{path}/v={number}/counts")
            faults.append(number)
            raise OSError("before the marker")
        write(spark, path, number, tables, keep)
        if (number, len(faults)) == (5, 3):
            faults.append(number)
            raise OSError("after the marker")

    monkeypatch.setattr(counts, "write_version", broken)
    for run in range(5):
        query = streaming.save_label_counts(spark, str(src), str(out), state, ONCE)
        if run < 4:
            with pytest.raises(Exception, match="before|after"):
                query.awaitTermination()
            seen = sum(r["count"] for r in streaming.read_saved(spark, str(out)).collect())
            whole = faults[-1] + (run == 3)  # micro-batches that are committed
            assert seen == 2 * whole
        else:
            query.awaitTermination()
    assert faults == [1, 2, 4, 5]
    expected = ops.label_counts(ops.clean_posts(sources.read_posts(spark, str(src))))
    assert {tuple(r) for r in streaming.read_saved(spark, str(out)).collect()} == {tuple(r) for r in expected.collect()}
    assert len([p for p in out.iterdir() if p.is_dir()]) <= 3


def test_only_changed_labels_are_handed_on(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    src.mkdir()
    assert streaming.read_saved(spark, out).collect() == []
    for name, label in (("a", 0), ("b", 1), ("c", 1)):
        (src / f"{name}.csv").write_text(HEADER + f'"u","t","d","x","i","{label}"\n')
    query = streaming.save_label_counts(spark, str(src), out, state, ONCE)
    query.awaitTermination()
    assert {tuple(r) for r in streaming.read_saved(spark, out).collect()} == {(0, 1), (1, 2)}
    assert [p["sink"]["numOutputRows"] for p in query.recentProgress if p["numInputRows"]] in ([1, 1, 1], [-1, -1, -1])
