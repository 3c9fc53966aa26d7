"""Near-duplicate classes, repeated lines and the pipeline: against brute force."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postlens.llm import components, decontam, linededup, neardup
from postlens.llm.queries import QUERIES

from ..conftest import plan_of
from .test_words_search import split

SF = "/root/testdata/sf0.001"


def kmers(text):
    words, seen, out = split(text), collections.Counter(), []
    if not words:
        return []
    for run in [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))]:
        out.append((run, seen[run]))
        seen[run] += 1
    return out


def in_common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def similarity(a, b):
    """Longest common subsequence over all that is in both."""
    found = in_common(a, b)
    return found / max(1, len(a) + len(b) - found)


def alike(one, two):
    """Whether the words of two texts align to 0.8 and their labelled runs to 0.45, by whole tables without a band or anchors."""
    a, b = split(one), split(two)
    if a == b:
        return bool(a)
    bags = sum((collections.Counter(a) & collections.Counter(b)).values())
    if min(len(a), len(b)) < 5 or bags < 0.8 * (len(a) + len(b) - bags):
        return False
    return similarity(a, b) >= 0.8 and similarity(kmers(one), kmers(two)) >= 0.45


def naive_classes(rows):
    texts = [t or "" for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if root(i) != root(j) and alike(texts[i], texts[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    return {frozenset(g) for g in groups.values()}


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for n in (3, 8, 60, 120, 400):
        for _ in range(3):
            base = rng.choices(words, k=n)
            texts.append(" ".join(base))
            for edits in (0, 1, 1, 2, n // 25, n // 8, n // 3):
                copy = list(base)
                for _ in range(edits):
                    at = rng.randrange(len(copy))
                    copy[at : at + 1] = rng.choice([[], [rng.choice(words)], [copy[at], rng.choice(words)]])
                texts.append(", ".join(copy).upper())
    moved = rng.choices(words, k=200)
    passage = " ".join(rng.choices(words, k=60))
    texts += [" ".join(moved), " ".join(moved[100:] + moved[:100]), "same " * 80, "same " * 81, "same " * 300]
    texts += [passage + " " + " ".join(rng.choices(words, k=60)) for _ in range(12)]
    rows = [*enumerate(texts), *[(1000 + i, t) for i, t in enumerate(["", None, "!!", "", None])]]
    rng.shuffle(rows)
    return rows


def found_classes(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.class_id].append(r.doc_id)
    assert all(min(g) == c for c, g in groups.items())
    return {frozenset(g) for g in groups.values()}


def test_classes_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string").repartition(6)
    assert found_classes(neardup.classes(df).collect()) == naive_classes(rows)


def test_alignment_equals_dynamic_programming():
    rng = np.random.default_rng(2)
    met = 0
    for _ in range(400):
        a = rng.integers(0, rng.choice([4, 30, 1000]), rng.integers(5, 60)).tolist()
        b = list(a)
        for _ in range(rng.integers(0, 8)):
            at = int(rng.integers(0, len(b) + 1))
            b[at : at + int(rng.integers(0, 2))] = rng.integers(0, 1000, rng.integers(0, 2)).tolist()
        if rng.random() < 0.1:
            b = b[len(b) // 2 :] + b[: len(b) // 2]
        texts = [" ".join(f"w{x}" for x in t) for t in (a, b)]
        value = similarity(a, b)
        sure = len(a) >= 5 and len(b) >= 5 and value >= 0.8 and similarity(kmers(texts[0]), kmers(texts[1])) >= 0.45
        found = neardup.aligned(*[neardup.Aligned(np.array(t, np.uint32)) for t in (a, b)])
        assert found == pytest.approx(value if sure else 0) or (len(set(a)) < 10 and found <= value)
        met += found > 0
    assert 100 < met < 350


def test_common_words_equal_dynamic_programming():
    rng = random.Random(4)
    for _ in range(200):
        a, b = (rng.choices(range(rng.choice([2, 9])), k=rng.randrange(80)) for _ in range(2))
        assert neardup.common_words(a, b) == in_common(a, b)


def test_scattered_edits_are_found(spark):
    """Copies with one word in twenty-five changed, added or taken out, and texts that share half of their words in runs."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for n in range(60):
        base = rng.choices(words, k=200)
        copy = list(base)
        for at in sorted(rng.sample(range(200), 8), reverse=True):
            copy[at : at + 1] = rng.choice([[], [rng.choice(words)], [copy[at], rng.choice(words)]])
        rows += [(3 * n, " ".join(base)), (3 * n + 1, " ".join(copy)), (3 * n + 2, " ".join(base[:100] + rng.choices(words, k=100)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_classes(neardup.classes(df).collect()) == {frozenset(c) for n in range(60) for c in ({3 * n, 3 * n + 1}, {3 * n + 2})}


def test_recall_on_the_test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert found_classes(neardup.classes(docs).collect()) == naive_classes([tuple(r) for r in docs.collect()])


def test_one_row_of_each_class_stays(spark):
    rows = corpus()
    extra = [(5, "one two three four five six seven"), (5, "one two three four five six seven"), (5, "ONE two three four five six seven"), (5, "quite other words are in this text"), (None, "quite other words are in this text"), (None, None), (None, None)]
    df = spark.createDataFrame([*[(i + 10, t) for i, t in rows], *extra], "doc_id long, text string")
    kept = neardup.without_copies(df).collect()
    classes = naive_classes([(n, t) for n, (_, t) in enumerate([*rows, *extra[:5]])])
    assert len(kept) == len(classes) + 1  # and one of the rows without a text
    assert collections.Counter(r.doc_id for r in kept)[5] == 2 and df.columns == list(kept[0].asDict())
    assert neardup.classes(df.limit(0)).count() == 0 and neardup.without_copies(df.limit(0)).count() == 0


def all_pairs(texts):
    """Classes by comparing every pair of texts."""
    numbers = collections.defaultdict(itertools.count().__next__)
    sequences = [neardup.Aligned(np.array([numbers[w] for w in split(t)], np.uint32)) for t in texts]
    bags = [collections.Counter(split(t)) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if root(i) != root(j) and (bags[i] & bags[j]).total() * 9 >= 4 * (bags[i].total() + bags[j].total()) and neardup.aligned(sequences[i], sequences[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = collections.defaultdict(list)
    for i in range(len(texts)):
        groups[root(i)].append(i)
    return {frozenset(g) for g in groups.values()}


def families(template=500, chain=300):
    """Texts of one template that are not alike but for some pairs, and a chain of copies that drift from one to the next."""
    rng = random.Random(11)
    fresh = (f"x{i}" for i in itertools.count())
    common = [f"t{i}" for i in range(124)]
    texts = []
    for n in range(template):
        own = [next(fresh) for _ in range(20)]
        texts.append(common + own)
        if n % 10 == 0:
            texts.append(common + own[:6] + [next(fresh) for _ in range(14)])
    copy = [next(fresh) for _ in range(100)]
    for _ in range(chain):
        copy = list(copy)
        copy[rng.randrange(100)] = next(fresh)
        texts.append(copy)
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [1 << 17, 2000])
def test_classes_of_template_families_and_drifting_chains(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_KMERS", block)
    texts = families()
    want = all_pairs(texts)
    assert sum(len(c) == 2 for c in want) > 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    assert found_classes(neardup.classes(df).collect()) == want


def test_rows_met_by_sketch_grow_with_the_family(spark, monkeypatch):
    """Texts meet the first of their sketches in one join, and the sketches not settled by that in another."""
    plain, met, joins = neardup.kept, [], []

    def watched(df, name):
        joins[-1] += len(re.findall(r"Join Inner, .*sketch#\d+L = sketch#\d+L", df._jdf.queryExecution().optimizedPlan().toString()))
        made = plain(df, name)
        if name == "met":
            met.append(made.count())
        return made

    monkeypatch.setattr(neardup, "kept", watched)
    for size in (60, 120, 240):
        joins.append(0)
        texts = families(size, 0)
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert found_classes(neardup.classes(df).collect()) == all_pairs(texts)
        assert 0 < met[-1] <= neardup.SKETCHES * len(texts)
    assert joins == [2, 2, 2]
    assert met[1] <= 2.5 * met[0] and met[2] <= 2.5 * met[1]


def test_equal_texts_without_words_are_copies(spark):
    rows = [(1, "-----"), (2, "-----"), (3, "!!!"), (4, "----- "), (5, "!!!"), (None, "!!!"), (6, ""), (7, ""), (8, None), (9, None), (10, "some words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in neardup.classes(df).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 3, None: 3, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10}
    assert {r.doc_id for r in neardup.without_copies(df).collect()} == {1, 3, 4, 6, 7, 8, 9, 10}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(50, 51)]
    random.Random(1).shuffle(chain)
    found = {r.hi: r.lo for r in components.components(spark.createDataFrame(chain, "lo long, hi long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}, 51: 50}


def naive_lines(rows, least):
    """Delete every run of lines that begins earlier somewhere else and has enough words; all runs are tried."""
    texts, out = {}, {}
    order = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    seqs = [(key, [(n, line.strip(" \t\r")) for n, line in enumerate(key[2].split("\n")) if line.split()]) for key in order]
    seen = set()
    for key, lines in seqs:
        gone, numbers = set(), [n for n, _ in lines]
        for a in range(len(lines)):
            run = ()
            new = []
            for z in range(a, len(lines)):
                run += (lines[z][1],)
                if sum(len(x.split()) for x in run) >= least and run in seen:
                    gone |= set(numbers[a : z + 1])
                new.append(run)
            seen.update(new)
        for a, z in zip(numbers, numbers[1:]):
            if a in gone and z in gone:
                gone |= set(range(a, z))
        texts[key] = "\n".join(x for n, x in enumerate(key[2].split("\n")) if n not in gone)
    for i, t in rows:
        out.setdefault((i, t), None if t is None else texts[i is None, i or 0, t])
    return out


@pytest.mark.parametrize("least", [1, 3, 7])
def test_repeated_lines_equal_brute_force(spark, least):
    rng = random.Random(least)
    lines = ["a b c", "d", "e f", "", "g h i j k", " d ", "l", "m n", "x y z w"]
    rows = [(i, "\n".join(rng.choices([*lines, f"own {i}"], k=rng.randint(0, 14)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, rows[3][1]), (None, rows[4][1]), (3, rows[3][1]), (73, "l\n" * 40), (3, "other\na b c\nd")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_lines int")
    out = linededup.without_repeated_lines(df, least).collect()
    want = naive_lines(rows, least)
    assert sorted(((r.doc_id, r.text) for r in out), key=repr) == sorted(((i, want[i, t]) for i, t in rows), key=repr)
    assert linededup.without_repeated_lines(df.limit(0), least).count() == 0


def test_line_dedup_query_is_native_and_right(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    query = QUERIES["op3_line_dedup"](spark, SF)
    want = naive_lines(docs, 50)
    assert {r.doc_id: r.text for r in query.collect()} == {i: want[i, t] for i, t in docs}
    assert "Python" not in plan_of(query) and "Arrow" not in plan_of(query)


def test_pipeline_against_brute_force(spark):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = {}
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    junk = spark.createDataFrame([(-1, None, None, None, None), (-2, "12 34", "en", "src0", 5)], df.schema)
    df = df.unionByName(junk)
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF).cache()
        stages[name] = df.collect()
    assert {r.doc_id for r in stages["language"]} == {r.doc_id for r in docs}
    classes = naive_classes([(r.doc_id, r.text) for r in docs])
    assert {r.doc_id for r in stages["near duplicates"]} == {min(c) for c in classes}
    text = {r.doc_id: r.text for r in docs}
    from .test_words_search import naive_hits

    hits = naive_hits([(r.doc_id, r.text) for r in stages["near duplicates"]], items, 13)
    clean = {d for d, n, hit, _ in hits if not (hit and 20 * hit >= n)}
    assert {r.doc_id for r in stages["decontamination"]} == clean and len(clean) < len(hits)
    copies = collections.Counter(r.doc_id for r in stages["mixing"])
    assert set(copies) <= clean and max(copies.values()) <= 2 and all(r.text == text[r.doc_id] for r in stages["mixing"])
    last = stages["sharding"]
    assert collections.Counter(r.doc_id for r in last) == copies
    sizes = collections.Counter(r.shard for r in last)
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 1
    assert [c for c in df.columns if c not in ("shard", "slot")] == ["doc_id", "text", "lang", "source", "n_chars"]
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == df.columns and run.agg(F.count("*")).first()[0] > 0
    assert decontam.SHARD_BYTES > 0 and corpus_pipeline.ORACLE_SQL is None


def test_only_tables_that_the_result_reads_stay(spark):
    from pathlib import Path

    from postlens.llm.components import kept, tidy
    from postlens.session import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))

    def here():
        return {p.name.rsplit("-", 1)[0] for p in folder.iterdir()}

    @tidy
    def inner(df):
        return kept(kept(df, "tidy-a").where("id > 1"), "tidy-b")

    @tidy
    def outer(df):
        part = inner(df)
        assert "tidy-b" in here() and "tidy-a" not in here()
        return kept(part, "tidy-c").union(part) if df.count() > 3 else kept(part, "tidy-d")

    result = outer(spark.range(5))
    assert result.count() == 6 and {"tidy-b", "tidy-c"} <= here()
    assert outer(spark.range(3)).count() == 1

    @tidy
    def broken(df):
        kept(df, "tidy-e")
        raise ValueError

    with pytest.raises(ValueError):
        broken(spark.range(3))
    assert "tidy-e" not in here()
    before = len(list(folder.iterdir()))
    neardup.classes(spark.createDataFrame([(i, "a b c d e f g " * 3) for i in range(9)], "doc_id long, text string")).collect()
    assert len(list(folder.iterdir())) - before <= 3
