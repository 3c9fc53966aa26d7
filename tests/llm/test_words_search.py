"""Words, the FM-index and decontamination, top-k search: against plain Python."""

import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlens.llm import decontam, topk
from postlens.llm.queries import ORACLE, QUERIES
from postlens.llm.words import Words, pieces, runs

SF = "/root/testdata/sf0.001"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9 .\n-é日ß", max_size=12)), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    words = Words(pa.array(texts, pa.string()))
    plain = [split(t) for t in texts]
    assert words.count.tolist() == [len(p) for p in plain]
    data = bytes(words.data)
    assert [data[a:z].decode() for a, z in zip(words.begin, words.end)] == [w for p in plain for w in p]
    flat = [w for p in plain for w in p]
    hashes = words.hash.tolist()
    assert len(set(hashes)) == len(set(flat)) and len(set(zip(flat, hashes))) == len(set(flat))


def test_runs_depend_on_order_and_pieces_keep_rows():
    assert len(set(runs(np.array([1, 2, 3, 1, 2, 2, 1], np.uint64), 2).tolist())) == 5
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 50, 0, 7, 3)] + [None]})
    cut = list(pieces([batch], "text", 10))
    assert [b.num_rows for b in cut] == [1, 1, 4] and pa.Table.from_batches(cut).combine_chunks().to_batches()[0].equals(batch)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.integers(1, 5))
def test_index_finds_every_occurrence(symbols, size):
    text = np.array([*symbols, 0])
    assert decontam.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    index = decontam.FmIndex(text)
    top = max(symbols, default=0)
    if not top:
        return
    phrases = np.array([[random.Random(i * size).randint(1, top) for i in range(k, k + size)] for k in range(6)])
    low, high = index.search(phrases)
    for phrase, a, z in zip(phrases.tolist(), low, high):
        naive = [i for i in range(len(text) - size + 1) if text[i : i + size].tolist() == phrase]
        assert sorted(index.locate(np.arange(a, max(a, z))).tolist()) == naive


def naive_hits(docs, items, window):
    rows = []
    for doc, text in docs:
        words, hit, met = split(text), set(), set()
        for item, other in items:
            own = split(other)
            size = min(window, len(own))
            wins = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in wins:
                    hit |= set(range(i, i + size))
                    met.add("" if item is None else str(item))
        rows.append((doc, len(words), len(hit), sorted(met)))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("pass_bytes", [1 << 20, 30])
def test_decontamination_equals_brute_force(spark, pass_bytes):
    rng = random.Random(3)
    vocabulary = ["a", "b", "C", "dé", "e9"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(60)]
    docs = [*enumerate([*texts, None, "", "...", texts[0], "x" * 500]), (1, texts[1]), (None, texts[2])]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate((9, 7, 5, 1, 12))] + [(7, None), (8, "!"), (None, texts[5]), (3, texts[6])]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_words int, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find_hits(d, b, window=5, shard_bytes=300, pass_bytes=pass_bytes)
    rows = found.withColumn("rest", decontam.without_spans()).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows], key=repr) == naive_hits(docs, items, 5)
    for r in rows:
        words = split(r.text)
        assert r.n_hit == sum(s.end_word - s.first_word for s in r.spans)
        for s in r.spans:
            assert split(r.text.encode()[s.first_byte : s.end_byte].decode()) == words[s.first_word : s.end_word]
        if r.text is not None:
            assert len(split(r.rest)) <= len(words) and (r.spans or r.rest == r.text)


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.n_words, r.n_hit, r["items"]) for r in decontam.find_hits(docs, none).collect()] == [(2, 0, [])]
    assert decontam.find_hits(docs.limit(0), none).count() == 0


def naive_top(rows, k):
    whole = [(i, [int(np.floor(256 * np.float64(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if q % 2 == 0:
            others = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, max(-(2**63 - 1), min(2**63 - 1, -c))) for r, (c, i) in enumerate(others)]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "LANE_TILES", 1)
    monkeypatch.setattr(topk, "MERGED", 2)
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 2]) for i in range(90)]
    rows += [(200, None), (202, [1.0, None, 0.0, 0.0]), (204, [float("nan"), 0.0, 0.0, 0.0]), (206, [1.0, 2.0]), (None, [0.0] * 4), (208, []), (209, []), (6, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7).withColumn("rank", F.lit("x"))
    found = topk.top_k(df, F.col("vec_id") % 2 == 0, 3).collect()
    assert sorted(map(tuple, found)) == naive_top(rows, 3)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 2 == 0, 3).count() == 0


def test_products_are_exact_at_every_size():
    for top in (100, 1 << 20, 1 << 30):
        a = np.random.default_rng(1).integers(-top, top, (5, 8)).astype(float)
        want = np.clip([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in a] for r in a], -topk.LONGEST, topk.LONGEST)
        assert (topk.products(a, a) == want.astype(np.int64)).all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == theirs and theirs


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_components_whose_multiples_overflow(spark):
    """Finite numbers as large as a double can be take part, and scores beyond a long stay at its ends."""
    rows = [(0, [1e307, 1.0]), (1, [1e307, 2.0]), (2, [-1e307, 0.0]), (3, [0.5, 0.5]), (4, [float("inf"), 1.0]), (5, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id").isin(0, 3), 9).collect()]
    big = 2**63 - 1
    assert sorted(out) == [(0, 1, 1, big), (0, 2, 3, big), (0, 3, 2, -big), (3, 1, 0, big), (3, 2, 1, big), (3, 3, 2, -big)]
