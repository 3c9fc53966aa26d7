"""Filter audit: a walk through all orders in plain Python, the sparse matrix, clashing numbers and edge cases."""

import collections
import itertools
import random
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from postlens.llm import audit
from postlens.session import written

SCHEMA = "doc_id long, text string, source string, part string, n long"


def walked(rows, labels):
    """Every order applied to every document, step by step."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    docs = collections.defaultdict(list)
    for i, text, source, *_ in rows:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", body)) > 5 * len(body)}
        fails |= {"D": bool(re.search("[#$%&*|]", body)), "E": i is not None and i > first[body]}
        docs[source or ""].append((i, "".join(f for f in "ABCDE" if fails[f])))
    out = {}
    for part, found in docs.items():
        removed_by = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(found)
            for step, f in enumerate(order, 1):
                here = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                every = sum(f in d[1] for d in found)
                removed_by[f] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), every - len(here), sum(d[1] == f for d in found),
                    sum(d[0] in good for d in here), sum(d[0] in toxic for d in here),
                ]
        for key, values in out.items():
            if key[0] == part:
                values.append(removed_by[key[1][key[2] - 1]])
    return out


def documents():
    rng = random.Random(4)
    pool = ["one", "Two", "drei", "é日", "#", "x\x1cy", "ABC", "a|b", "\x85", "𝔘"] + [f"w{i}" for i in range(60)]
    texts = [None, "", "   ", "\n\t\x0b\x0c\r", "word"] + [
        rng.choice([" ", "\n", " \t"]).join(rng.choice(pool[: rng.choice([6, 70])]) for _ in range(rng.choice([3, 49, 50, 51, 90]))) for _ in range(60)
    ]
    rows = [(i, rng.choice(texts), rng.choice(["s1", "s2", None, "", "lone"]), "old", 1) for i in range(300)]
    return rows + [(None, texts[7], "s1", None, None)] * 3 + [(5, texts[8], "s2", None, None)] * 2 + [(999, "long " * 100000, "s1", None, None)]


def test_all_orders_against_a_walk(spark):
    rows, labels = documents(), [(i, i % 2, (i // 2) % 2) for i in range(0, 300, 3)] + [(3, 1, 0), (3, 0, 0), (None, 1, 1), (9, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = audit.interactions(audit.failures(docs, marks))
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in out.collect()}
    assert got == walked(rows, labels) and len(got) == 600 * 4
    assert dict(out.dtypes)["step"] == "int" and {t for c, t in out.dtypes[3:]} == {"bigint"}
    assert audit.interactions(audit.failures(docs.limit(0), marks)).count() == 0
    assert audit.interactions(audit.failures(docs.limit(1), marks.limit(0))).count() == 600


def test_matrix_holds_every_word(spark, monkeypatch):
    monkeypatch.setattr(audit, "SHARD_BYTES", 500)
    rows = [(i, (t or ""), s) for i, t, s, *_ in documents()[:300]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for number in (F.xxhash64, lambda w: F.length(w).cast("long") - 4):  # the second gives many words one number
        with written(audit.matrix_shards(docs), "m") as shards, written(audit.dictionary(shards, number), "d") as words:
            matrix, numbered = audit.term_matrix(shards, words, number)
            ids = {r.word: r.id for r in numbered.collect()}
            assert len(set(ids.values())) == len(ids) == len({w for _, t, _ in rows for w in re.findall(r"[^\x20\x09-\x0D]+", t)})
            found = {}
            for shard in matrix.collect():
                assert [ids[w] for w in shard.words] == shard.ids
                for r in shard.rows:
                    found[r.doc_id] = {shard.ids[k]: n for k, n in zip(r.places, r.counts, strict=True)}
            assert found == {i: collections.Counter(ids[w] for w in re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
            assert matrix.count() > 20


def test_matrix_is_read_and_written_in_small_parts(spark, monkeypatch):
    """Neither a row nor a row group grows with the text of a task, here 24 MB of it."""
    docs = spark.range(0, 24000, 1, 1).selectExpr("id AS doc_id", "'s' AS source", "concat_ws(' ', transform(sequence(1, 120), i -> concat('w', xxhash64(id, i) % 50000))) AS text")
    seen, dictionary = [], audit.dictionary

    def watched(shards, *more):
        seen.extend(pq.ParquetFile(f.removeprefix("file:")).metadata for f in shards.inputFiles())
        seen.append(shards.selectExpr("sum(size(rows)) AS docs", "max(aggregate(flatten(rows.counts), 0, (a, n) -> a + n)) AS most").first())
        return dictionary(shards, *more)

    monkeypatch.setattr(audit, "dictionary", watched)
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.failures(docs, marks).agg(F.sum("n")).first()[0] == 24000
    *files, shards = seen
    assert shards.docs == 24000 and shards.most * 6 < 5 << 20  # words have six letters or more with the space
    groups = [f.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) == len(groups) > 5
    assert max(g.total_byte_size for g in groups) < 8 << 20
