"""Language mixtures, toxicity chains and language-model scores: held-out accuracy, brute force and edge cases."""

import collections
import math
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlens.llm import language, lm, toxicity, words
from postlens.llm.queries import QUERIES
from postlens.llm.words import PIECE_BYTES, Words

SF = "/root/testdata/sf0.01"


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_held_out_languages(spark):
    out = QUERIES["op9_language"](spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in out if r.held_out]
    assert len(out) == len(lang) and 0.2 < len(held) / len(out) < 0.45
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_mixtures_edge_cases_and_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    by = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max(F.when(F.col("n_chars") > 1500, F.col("text"))).alias("text")).collect()}
    both = " ".join(split(by["en"])[:150] + split(by["de"])[:150])
    rows = [(1, None), (2, ""), (3, "123 -- !"), (4, "«»—…"), (5, both), (6, by["fr"] * 30), (7, by["fr"]), (7, by["fr"]), (8, "日本語")]
    df = spark.createDataFrame([(i, t, "?") for i, t in rows], "doc_id long, text string, score string")
    out = language.predict(df, model).collect()
    assert len(out) == len(rows)
    found = {r.doc_id: r for r in out}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 and found[i].languages == [] for i in (1, 2, 3, 4))
    assert set(found[5].languages) == {"en", "de"} and 0.4 < found[5].score < 0.6
    assert found[6].lang_pred == found[7].lang_pred == "fr" and found[8].lang_pred in model.languages
    nothing = language.train(docs.limit(0))
    assert nothing.languages == [] and {r.lang_pred for r in language.predict(df, nothing).collect()} == {"und"}
    assert language.predict(df.limit(0), model).count() == 0


def test_mixture_weights_are_those_of_the_words():
    likelihood = np.array([[1, 0.01, 0.01]] * 30 + [[0.01, 1, 0.01]] * 10 + [[0.01, 0.01, 1]], np.float32)
    share = language.mixtures(likelihood, np.array([0, 40, 41]))
    assert share[0] == pytest.approx([0.75, 0.25, 0], abs=0.03) and share[1] == pytest.approx([0, 0, 1], abs=0.01)


def test_toxic_documents_that_were_not_trained_on(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").cache(), spark.read.parquet(f"{SF}/labels.parquet")
    chain = toxicity.train(docs, labels.where("doc_id % 3 <> 0"), ["quality", "toxic"])
    assert [link.category for link in chain] == ["quality", "toxic"] and len(chain[1].earlier) == 1
    scored = toxicity.score(docs, chain).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = np.mean([r.toxic_pred == (r.toxic == 1) for r in scored])
    ranked = sorted(scored, key=lambda r: -r.p_toxic)
    positive = sum(r.toxic for r in scored)
    assert right > 0.88 and sum(r.toxic for r in ranked[:positive]) >= 0.65 * positive


def test_toxicity_edge_cases(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "bad word " * 4000, 1), (3, "bad word", 1), (None, "bad", 1)] + [(i, "bad" if i % 2 else "good text", 1) for i in range(4, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p_toxic int")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(4, 40)] + [(4, 0, 1), (None, 1, 1), (5, None, 1), (999, 1, 1)], "doc_id long, toxic int, one int")
    chain = toxicity.train(docs, labels, ["one", "toxic"])
    out = toxicity.score(docs, chain).collect()
    assert len(out) == len(rows) and all(r.p_one > 0.99 and 0 <= r.p_toxic <= 1 for r in out)
    found = {r.doc_id: r.p_toxic for r in out}
    assert found[5] > 0.5 > found[4]
    empty = toxicity.train(docs, labels.limit(0), ["toxic"])
    assert {r.p_toxic for r in toxicity.score(docs, empty).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), chain).count() == 0


def naive_scores(texts, order):
    docs = [split(t) for t in texts]

    def grams(words):
        return collections.Counter(tuple(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1))

    everything, own = collections.Counter(), [grams(d) for d in docs]
    for c in own:
        everything.update(c)
    total = sum(map(len, docs))
    out = []
    for words, mine in zip(docs, own):
        value = 0.0
        for i in range(len(words)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                gram = tuple(words[i - n + 1 : i + 1])
                seen = everything[gram] - mine[gram]
                if n == 1:
                    value += math.log(0.4 ** (longest - 1) * max(seen, 1) / max(total - len(words), 1))
                elif seen > 0:
                    value += math.log(0.4 ** (longest - n) * seen / (everything[gram[:-1]] - mine[gram[:-1]]))
                    break
        out.append((len(words), round(value, 6), round(value / len(words), 6) if words else None))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 200)
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(["the", "a", "B", "c", "dé", f"u{i}"], rng.integers(0, 30))) for i in range(50)]
    texts += [None, "", "..", texts[0], texts[0], "the " * 200]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string").repartition(3)
    out = {r.doc_id: (r.n_words, round(r.log_score, 6), None if r.mean_score is None else round(r.mean_score, 6)) for r in lm.score(df, order).collect()}
    assert [out[i] for i in range(len(texts))] == naive_scores(texts, order)
    assert lm.score(df.limit(0), order).count() == 0
    assert len(lm.score(df.unionByName(df), order).collect()) == 2 * len(texts)


def test_blobs_round_trip():
    numbers = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(numbers)) == numbers).all()
    assert lm.unpack(lm.pack(lm.smallest(np.array([1, 300]))), np.uint16).tolist() == [1, 300]


def test_exploded_rows_are_the_grams_of_a_chunk(spark):
    """Hashes where n-grams stand equal those of the chunk's levels; the ranges of all rounds hold each n-gram once; totals span chunks."""
    rng = np.random.default_rng(3)
    vocabulary = np.unique(rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2))
    tokens, count = rng.integers(0, len(vocabulary), 300).astype(np.uint8), np.array([0, 1, 2, 3, 294, 0])
    grams = lm.Grams(vocabulary, tokens, count, 3)
    hashes, by = grams.merged()
    counts = np.concatenate(grams.counts())[by]
    for found, level, n in zip(lm.position_hashes(vocabulary, tokens, count, 3), grams.hashes, grams.counts()):
        values, times = np.unique(found, return_counts=True)
        assert (values == level[n > 0]).all() and (times == n[n > 0]).all()
    chunk = {"chunk": 7, "count": lm.pack(count), "vocabulary": lm.pack_sorted(vocabulary), "tokens": lm.pack(tokens), "words": 300}
    batch = pa.RecordBatch.from_pylist([chunk])
    rows = [r for part in range(lm.ROUNDS) for b in lm._exploded([batch], 3, part) for r in b.to_pylist()]
    assert [(r["gram"] % 2**64, r["n"]) for r in rows] == [(int(h), int(n)) for h, n in zip(hashes, counts) if n]
    df = spark.createDataFrame([(5, 0, 2), (5, 1, 3), (6, 0, 9)], "gram long, chunk long, n long")
    assert {(r.gram, r.chunk, r.n, r.total) for r in lm.with_totals(df).collect()} == {(5, 0, 2, 5), (5, 1, 3, 5), (6, 0, 9, 9)}
    packed = pa.RecordBatch.from_pylist([{"chunk": c, "gram": g, "total": t} for c, g, t in [(1, -5, 300), (0, 9, 2), (1, 8, 4)]])
    answers = [r for b in lm._packed([packed, packed.slice(0, 0)]) for r in b.to_pylist()]
    assert [(r["chunk"], lm.unpack_sorted(r["grams"]).view(np.int64).tolist()) for r in answers] == [(0, [9]), (1, [-5, 8])]
    assert [lm._unpack_counts(r["totals"], n).tolist() for r, n in zip(answers, (1, 2))] == [[2], [300, 4]]


def test_chunks_keep_no_tables_of_their_length(monkeypatch):
    """A chunk of many texts is hashed in small pieces, so that a worker holds no powers for each byte of a chunk; the words are those of the whole."""
    texts = [" ".join(f"w{i * j % 977}" for j in range(20_000)) for i in range(50)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(52)), "text": pa.array([None, *texts, ""])})
    assert batch.nbytes > 2 * PIECE_BYTES
    monkeypatch.setattr(words, "_powers", np.ones((2, 1), np.uint64))
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    (chunk,) = [r for b in lm._chunks(iter([batch])) for r in b.to_pylist()]
    assert words._powers.shape[1] <= PIECE_BYTES + 2
    vocabulary, tokens, count = lm._words(chunk)
    assert (vocabulary[tokens] == Words(batch.column(1)).hash).all()
    assert count.tolist() == [0, *[20_000] * 50, 0] and chunk["ids"] == list(range(52)) and chunk["chunk"] == 3 << 32


def test_query_scores_by_trigrams(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    out = {r.doc_id: r.log_score for r in QUERIES["op7_lm_scores"](spark, "/root/testdata/sf0.001").collect()}
    three, two = ([x[1] for x in naive_scores([t for _, t in docs], n)] for n in (3, 2))
    assert [round(out[i], 6) for i, _ in docs] == three and three != two


def test_every_language_is_learnt_and_found(spark, monkeypatch):
    """Ninety languages, more than a document may mix, each with words of its own; a small limit gives what a large one does."""
    rng = np.random.default_rng(4)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:02}": ["".join(rng.choice(list(alphabet), 7)) for _ in range(8)] for i in range(90)}

    def text(*names):
        return " ".join(str(rng.choice(words[n])) for n in names for _ in range(25))

    rows = [(i, text(n), n) for i, n in enumerate([*words, *words])]
    mixed = [(1000 + i, text(f"l{i:02}", f"l{i + 40:02}"), None) for i in range(20)]
    df = spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string").repartition(3)
    model = language.train(df)
    assert model.languages == sorted(words)
    found = {r.doc_id: r for r in language.predict(df, model).collect()}
    assert all(found[i].lang_pred == n for i, _, n in rows)
    assert all(set(found[1000 + i].languages) == {f"l{i:02}", f"l{i + 40:02}"} for i in range(20))
    monkeypatch.setattr(language, "CANDIDATES", 100)
    whole = {r.doc_id: r for r in language.predict(df, model).collect()}
    assert all(found[i].lang_pred == whole[i].lang_pred and found[i].languages == whole[i].languages and abs(found[i].score - whole[i].score) < 1e-4 for i in whole)


def naive_mixture(likelihood):
    """EM from even proportions and removal by penalised likelihood, word by word in plain Python."""

    def fit(share, rounds):
        for _ in range(rounds):
            total = [0.0] * len(share)
            for row in likelihood:
                joint = [a * b for a, b in zip(row, share)]
                total = [t + x / max(sum(joint), 1e-30) for t, x in zip(total, joint)]
            share = [t / len(likelihood) for t in total]
        return share, sum(math.log(max(sum(a * b for a, b in zip(row, share)), 1e-30)) for row in likelihood)

    n = len(likelihood[0])
    share, _ = fit([1 / n] * n, language.ROUNDS)
    share = [x if x >= language.NEGLIGIBLE else 0.0 for x in share]
    share, value = fit([x / sum(share) for x in share], 1)
    while sum(x > 0 for x in share) > 1:
        least = min((x, j) for j, x in enumerate(share) if x > 0)[1]
        trial = [0.0 if j == least else x for j, x in enumerate(share)]
        trial, without = fit([x / sum(trial) for x in trial], language.MORE_ROUNDS)
        if without + 0.5 * math.log(max(len(likelihood), 2)) < value:
            break
        share, value = trial, without
    return share


def test_mixtures_equal_plain_python():
    rng = np.random.default_rng(8)
    docs = [np.exp(-rng.exponential(rng.choice([0.3, 2.0, 6.0]), (int(rng.integers(1, 40)), 5))) for _ in range(40)]
    docs = [(d / d.max(axis=1, keepdims=True)).astype(np.float32) for d in docs]
    first = np.cumsum([0, *map(len, docs)])
    found = language.mixtures(np.concatenate(docs), first)
    for row, d in zip(found, docs):
        assert np.allclose(row, naive_mixture(d.astype(float).tolist()), atol=2e-3)


def test_chain_scores_equal_a_plain_one(spark):
    """Probabilities worked out again from the links, word by word."""
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()] + [(-1, None), (-2, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    chain = toxicity.train(df, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), ["quality", "toxic"])
    found = {r.doc_id: r for r in toxicity.score(df, chain).collect()}
    for i, text in docs:
        numbers = set(toxicity.feature_numbers(Words(pa.array([text], pa.string())))[0].tolist())
        earlier = []
        for link in chain:
            z = link.intercept + sum(w for f, w in zip(link.features, link.weights) if f in numbers) + sum(w * p for w, p in zip(link.earlier, earlier))
            earlier.append(1 / (1 + math.exp(-z)))
            assert math.isclose(found[i][f"p_{link.category}"], earlier[-1], abs_tol=1e-9)
            assert found[i][f"{link.category}_pred"] == (earlier[-1] >= link.threshold)
