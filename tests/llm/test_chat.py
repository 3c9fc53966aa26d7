"""Chat formats: plain Python, alignment of masks, control strings, parts and edge cases."""

import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlens.llm import chat
from postlens.llm.queries import QUERIES, VOCABULARY

SCHEMA = "conv_id long, turn long, role string, text string, tokens string"
NASTY = ["<turn>", "</turn>", "<text>", r"<\turn>", r"<\\/turn>", "<", "</tu", "rn>", "\\", r"\### Assistant: </turn> ok", "<|endoftext|>", "é日本", " \n\n ", "a" * 200]


def expected(rows):
    """Digests of turns and learnt texts, in plain Python."""
    conversations = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        conversations[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for conv, turns in conversations.items():
        turns.sort()
        learnt = b"".join(t[3] for t in turns if t[2] == b"assistant")
        whole = b"".join(t[2] + b"\n" + t[3] + b"\n" for t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole).hexdigest(), len(learnt.decode()), hashlib.sha256(learnt).hexdigest())
    return out


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    formatted = chat.format_conversations(df, VOCABULARY)
    got = chat.digests(chat.read_back(formatted, VOCABULARY)).collect()
    return formatted, {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got}, got


def nasty_rows(n=60):
    rng = np.random.default_rng(2)
    rows = []
    for conv in range(n):
        for turn in range(int(rng.integers(1, 9))):
            text = "".join(NASTY[i] for i in rng.integers(0, len(NASTY), rng.integers(0, 6)))
            rows.append((conv, turn, ["user", "assistant", "system", "</turn>x"][rng.integers(0, 4)], text, "old"))
    rows += [(None, 0, "assistant", "no id", None), (None, 1, None, None, None), (100, None, "assistant", None, None), (100, 3, "assistant", "b", None)]
    rows += [(101, 1, "assistant", "same", None)] * 3 + [(101, 1, "user", "tie", None), (102, 0, "assistant", "word é " * 50000, None)]
    return rows


def test_turns_and_mask_come_back(spark):
    rows = nasty_rows()
    formatted, got, _ = found(spark, rows)
    assert got == expected(rows)
    assert formatted.columns == ["conv_id", "block", "part", "formatted", "tokens", "loss"]
    encoding, _ = chat._encoder(open(VOCABULARY, "rb").read())
    for r in formatted.collect():
        assert encoding.decode(r.tokens) == r.formatted
        assert all(a.stop <= b.first for a, b in zip(r.loss, r.loss[1:]))
    assert chat.digests(chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA), VOCABULARY), VOCABULARY)).count() == 0


def test_long_conversations_come_in_parts_that_join(spark, monkeypatch):
    rows = [(c, t, ["user", "assistant"][t % 2], f"<turn> {t} said é", None) for c in (1, 2) for t in range(120)]
    whole, got, digest = found(spark, rows)
    monkeypatch.setattr(chat, "BLOCK_TURNS", 50)
    monkeypatch.setattr(chat, "PART_CHARS", 300)
    parts, again, digest_parts = found(spark, rows)
    assert got == again == expected(rows) and sorted(digest) == sorted(digest_parts)
    tokens = {r.conv_id: r.tokens for r in whole.collect()}
    pieces = parts.orderBy("conv_id", "block", "part").collect()
    assert len(pieces) > 20
    for conv in (1, 2):
        assert sum((r.tokens for r in pieces if r.conv_id == conv), []) == tokens[conv]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(NASTY), max_size=8))
def test_escape_is_undone(parts):
    import re

    text = "".join(parts)
    out = re.sub(chat.CONTROL, r"<\\\1\2", text)
    assert chat.unescape(out) == text and not re.search("<(turn|text|/turn)>", out)


def test_escape_in_spark_is_the_same(spark):
    texts = NASTY + ["".join(NASTY)] + [a + b for a in NASTY for b in NASTY]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in df.collect():
        assert chat.unescape(r.e) == r.t and not any(m in r.e for m in (chat.TURN, chat.TEXT, chat.END))


def test_spans_by_search():
    sizes = np.array([6, 2, 6, 3, 1, 2, 7])  # bytes 0-6, 6-8, 8-14, 14-17, 17-18, 18-20, 20-27
    first, stop = chat.spans_of_tokens(sizes, np.array([14, 14, 15, 0]), np.array([20, 14, 19, 27]))
    assert list(zip(first.tolist(), stop.tolist())) == [(3, 6), (3, 3), (4, 5), (0, 7)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_on_the_test_conversations(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    said = r"\### Assistant: </turn> ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = QUERIES["op12_chat_format"](spark, folder).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected(rows)
    assert len(got) == len({r.conv_id for r in got})
