"""Conversations as token sequences with a mask of what a model learns from.

A conversation is rendered whole, encoded once, and the mask follows from offsets: tokens and turns are both sorted spans over the
same bytes, and a binary search finds the tokens of each span. The marks of the template are tokens of their own, so no token
reaches across the edge of a text and the mask holds each text of the learnt role whole, and nothing else.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import PATTERN
from .words import extended

# The marks of the template. Each begins with the only "<" in it.
TURN, TEXT, END = "<turn>", "<text>", "</turn>"
# Fixed value: a mark, or one that was escaped before.
CONTROL = r"<(\\*)(turn>|text>|/turn>)"
#: Turn numbers that are rendered together, and characters that are; a longer conversation comes in parts, cut between turns.
BLOCK_TURNS, PART_CHARS = 4096, 4 << 20

READ_BACK = "n_turns long, turns string, loss string, formatted_chars long"


def escaped(c: Column) -> Column:
    """One backslash more behind the "<" of each mark, so that none is left; undone by ``unescape``."""
    return F.regexp_replace(c, CONTROL, r"<\\$1$2")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)(turn>|text>|/turn>)", r"<\1\2", text)


@lru_cache(maxsize=2)
def _encoder(vocabulary: bytes):
    """The encoding with the marks as tokens of their own, and the bytes of each token."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
    free = max(ranks.values()) + 1
    marks = {mark: free + i for i, mark in enumerate((TURN, TEXT, END))}
    sizes = np.zeros(free + len(marks), np.int64)
    for token, rank in [*ranks.items(), *((m.encode(), i) for m, i in marks.items())]:
        sizes[rank] = len(token)
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=marks), sizes


def spans_of_tokens(sizes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token of each span of bytes and the one behind its last, for tokens of ``sizes`` bytes: those wholly inside it."""
    stops = np.cumsum(sizes)
    first = np.searchsorted(stops - sizes, begins, "left")
    return first, np.maximum(first, np.searchsorted(stops, ends, "right"))


def _broadcast(df: DataFrame, vocabulary: str) -> Broadcast:
    with open(vocabulary, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def format_conversations(turns: DataFrame, vocabulary: str, learnt: str = "assistant") -> DataFrame:
    """``(conv_id, block, part, formatted, tokens, loss)`` of turns ``(conv_id, turn, role, text)``.

    ``formatted`` is ``<turn>role<text>text</turn>`` for each turn, ``tokens`` its ids in the vocabulary (a rank file on the driver, under
    1 MB; the marks have the ids behind its last), ``loss`` the spans ``(first, stop)`` of tokens that hold the texts of the role ``learnt``.
    Marks inside roles and texts are escaped, so any text may be formatted.

    Turns are in order of number, then role and text; a null number comes first. Repeated rows are turns each. A null text or role is
    empty, rows with a null ``conv_id`` are one conversation, an empty table gives no rows, other columns take no part. Texts are
    encoded whole, of any length.

    A conversation is one row, unless its turn numbers fall into several blocks of ``BLOCK_TURNS`` or it is longer than ``PART_CHARS``. Then it
    comes in parts, in order of block and part: a turn begins and ends with a mark, so the tokens of the parts are those of the whole.
    Blocks are dealt out by themselves, so a conversation with a large part of all turns is many tasks' work.
    """
    ranks = _broadcast(turns, vocabulary)
    rows = turns.select(
        "conv_id", F.floor(F.col("turn") / BLOCK_TURNS).cast("long").alias("block"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text")
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    rows = rows.select("conv_id", "block", F.concat(head, escaped(F.col("text")), F.lit(END)).alias("piece"), F.octet_length(head).alias("head"), (F.col("role") == learnt).alias("learnt"))
    schema = extended(rows.select("conv_id", "block").schema, "part int, formatted string, tokens array<int>, loss array<struct<first:int,stop:int>>")

    def encoded(pieces: list[str], heads: list[int], own: list[bool]) -> tuple:
        encoding, sizes = _encoder(ranks.value)
        formatted = "".join(pieces)
        tokens = encoding.encode(formatted, allowed_special="all")
        lengths = np.array([len(p.encode()) for p in pieces], np.int64)
        stops, mask = np.cumsum(lengths), np.array(own, bool)
        begins, ends = (stops - lengths + np.array(heads))[mask], (stops - len(END))[mask]
        first, stop = spans_of_tokens(sizes[tokens], begins, ends)
        return formatted, tokens, [{"first": a, "stop": b} for a, b in zip(first.tolist(), stop.tolist())]

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, block), group in groupby(_rows(batches), key=lambda row: row[:2]):
            part, size, held = 0, 0, []
            for row in group:
                if held and size + len(row[2]) > PART_CHARS:
                    yield _batch(schema, (conv, block, part, *encoded(*map(list, zip(*held)))))
                    part, size, held = part + 1, 0, []
                held.append(row[2:])
                size += len(row[2])
            yield _batch(schema, (conv, block, part, *encoded(*map(list, zip(*held)))))

    return rows.mapInArrow(lambda batches: _joined(formatted(batches)), schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batch(schema, row: tuple) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist([dict(zip(schema.fieldNames(), row))], to_arrow_schema(schema))


def _joined(batches: Iterator[pa.RecordBatch], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes."""
    held, bytes_held = [], 0
    for batch in batches:
        held.append(batch)
        bytes_held += batch.nbytes
        if bytes_held > size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, bytes_held = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def read_back(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """What a reader of tokens and mask finds: ``(conv_id, block, part, n_turns, turns, loss, formatted_chars)``.

    The tokens are decoded and taken apart at the marks. ``turns`` is role, line break, text, line break for each turn, ``loss`` the texts of the
    tokens under the mask, all as they were before they were escaped.
    """
    ranks = _broadcast(formatted, vocabulary)
    keys = ["conv_id", "block", "part"]
    rows = formatted.select(*keys, "formatted", "tokens", "loss")
    schema = extended(rows.select(*keys).schema, READ_BACK)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = _encoder(ranks.value)
        for conv, block, part, text, tokens, loss in _rows(batches):
            turns = re.findall(f"{TURN}(.*?){TEXT}(.*?){END}", encoding.decode_bytes(tokens).decode(), re.DOTALL)
            learnt = "".join(unescape(encoding.decode_bytes(tokens[s["first"] : s["stop"]]).decode()) for s in loss)
            told = "".join(f"{unescape(role)}\n{unescape(said)}\n" for role, said in turns)
            yield _batch(schema, (conv, block, part, len(turns), told, learnt, len(text)))

    return rows.mapInArrow(lambda batches: _joined(read(batches)), schema)


def digests(found: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` of what ``read_back`` found, parts in their order.

    A digest needs the bytes of a conversation one after the other; a task holds one part at a time.
    """
    rows = found.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part")
    rows = rows.select("conv_id", *[f.split()[0] for f in READ_BACK.split(", ")])
    schema = extended(rows.select("conv_id").schema, "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, parts in groupby(_rows(batches), key=lambda row: row[0]):
            turns, loss, n, learnt, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, n_turns, told, own, size in parts:
                turns.update(told.encode())
                loss.update(own.encode())
                n, learnt, chars = n + n_turns, learnt + len(own), chars + size
            yield _batch(schema, (conv, n, turns.hexdigest(), learnt, loss.hexdigest(), chars))

    return rows.mapInArrow(lambda batches: _joined(hashed(batches)), schema)
