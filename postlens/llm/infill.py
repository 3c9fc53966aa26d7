"""Fill-in-the-middle by lines: texts are cut in three and put together with the middle last.

The cuts fall behind lines, so each text needs the number of its lines and where the chosen ones end. Texts share long passages, so
they are not counted byte by byte: a rolling hash cuts them into chunks whose borders depend on nearby bytes alone, and equal
passages give equal chunks wherever they stand. A chunk is summed up once (lines, characters, marks, the bytes at its ends) and the
summary is kept under the chunk's whole content, so two chunks share one only if they are equal. Sums over the chunks of a text
give its lines; a search in them finds the chunk with a cut, and only that chunk is looked through.

Every task works for itself: nothing is shuffled, and what it keeps is bounded.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import with_new
from .words import extended, pieces, text_bytes

# The marks in front of the three parts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Bytes of a chunk: at least, at most (and the rest of a character), and between two borders in the mean.
LEAST, MOST, MEAN_BITS = 256, 8192, 10
#: Bytes that the rolling hash sees, a power of two below ``LEAST``.
WINDOW = 32
#: Bytes of text that are hashed at once.
BLOCK = 1 << 20
#: Bytes of chunks whose summaries a task keeps.
MEMO_BYTES = 64 << 20

_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


class Summary(NamedTuple):
    lines: int
    chars: int
    marked: bool
    head: bytes
    tail: bytes


def summary(chunk: bytes) -> Summary:
    """What a text needs of one chunk. A mark has three bytes, so two at either end tell of those across a border."""
    codes = np.frombuffer(chunk, np.uint8)
    chars = int(np.count_nonzero((codes & 0xC0) != 0x80))
    return Summary(chunk.count(b"\n"), chars, any(m in chunk for m in MARKS), chunk[:2], chunk[-2:])


class Memo:
    """Summaries by content. Two generations: when the young one is full it becomes the old one, and the old one goes."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.size = limit // 2, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}

    def __call__(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is None:
            found = self.old.get(chunk) or summary(chunk)
            if self.size + len(chunk) > self.limit:
                self.old, self.young, self.size = self.young, {}, 0
            self.young[chunk] = found
            self.size += len(chunk)
        return found


def borders(data: np.ndarray) -> np.ndarray:
    """Places before which a chunk may end: the hash of the ``WINDOW`` bytes before is zero in its highest bits and a character begins."""
    found = []
    for at in range(0, len(data), BLOCK):
        first = max(0, at - WINDOW)
        part = data[first : at + BLOCK + 1]
        rolling, width = _GEAR[part], 1
        while width < WINDOW:  # the sum over a window of twice the width, from two of the width
            rolling[width:] += rolling[:-width] << np.uint32(width)
            width *= 2
        ends = (rolling[:-1] >> np.uint32(32 - MEAN_BITS) == 0) & ((part[1:] & 0xC0) != 0x80)
        places = np.flatnonzero(ends) + 1 + first
        found.append(places[places > at] if at else places)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunks(text: bytes, places: list[int], base: int = 0) -> list[bytes]:
    """``text`` cut at ``places``, its possible borders, which count from ``base`` before the text."""
    cut, at = [], 0
    while len(text) - at > LEAST:
        k = bisect_left(places, base + at + LEAST)
        stop = min(places[k] - base if k < len(places) else len(text), at + MOST)
        while stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop += 1
        if stop >= len(text):
            break
        cut.append(text[at:stop])
        at = stop
    if at < len(text):
        cut.append(text[at:])
    return cut


class Outline:
    """A text by its chunks: ``n`` lines, and where they end."""

    def __init__(self, text: bytes, cut: list[bytes], memo: Memo):
        self.text, self.cut = text, cut
        parts = [memo(c) for c in cut]
        self.lines = list(accumulate((s.lines for s in parts), initial=0))
        self.chars = list(accumulate((s.chars for s in parts), initial=0))
        self.starts = list(accumulate(map(len, cut), initial=0))
        self.n = self.lines[-1] + (not text.endswith(b"\n") if text else 0)
        self.marked, before = False, b""
        for s in parts:
            across = before + s.head
            self.marked = self.marked or s.marked or any(m in across for m in MARKS)
            before = (before + s.tail)[-2:]

    def end_of(self, line: int) -> tuple[int, int]:
        """Bytes and characters up to the end of the first ``line`` lines."""
        if line == 0:
            return 0, 0
        if line > self.lines[-1]:  # the last line, which no line break ends
            return self.starts[-1], self.chars[-1]
        k = bisect_left(self.lines, line) - 1
        chunk = np.frombuffer(self.cut[k], np.uint8)
        stop = int(np.flatnonzero(chunk == 10)[line - self.lines[k] - 1]) + 1
        return self.starts[k] + stop, self.chars[k] + int(np.count_nonzero((chunk[:stop] & 0xC0) != 0x80))


def _arranged(outline: Outline, key: str, seed: int, rate: int, spm_rate: int) -> tuple:
    text, n = outline.text, outline.n
    h1, h2, h3, h4 = struct.unpack(">4I", hashlib.sha256(f"{seed}:{key}".encode()).digest()[:16])
    if not text or outline.marked or h3 % 100 >= rate:
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = outline.end_of(first), outline.end_of(last)
    if h4 % 100 < spm_rate:
        form, output = "spm", b"".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
    else:
        form, output = "psm", b"".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))
    return n, form, a_chars, b_chars - a_chars, output


def fill_in_middle(
    docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 7, rate: int = 100, spm_rate: int = 50
) -> DataFrame:
    """``docs`` with ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``, the text as a model is to see it.

    ``seed`` and ``key`` decide the cuts and the form, so reruns agree: of a hundred texts ``rate`` are cut, and of these ``spm_rate``
    have their suffix first. A text that is empty or holds a mark is ``plain`` and its own output. A null text is empty; a null key
    counts as an empty one, so rows with equal keys are cut at equal draws, and repeated rows are each treated alike. A cut may leave a
    part empty. Whole texts are cut, of any length. Other columns are handed on, but for those named as a new one.
    """

    def build(plain: DataFrame) -> DataFrame:
        own = [c for c in plain.columns if c.lower() != text.lower()]
        rows = plain.select(*own, F.col(text).alias("__text"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"))
        schema = extended(plain.select(*own).schema, "n long, form string, prefix_chars long, middle_chars long, output string")

        def arranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo = Memo()
            for piece in pieces(batches, "__text"):
                data, at = text_bytes(piece.column("__text"))
                places, raw, made = borders(data).tolist(), data.tobytes(), []
                for i, name in enumerate(piece.column("__key").to_pylist()):
                    body = raw[at[i] : at[i + 1]]
                    made.append(_arranged(Outline(body, chunks(body, places, int(at[i])), memo), name, seed, rate, spm_rate))
                n, form, prefix, middle, output = zip(*made)
                columns = [pa.array(x, pa.int64()) for x in (n, prefix, middle)]
                columns = [columns[0], pa.array(form, pa.string()), *columns[1:], pa.array(output, pa.binary()).view(pa.string())]
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(own)], *columns], schema.fieldNames())

        return rows.mapInArrow(arranged, schema)

    return with_new(docs, (key, text), build)


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form. No part holds a mark, so the marks found are its own."""
    parts = F.split(output, "<[PSM]>", -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
