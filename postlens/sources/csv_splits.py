"""One large CSV file by many tasks, though its quoted fields hold line breaks.

A line break ends a record only outside quotes, and whether a place is inside quotes depends on every quote before it. A first pass
finds, for each split of the files, whether its quotes are odd in number, and the pieces of records at its ends. The states at the
beginnings of the splits are then running sums of odd splits, and a second pass cuts the records of each split from its state on.
Records across the ends of splits are put together from the pieces, a few for each split; no other text is shuffled.

That holds for CSV in which a quote is either around a field or doubled inside it (RFC 4180).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..shipping import ship_code

#: Bytes of the part of one record that lies in one split, at most. A longer one is an error, and the way on is a larger limit.
MOST_RECORD = 64 << 20

OUTLINE = "file long, block long, odd int, turns boolean, head string, tail string, first string"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, value)``: the lines of the files, each with the hash of its file and where its split begins; in order within a split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


class Segment(NamedTuple):
    """Consecutive lines of a split, and for each whether the quotes of the split before it are odd in number, and behind it."""

    lines: pa.Array
    before: np.ndarray
    behind: np.ndarray


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The lines of each split, in as many pieces as there are batches."""
    for batch in batches:
        file, block = (batch.column(i).to_numpy() for i in (0, 1))
        new = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        edges = [0, *new.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield int(file[a]), int(block[a]), batch.slice(a, b - a)


def segment(lines: pa.Array, odd: int) -> Segment:
    counts = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
    behind = (np.cumsum(counts) + odd) & 1
    return Segment(lines, np.concatenate(([odd], behind[:-1])), behind)


class _Held:
    """Lines that wait for the end of their record; none if they are longer than the limit."""

    def __init__(self, limit: int):
        self.limit, self.size, self.lines = limit, 0, []

    def add(self, lines: pa.Array) -> None:
        self.size += len(lines) + (pc.sum(pc.binary_length(lines)).as_py() or 0)
        if self.size <= self.limit:
            self.lines.append(lines)
        else:
            self.lines = []

    def text(self) -> str | None:
        if self.size > self.limit:
            return None
        return "\n".join(x for part in self.lines for x in part.to_pylist())


class _Outline:
    """What the first pass keeps of a split. States count from its beginning, as if it began outside quotes."""

    def __init__(self, file: int, block: int, limit: int):
        self.key, self.limit, self.odd, self.turns = (file, block), limit, 0, False
        self.head = _Held(limit)
        self.open = [_Held(limit), _Held(limit)]  # since the last line with even quotes before it, and with odd ones
        self.first = _Held(limit)
        self.header = None

    def add(self, lines: pa.Array) -> None:
        part = segment(lines, self.odd)
        if not self.turns:
            flip = int(np.argmax(part.behind)) if part.behind.any() else len(lines) - 1
            self.head.add(lines.slice(0, flip + 1))
            self.turns = bool(part.behind[flip])
        for state in (0, 1):
            at = np.flatnonzero(part.before == state)
            if len(at):
                self.open[state] = _Held(self.limit)
                self.open[state].add(lines.slice(int(at[-1])))
            else:
                self.open[state].add(lines)
        if self.key[1] == 0 and self.header is None:
            self._look_for_header(part)
        self.odd = int(part.behind[-1])

    def _look_for_header(self, part: Segment) -> None:
        at = 0
        for end in np.flatnonzero(part.behind == 0):
            self.first.add(part.lines.slice(at, int(end) + 1 - at))
            text, at = self.first.text(), int(end) + 1
            if text is None or text.strip():
                self.header = text
                return
            self.first = _Held(self.limit)
        self.first.add(part.lines.slice(at))

    def row(self) -> tuple:
        return *self.key, self.odd, self.turns, self.head.text(), self.open[1 - self.odd].text(), self.header


def outlines(lines: DataFrame, most_record: int = MOST_RECORD) -> DataFrame:
    """A row for each split: whether its quotes are odd in number, whether any line's are, and the pieces at its ends.

    ``head`` are the lines up to the first with odd quotes, the rest of a record if the split begins inside one. ``tail`` is the record that is open at the end of
    the split, if one is. Of a file's first split ``first`` is the header, if it ends there. A piece over the limit is null.
    """

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in OUTLINE.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string()]

        def row(found: _Outline) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(found.row(), types)], names)

        now = None
        for file, block, part in _splits(batches):
            if now is None or now.key != (file, block):
                if now is not None:
                    yield row(now)
                now = _Outline(file, block, most_record)
            now.add(part.column(2))
        if now is not None:
            yield row(now)

    return lines.mapInArrow(outline, OUTLINE)


def states(found: DataFrame) -> DataFrame:
    """``(file, block, inside, opener)`` of outlines: whether the split begins inside quotes, and the split in which that record begins.

    One narrow row for each split, as many as Spark plans anyway, in order of each file.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    known = found.select("file", "block", "odd", "turns", inside.alias("inside"))
    # A record is open at the end if the state is odd there, and it begins in the split unless all of the split lies inside one.
    opens = (F.col("inside").cast("int") + F.col("odd")) % 2 == 1
    begins = opens & (~F.col("inside") | F.col("turns"))
    known = known.withColumn("begins", begins)
    opener = F.last(F.when(F.col("begins"), F.col("block")), ignorenulls=True).over(before)
    return known.select("file", "block", "inside", "turns", "begins", opener.alias("opener"))


def across(found: DataFrame, known: DataFrame) -> DataFrame:
    """``(value)``: the records that lie in several splits, from the pieces; but for a header."""
    def told(piece: str):
        return F.coalesce(piece, F.raise_error(F.concat(F.lit("a record is too long, or a quote is never closed, after byte "), F.col("block"))))

    splits = found.join(known.drop("turns"), ["file", "block"])
    rest = splits.where("inside").select("file", F.col("opener").alias("record"), F.col("block").alias("at"), F.lit(0).alias("nth"), told("head").alias("text"), F.lit(False).alias("header"))
    start = splits.where("begins").select("file", F.col("block").alias("record"), F.col("block").alias("at"), F.lit(1).alias("nth"), told("tail").alias("text"), (F.col("first").isNull() & (F.col("block") == 0)).alias("header"))
    pieces = rest.unionByName(start).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("at", "nth", "text"))).alias("pieces"), F.max("header").alias("header"))
    return pieces.where(~F.col("header")).select(F.concat_ws("\n", "pieces.text").alias("value"))


def inner_records(lines: DataFrame, inside: dict[int, dict[int, bool]]) -> DataFrame:
    """``(value)``: the records that lie in one split, without headers; ``inside`` has the state of every split of every file."""
    known = lines.sparkSession.sparkContext.broadcast(inside)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, odd, started, header, held = None, 0, False, False, []
        for file, block, part in _splits(batches):
            if now != (file, block):
                now, held = (file, block), []
                if block not in known.value.get(file, {}):
                    raise RuntimeError("the splits of the files have changed between two passes: set spark.sql.files.minPartitionNum")
                odd, header = int(known.value[file][block]), block == 0
                started = not odd
            cut = segment(part.column(2), odd)
            odd = int(cut.behind[-1])
            ends = np.flatnonzero(cut.behind == 0) + 1
            lines_here = cut.lines
            if not started and len(ends):  # the rest of a record that begins in another split
                lines_here, ends, started = lines_here.slice(ends[0]), ends[1:] - ends[0], True
            if not started:
                continue
            held.append(lines_here.slice(0, int(ends[0]) if len(ends) else len(lines_here)))
            if not len(ends):
                continue
            first = pa.concat_arrays(held)
            held = [lines_here.slice(int(ends[-1]))]
            body = pa.concat_arrays([first, lines_here.slice(int(ends[0]), int(ends[-1] - ends[0]))])
            offsets = np.concatenate(([0], ends - ends[0] + len(first)))
            found = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), body), "\n")
            found = found.filter(pc.not_equal(pc.utf8_trim_whitespace(found), ""))
            if header and len(found):
                found, header = found.slice(1), False
            yield pa.RecordBatch.from_arrays([found.cast(pa.string())], ["value"])

    return lines.mapInArrow(records, "value string")


def read_records(spark: SparkSession, path: str, most_record: int = MOST_RECORD) -> tuple[DataFrame, DataFrame]:
    """``(value)``, every record of the CSV files below ``path`` as text, without headers, and the headers ``(first)`` of the files.

    The outlines of the splits are written to the shared folder; the states of the splits, a few bytes for each, pass the driver, as the
    plan of splits does.
    """
    ship_code(spark)
    lines = lines_of(spark, path)
    kept = scratch_path(spark, "csv-outlines")
    outlines(lines, most_record).write.parquet(kept)
    found = spark.read.parquet(kept)
    known = states(found)
    inside: dict[int, dict[int, bool]] = {}
    for row in known.select("file", "block", "inside").toLocalIterator():
        if row.block in inside.setdefault(row.file, {}):
            raise RuntimeError("two files have one hash: read them apart")
        inside[row.file][row.block] = row.inside
    records = inner_records(lines, inside).unionByName(across(found, known))
    return records, found.where("block = 0").select("first")
