"""Language-model scores with stupid backoff, from n-gram counts of the whole corpus.

The relations are (n-gram, chunk, count) and (n-gram, total). Documents are gathered into chunks of bounded size; a chunk keeps
its words as numbers and explodes to a row for each of its distinct n-grams, a 64-bit hash. The rows meet by n-gram, are summed, and each
has the sum joined to it. A frequent n-gram is one row per chunk, and a chunk has hundreds of thousands of n-grams, so no key is hot.
N-grams that only one chunk has keep its count and are not sent back. A chunk holds whole documents: with the totals of its n-grams it
works out the words' scores and sums them per document.

A document is scored by the counts of all others: its own n-grams are taken off the totals first.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_folder, scratch_path
from .words import Words, mix, pieces

#: Bytes of text in a chunk; n-grams of the corpus to a partition of the counts, if the session does not set more partitions.
CHUNK_BYTES, PARTITION_GRAMS = 8 << 20, 1 << 20
#: Rounds in which ranges of hashes are counted, and then parts of the chunks scored, one after the other; what a round has shuffled goes before the next.
ROUNDS = 4
BACKOFF = 0.4


def pack(array: np.ndarray) -> bytes:
    raw = array.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True), kind)


def pack_sorted(hashes: np.ndarray) -> bytes:
    """Differences, byte by byte: the high bytes are mostly zero and shrink."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return pack(steps.view(np.uint8).reshape(-1, 8).T.copy())


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = unpack(blob, np.uint8).reshape(8, -1)
    return np.cumsum(planes.T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def smallest(array: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type that holds them."""
    return array.astype(np.min_scalar_type(int(array.max(initial=0))))


def sorted_distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and for each number which of them it is."""
    order = np.argsort(numbers)
    new = np.append(True, np.diff(numbers[order]) != 0)[: len(numbers)]
    which = np.empty(len(numbers), np.int64)
    which[order] = np.cumsum(new) - 1
    return numbers[order][new], which


class Grams:
    """N-grams of a chunk, level by level: ``hashes`` of the distinct ones in order, ``which`` of them ends at each word, or -1."""

    def __init__(self, vocabulary: np.ndarray, tokens: np.ndarray, count: np.ndarray, order: int):
        self.hashes, self.which = [vocabulary], [tokens.astype(np.int64)]
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(count) - count, count)
        for n in range(1, order):
            ends = np.flatnonzero(place >= n)
            pair = self.which[-1][ends - 1] * len(vocabulary) + self.which[0][ends]
            pairs, which = sorted_distinct(pair)
            hashed = mix(mix(self.hashes[-1][pairs // len(vocabulary)] + np.uint64(n)) + vocabulary[pairs % len(vocabulary)])
            by = np.argsort(hashed)
            moved = np.empty(len(by), np.int64)
            moved[by] = np.arange(len(by))
            at = np.full(len(tokens), -1)
            at[ends] = moved[which]
            self.hashes.append(hashed[by])
            self.which.append(at)

    def counts(self) -> list[np.ndarray]:
        return [np.bincount(w[w >= 0], minlength=len(h)) for h, w in zip(self.hashes, self.which, strict=True)]

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """All levels' hashes in one order, and that order over the levels behind each other."""
        every = np.concatenate(self.hashes)
        order = np.argsort(every, kind="stable")
        return every[order], order


def scores(grams: Grams, totals: list[np.ndarray], count: np.ndarray, words: int) -> np.ndarray:
    """Log score of each word of a chunk, from ``totals`` of the corpus's n-grams less those of the word's own document."""
    doc = np.repeat(np.arange(len(count)), count)
    left = []
    for which, total in zip(grams.which, totals, strict=True):
        valid = np.flatnonzero(which >= 0)
        _, own = sorted_distinct(doc[valid] * len(total) + which[valid])
        rest = np.zeros(len(which), np.int64)
        rest[valid] = total[which[valid]] - np.bincount(own)[own] if len(valid) else 0
        left.append(rest)
    out = np.log(np.maximum(left[0], 1) / np.maximum(words - count[doc], 1))
    for n in range(1, len(left)):
        out[grams.which[n] >= 0] += np.log(BACKOFF)
        found = np.flatnonzero(left[n] > 0)
        out[found] = np.log(left[n][found] / left[n - 1][found - 1])
    return out


CHUNK = "chunk long, count binary, vocabulary binary, tokens binary, words long"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in pieces(batches, "text", CHUNK_BYTES):
        # Hashed in small pieces: tables of powers as long as a chunk would stay in every worker, at 16 bytes for each byte of text.
        parts = [Words(part.column(1)) for part in pieces(iter([batch]), "text")]
        count = np.concatenate([words.count for words in parts]).astype(np.int64)
        hashes = np.concatenate([words.hash for words in parts])
        del parts
        vocabulary, tokens = sorted_distinct(hashes)
        ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
        row = [number, pack(count), pack_sorted(vocabulary), pack(smallest(tokens)), len(tokens)]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays([*[pa.array([x], t) for x, t in zip(row, types, strict=True)], ids], ["chunk", "count", "vocabulary", "tokens", "words", "ids"])
        number += 1


def _words(chunk: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = int.from_bytes(chunk["tokens"][:8], "little") // max(1, chunk["words"])
    return unpack_sorted(chunk["vocabulary"]), unpack(chunk["tokens"], np.dtype(f"u{raw}") if raw else np.uint8), unpack(chunk["count"], np.int64)


def _unpack_counts(blob: bytes, n: int) -> np.ndarray:
    return unpack(blob, np.dtype(f"u{int.from_bytes(blob[:8], 'little') // n}")).astype(np.int64)


def position_hashes(vocabulary: np.ndarray, tokens: np.ndarray, count: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of a chunk where they stand, length by length, equal to those of ``Grams``."""
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(count) - count, count)
    word = last = vocabulary[tokens]
    yield word
    for n in range(1, order):
        longer = np.zeros_like(last)
        longer[1:] = mix(mix(last[:-1] + np.uint64(n)) + word[1:])
        last = longer
        yield last[place >= n]


GRAMS = "gram long, chunk long, n long"
ANSWERS = "chunk long, grams binary, totals binary"


def _exploded(batches: Iterator[pa.RecordBatch], order: int, part: int) -> Iterator[pa.RecordBatch]:
    """A row for each distinct n-gram of each chunk with its count there, of those whose hashes lie in one of ``ROUNDS`` ranges."""
    lo, hi = (np.uint64((r << 64) // ROUNDS - (r > part)) for r in (part, part + 1))
    for batch in batches:
        for chunk in batch.to_pylist():
            every = [h[(h >= lo) & (h <= hi)] for h in position_hashes(*_words(chunk), order)]
            grams, counts = np.unique(np.concatenate(every), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(np.full(len(grams), chunk["chunk"])), pa.array(counts)], ["gram", "chunk", "n"])


def with_totals(grams: DataFrame) -> DataFrame:
    """Each n-gram of each chunk beside its count in the corpus, ``total``: count table and join in one exchange by hash.

    The group of an n-gram has a row a chunk at most.
    """
    return grams.withColumn("total", F.sum("n").over(Window.partitionBy("gram")))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers to the chunks, a row for each chunk in every ``PARTITION_GRAMS`` rows or so."""
    held, n = [], 0

    def rows() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        chunk, gram, total = (table.column(c).to_numpy() for c in ("chunk", "gram", "total"))
        by = np.lexsort((gram, chunk))
        chunk, gram, total = chunk[by], gram[by].view(np.uint64), total[by]
        edges = np.flatnonzero(np.diff(chunk)) + 1
        columns = [chunk[np.append(0, edges)], [pack_sorted(x) for x in np.split(gram, edges)], [pack(smallest(x)) for x in np.split(total, edges)]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["chunk", "grams", "totals"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= PARTITION_GRAMS:
            yield rows()
            held, n = [], 0
    if held:
        yield rows()


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of a query as soon as it has ended."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def score(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<id_col>, n_words, log_score, mean_score)``, a row for each row of ``docs``.

    A word's score is count(n-gram) / count(history) for the longest history of at most ``order`` - 1 words with which it was
    seen in another document, times 0.4 for each word by which the history is shorter than it could be. Counts are over all documents, less those of the
    scored one; a word that no other document has counts as seen once. ``log_score`` sums the natural logarithms, 0 for a text
    without words (null, empty), whose ``mean_score`` is null. Copies are documents of their own and so support each other, and repeated
    rows are scored each. A document longer than a chunk is a chunk of its own, in one task. Other columns of ``docs`` play no part,
    whatever their names. The scores are written to the shared folder, all other tables deleted.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([*T.StructType.fromDDL(CHUNK).fields, T.StructField("ids", T.ArrayType(rows.schema["id"].dataType))])
    path = scratch_path(spark, "lm-chunks")
    rows.mapInArrow(_chunks, schema).write.parquet(path)
    chunks = spark.read.schema(schema).parquet(path)
    words = chunks.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words * order // PARTITION_GRAMS // ROUNDS)

    answers = scratch_path(spark, "lm-totals")
    for part in range(ROUNDS):
        exploded = chunks.select("chunk", "count", "vocabulary", "tokens", "words").mapInArrow(lambda batches, part=part: _exploded(batches, order, part), GRAMS)
        shared = with_totals(exploded.repartition(partitions, "gram")).where("total > n").select("chunk", "gram", "total")
        with shuffles_end(spark):
            shared.mapInArrow(_packed, ANSWERS).write.mode("append").parquet(answers)
    found = spark.read.schema(ANSWERS).parquet(answers)

    def scored(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        row = chunk.drop_columns(["ids"]).to_pylist()[0]
        ids = chunk.column("ids").combine_chunks().flatten()
        vocabulary, tokens, count = _words(row)
        grams = Grams(vocabulary, tokens, count, order)
        hashes, by = grams.merged()
        merged = np.concatenate(grams.counts())[by]
        for answer in answers.to_pylist():
            asked = unpack_sorted(answer["grams"])
            merged[np.searchsorted(hashes, asked)] = _unpack_counts(answer["totals"], len(asked))
        every = np.empty(len(merged), np.int64)
        every[by] = merged
        each = np.split(every, np.cumsum([len(h) for h in grams.hashes])[:-1])
        value = np.concatenate([[0.0], np.cumsum(scores(grams, each, count, words))])
        first = np.cumsum(count) - count
        total = value[first + count] - value[first]
        mean = pa.array(total / np.maximum(count, 1), pa.float64(), mask=count == 0)
        return pa.table([ids, pa.array(count), pa.array(total), mean], [id_col, "n_words", "log_score", "mean_score"])

    out = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), *T.StructType.fromDDL("n_words long, log_score double, mean_score double").fields])
    result = scratch_path(spark, "lm-scores")
    for part in range(ROUNDS):
        mine = F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == part
        each = chunks.where(mine).groupBy("chunk").cogroup(found.where(mine).groupBy("chunk")).applyInArrow(scored, out)
        with shuffles_end(spark):
            each.write.mode("append").parquet(result)
    drop_folder(spark, path)
    drop_folder(spark, answers)
    return spark.read.schema(out).parquet(result)
