"""Benchmark decontamination with an FM-index per shard of the training texts.

A task cuts its documents into shards of bounded size. The words of a shard, with a separator of its own behind each document, are
indexed: suffix array by prefix doubling, Burrows-Wheeler transform, wavelet matrix for ranks, and every
``SAMPLE``-th text position for locating. Every window of a benchmark item is searched backward in the index, its
occurrences are located, and the words they cover are merged to spans. Only one shard's index is in memory at a time.

Words are compared by 64-bit hashes; for a false hit the hash of a word of a window must be that of another word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import with_new
from .words import Words, extended, pieces, runs

#: Bytes of text in a shard, and each which text position is kept for locating.
SHARD_BYTES, SAMPLE = 3 << 20, 8
#: Bytes of benchmark text that are searched in one pass and so broadcast together, as windows of up to 13 numbers for each word.
PASS_BYTES = 4 << 20


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``symbols``, whose last one occurs nowhere else.

    Prefix doubling: suffixes are sorted by two symbols, and those that are still alike again by the ranks
    of what follows 2, 4, 8, ... symbols behind them.
    """
    n = len(symbols)
    after = np.zeros(n, np.int64)
    after[:-1] = symbols[1:] + 1
    key = symbols * (int(symbols.max(initial=0)) + 2) + after
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    slots, key = np.arange(n), key[order]
    reach = 2
    while len(slots):
        new = np.append(True, key[1:] != key[:-1])
        head = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        rank[order[slots]] = head
        alone = new & np.append(new[1:], True)
        slots = slots[~alone]
        suffixes = order[slots]
        beyond = suffixes + reach
        key = rank[suffixes] * (n + 1) + np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        by = np.argsort(key)
        order[slots], key = suffixes[by], key[by]
        reach *= 2
    return order


class FmIndex:
    """Backward search and locating over an array of symbols from 0 on; the last symbol occurs only there."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        self.transform = symbols[order - 1]
        top = int(symbols.max())
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        self.bits = range(max(1, top.bit_length()))[::-1]
        self.zeros, row = [], self.transform
        for b in self.bits:
            one = ((row >> b) & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            row = np.concatenate([row[~one], row[one]])
        sampled = order % SAMPLE == 0
        self.sampled = sampled
        self.sampled_before = np.cumsum(sampled) - 1
        self.positions = order[sampled]

    def rank(self, symbols: np.ndarray, *upto: np.ndarray) -> list[np.ndarray]:
        """How often each symbol stands in the transform before each place, down the wavelet matrix."""
        at = [np.zeros(len(symbols), np.int64), *upto]
        for b, zeros in zip(self.bits, self.zeros, strict=True):
            one = ((symbols >> b) & 1).astype(bool)
            at = [np.where(one, zeros[-1] + x - zeros[x], zeros[x]) for x in at]
        return [x - at[0] for x in at[1:]]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and end of the suffixes that begin with each row of ``phrases``."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.transform))
        alive = np.arange(len(phrases))
        for column in phrases.T[::-1]:
            symbol = column[alive]
            a, z = self.rank(symbol, low[alive], high[alive])
            low[alive], high[alive] = self.smaller[symbol] + a, self.smaller[symbol] + z
            alive = alive[a < z]
        return low, high

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes at ``places``: back to the next sampled one."""
        at, steps, out = places.copy(), np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        open_ = np.arange(len(places))
        while len(open_):
            known = self.sampled[at[open_]]
            ready = open_[known]
            out[ready] = self.positions[self.sampled_before[at[ready]]] + steps[ready]
            open_ = open_[~known]
            symbol = self.transform[at[open_]]
            at[open_] = self.smaller[symbol] + self.rank(symbol, at[open_])[0]
            steps[open_] += 1
        return out


def windows(items: pa.RecordBatch, window: int) -> tuple[list[np.ndarray], list[np.ndarray], list[str]]:
    """Distinct windows of items ``(id, text)`` by length, as rows of word hashes; for each, rows (window, item); the items' ids."""
    words = Words(items.column(1))
    hashes = words.hash
    ids = ["" if x is None else str(x) for x in items.column(0).to_pylist()]
    sizes = np.minimum(words.count, window)
    phrases, members = [], []
    for size in np.unique(sizes[sizes > 0]).tolist():
        items_of = np.flatnonzero(sizes == size)
        many = words.count[items_of] - size + 1
        item = np.repeat(items_of, many)
        at = np.arange(len(item)) + np.repeat(words.first[items_of] - (np.cumsum(many) - many), many)
        _, one, which = np.unique(runs(hashes, size)[at], return_index=True, return_inverse=True)
        phrases.append(hashes[at[one][:, None] + np.arange(size)])
        pairs = np.unique(which * len(ids) + item)
        members.append(np.stack([pairs // len(ids), pairs % len(ids)], axis=1))
    return phrases, members, ids


def hits_in_shard(words: Words, phrases: list[np.ndarray], members: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each word of a shard whether a window covers it; distinct rows (document, item)."""
    docs = len(words.first) - 1
    vocabulary, ids = np.unique(words.hash, return_inverse=True)
    covered = np.zeros(len(ids), bool)
    pairs = [np.zeros((0, 2), np.int64)]
    if not len(ids):
        return covered, pairs[0]
    symbols = np.empty(len(ids) + docs, np.int64)
    separators = words.first[1:] + np.arange(docs)
    is_word = np.ones(len(symbols), bool)
    is_word[separators] = False
    symbols[separators] = np.arange(docs)[::-1]
    symbols[is_word] = ids + docs
    index = FmIndex(symbols)
    doc_of = np.repeat(np.arange(docs), words.count + 1)
    edges = np.zeros(len(symbols) + 1, np.int64)
    for phrase, member in zip(phrases, members, strict=True):
        at = np.minimum(np.searchsorted(vocabulary, phrase), len(vocabulary) - 1)
        known = np.flatnonzero((vocabulary[at] == phrase).all(axis=1))
        low, high = index.search(at[known] + docs)
        count = np.maximum(high - low, 0)
        places = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        begin = index.locate(places)
        edges += np.bincount(begin, minlength=len(edges)) - np.bincount(begin + phrase.shape[1], minlength=len(edges))
        met = np.unique(np.repeat(known, count) * docs + doc_of[begin])
        doc, which = met % docs, met // docs
        order = np.argsort(member[:, 0], kind="stable")
        first = np.searchsorted(member[order, 0], which)
        many = np.searchsorted(member[order, 0], which, "right") - first
        rows = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        pairs.append(np.stack([np.repeat(doc, many), member[order[rows], 1]], axis=1))
    covered[:] = np.cumsum(edges)[:-1][is_word] > 0
    return covered, np.unique(np.concatenate(pairs), axis=0)


HITS = "n_words long, n_hit long, items array<string>, spans array<struct<first_word: bigint, end_word: bigint, first_byte: bigint, end_byte: bigint>>"


def _found(batches: Iterator[pa.RecordBatch], text: str, known: list, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    phrases, members, ids = known
    for batch in pieces(batches, text, shard_bytes):
        words = Words(batch.column(text))
        covered, pairs = hits_in_shard(words, phrases, members)
        edge = np.zeros(len(covered) + 1, bool)
        edge[1:] = covered
        begins = covered & (~edge[:-1] | np.isin(np.arange(len(covered)), words.first))
        first = np.flatnonzero(begins)
        stops = covered & ~np.append(covered[1:] & ~begins[1:], False)
        last = np.flatnonzero(stops)
        doc = words.doc[first]
        own = words.offsets[doc]
        spans = pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (first - words.first[doc], last + 1 - words.first[doc], words.begin[first] - own, words.end[last] - own)],
            ["first_word", "end_word", "first_byte", "end_byte"],
        )
        n = batch.num_rows
        span_of = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()), spans)
        n_hit = np.bincount(words.doc[covered], minlength=n)
        items: list[list[str]] = [[] for _ in range(n)]
        for d, item in pairs.tolist():
            items[d].append(ids[item])
        new = [pa.array(words.count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())), span_of]
        yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "n_words", "n_hit", "items", "spans"])


def _passes(benchmark: DataFrame, item_id: str, text: str, window: int, pass_bytes: int) -> Iterator[Broadcast]:
    """The items' windows in broadcasts of at most ``pass_bytes`` of text each, or of one item; items come to the driver one by one."""
    spark = benchmark.sparkSession
    rows, size = [], 0
    items = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))

    def shipped() -> Broadcast:
        return spark.sparkContext.broadcast(windows(pa.RecordBatch.from_pylist(rows, pa.schema([("id", pa.string()), ("text", pa.string())])), window))

    for row in items.toLocalIterator():
        if rows and size + len(row["text"]) > pass_bytes:
            yield shipped()
            rows, size = [], 0
        rows.append(row.asDict())
        size += len(row["text"])
    yield shipped()


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    shard_bytes: int = SHARD_BYTES,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_hit`` words inside a window of a benchmark item, ``items`` whose windows
    occur (ids as strings, sorted, distinct) and the merged ``spans`` of hit words, by word and by byte of the UTF-8 text.

    A window is ``window`` consecutive words of an item, or all words of a shorter one; an item without words has none.
    Null and empty texts have no words. Long texts are indexed whole. A benchmark beyond ``pass_bytes`` is searched in several passes over
    the documents, so that no broadcast grows with it; the passes' spans are then merged. An empty benchmark hits nothing. Columns
    of ``docs`` with one of the new names are replaced.
    """
    def searched(plain: DataFrame) -> DataFrame:
        schema = extended(plain.schema, HITS)
        out = None
        for known in _passes(benchmark, item_id, item_text, window, pass_bytes):
            found = plain.mapInArrow(lambda batches, known=known: _found(batches, text, known.value, shard_bytes), schema)
            out = found if out is None else _merged(out, found, plain.columns)
        return out

    return with_new(docs, (text,), searched)


def _merged(one: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Two passes over the same rows as one: rows meet by their content, equal rows of one pass have equal results."""
    key = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])))
    more = other.select(key.alias("k2"), F.col("items").alias("i2"), F.col("spans").alias("s2")).dropDuplicates(["k2"])
    both = one.withColumn("k1", key).join(more, F.col("k1") == F.col("k2"))
    merge = """aggregate(array_sort(concat(spans, s2)), CAST(array() AS ARRAY<STRUCT<first_word: BIGINT, end_word: BIGINT, first_byte: BIGINT, end_byte: BIGINT>>),
        (a, x) -> IF(size(a) > 0 AND x.first_word <= a[size(a) - 1].end_word,
            slice(a, 1, size(a) - 1) || array(named_struct('first_word', a[size(a) - 1].first_word, 'end_word', greatest(a[size(a) - 1].end_word, x.end_word),
                'first_byte', a[size(a) - 1].first_byte, 'end_byte', greatest(a[size(a) - 1].end_byte, x.end_byte))), a || array(x)))"""
    both = both.withColumn("spans", F.expr(merge)).withColumn("items", F.array_sort(F.array_union("items", "i2")))
    both = both.withColumn("n_hit", F.expr("aggregate(spans, 0L, (a, x) -> a + x.end_word - x.first_word)"))
    return both.select(*one.columns)


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit", share: int = 20):
    """Whether at least one word in ``share`` is hit."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * share >= F.col(n_words))


def without_spans(text: str = "text", spans: str = "spans"):
    """The text without the bytes of its spans."""
    gaps = f"""transform(sequence(0, size({spans})), i -> substring(encode({text}, 'UTF-8'),
        CAST(IF(i = 0, 0L, {spans}[i - 1].end_byte) + 1 AS INT),
        CAST(IF(i = size({spans}), octet_length({text}), {spans}[i].first_byte) - IF(i = 0, 0L, {spans}[i - 1].end_byte) AS INT)))"""
    return F.expr(f"decode(aggregate({gaps}, CAST('' AS BINARY), (a, x) -> concat(a, x)), 'UTF-8')")
