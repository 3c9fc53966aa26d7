"""Near-duplicate classes by order MinHash and banded alignment.

The k-mers of a text are its runs of five words, labelled by how often the run occurred before, so that all are distinct. A sketch
takes the ``KEPT`` k-mers with the smallest values of a hash and keeps them in text order; two texts share it with the odds that they
agree in these k-mers and in their order. Texts with a sketch in common are candidates: each is compared with the first of those with
the same sketch, and then, block by block, with all of them to which that has not linked it. Similarity is that of an alignment of words: the
most labelled k-mers that both texts hold in the same order are its anchors, the words between two anchors are aligned by their longest common
subsequence, and the words matched are taken over all words of both less these. A band of diagonals holds every alignment that reaches
the threshold. One changed word so costs one word, though it spoils five k-mers. Equal texts (in words) are collapsed before, and linked
texts joined to classes after.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import with_old
from .components import components, kept, tidy
from .words import Words, mix, pieces, powers, runs

#: Words in a k-mer, sketches of a text, k-mers in a sketch.
K, SKETCHES, KEPT = 5, 32, 3
#: Least similarity of alike texts in words, and in k-mers. Texts whose similarity in k-mers is 0.8, 0.5, 0.45 share no sketch in about 10**-10, 0.014, 0.047 of cases.
SIMILARITY, RUN_SIMILARITY = 0.8, 0.45
PIECE = 1 << 20
#: k-mers in a block of texts with one sketch; texts and words in a product of two tables of them.
BLOCK_KMERS, TILE_TEXTS, TILE_WORDS = 1 << 17, 256, 1 << 12
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
_FACTORS = np.random.default_rng(8).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Kmers:
    """Labelled k-mers of the texts of a piece: ``value``, in text order; ``count`` of each text, ``first`` of each, ``digest`` of its words."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        hashes = words.hash
        self.count = np.where(words.count >= K, words.count - K + 1, np.minimum(words.count, 1))
        self.first = np.cumsum(self.count) - self.count
        doc = np.repeat(np.arange(len(self.count)), self.count)
        at = np.arange(len(doc)) - self.first[doc] + words.first[:-1][doc]
        run, up = runs(hashes, K), powers(K + 1)[0]
        value = run[np.minimum(at, max(0, len(run) - 1))] if len(run) else np.zeros(len(at), np.uint64)
        short = np.flatnonzero((words.count > 0) & (words.count < K))
        total = np.zeros(len(short), np.uint64)
        for i in range(K - 1):
            inside = words.count[short] > i
            total[inside] += hashes[words.first[:-1][short[inside]] + i] * up[i + 1]
        value[self.first[short]] = mix(total)
        self.value = self._labelled(value, doc)
        self.doc = doc
        self.digest = [self._sums(hashes, words), self._sums(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), words)]

    @staticmethod
    def _labelled(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Values that also tell the first, second, ... occurrence of the same run in its text apart."""
        key = value ^ mix(doc.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        same = np.append(False, key[order][1:] == key[order][:-1])[: len(key)]
        if not same.any():
            return value
        again = same | np.append(same[1:], False)
        members = order[again]
        members = members[np.lexsort((members, key[members]))]
        new = np.append(True, key[members][1:] != key[members][:-1])
        start = np.flatnonzero(new)[np.cumsum(new) - 1]
        value = value.copy()
        nth = (np.arange(len(members)) - start).astype(np.uint64)
        value[members] = np.where(nth > 0, mix(value[members] + nth), value[members])
        return value

    @staticmethod
    def _sums(hashes: np.ndarray, words: Words) -> np.ndarray:
        """A number for the sequence of words of each text."""
        up, down = powers(len(hashes) + 1)
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[:-1], out=total[1:])
        first, end = words.first[:-1], words.first[1:]
        return mix((total[end] - total[first]) * down[first] + words.count.astype(np.uint64))

    def sketches(self) -> np.ndarray:
        """A row of sketches for each text; that of a text without words means nothing."""
        filled = np.flatnonzero(self.count)
        out = np.zeros((len(self.count), SKETCHES), np.uint64)
        if not len(filled):
            return out
        starts, sizes = self.first[filled], self.count[filled]
        enough = [np.repeat(sizes > j, sizes) for j in range(1, KEPT)] if sizes.min() < KEPT else None
        for s, factor in enumerate(_FACTORS):
            hashed = self.value * factor
            at = np.full((KEPT, len(filled)), np.iinfo(np.int64).max)
            for j in range(KEPT):
                least = np.repeat(np.minimum.reduceat(hashed, starts), sizes) == hashed
                if j and enough is not None:
                    least &= enough[j - 1]
                found = np.flatnonzero(least)
                at[j, sizes > j] = found
                hashed[found] = _MOST
            at.sort(axis=0)
            total = np.full(len(filled), s + 1, np.uint64)
            for row in at:
                there = row < len(self.value)
                total[there] = mix(total[there] + self.value[row[there]])
            out[filled, s] = total
        return out


SKETCHED = "a long, b long, n long, sketches array<long>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a`` and ``b`` are a digest of the words, of the text itself if it has none, and null if it is null or empty."""
    for batch in pieces(batches, "text", PIECE):
        kmers = Kmers(batch.column("text"))
        rows = kmers.sketches().view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, SKETCHES), pa.int32()), pa.array(rows.ravel()))
        alike = [d.view(np.int64).copy() for d in kmers.digest]
        empty = np.zeros(batch.num_rows, bool)
        for i in np.flatnonzero(kmers.count == 0):
            raw = batch.column("text")[i].as_buffer() or b""
            empty[i] = not len(raw)
            for half, x in zip(alike, np.frombuffer(hashlib.md5(raw).digest(), np.int64), strict=True):
                half[i] = x
        new = [*[pa.array(d, mask=empty) for d in alike], pa.array(kmers.count, pa.int64()), lists]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *new], ["id", "key", "a", "b", "n", "sketches"])


def _word_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, words)``: the words of each text as 32-bit numbers in text order."""
    for batch in pieces(batches, "text", PIECE):
        words = Words(batch.column("text"))
        small = (words.hash >> np.uint64(32)).astype(np.uint32)
        blobs = [small[a:z].tobytes() for a, z in zip(words.first[:-1], words.first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(blobs, pa.binary())], ["node", "words"])


def numbered(values: np.ndarray) -> np.ndarray:
    """64-bit numbers that tell the first, second, ... occurrence of the same value apart."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)]
    at = np.arange(len(ranked))
    nth = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    out = np.empty(len(ranked), np.uint64)
    out[order] = np.where(nth > 0, mix(ranked + nth), ranked)
    return out


class Aligned:
    """The ``words`` of a text as numbers, its ``kmers`` and its ``bag``, the words told apart by how often they occurred before."""

    def __init__(self, words: np.ndarray):
        self.words = words
        wide = mix(words.astype(np.uint64) + np.uint64(1))
        self.bag = numbered(wide)
        self.kmers = numbered(runs(wide, K))


def common_words(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by one long number with a bit for each word of ``b``."""
    if not a or not b:
        return 0
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    whole = (1 << len(b)) - 1
    free = whole
    for x in a:
        hit = free & places.get(x, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & whole
    return len(b) - free.bit_count()


def _chain(a: np.ndarray, b: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of the longest run of matches within the band that rises in both; numbers are distinct within each."""
    order = np.argsort(b)
    place = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    j = order[place]
    i = np.flatnonzero(b[j] == a)
    j = j[i]
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if (np.diff(j) > 0).all():
        return i, j
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for at, x in enumerate(j.tolist()):
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
        ends[k : k + 1] = [at]
        before.append(ends[k - 1] if k else -1)
    path = []
    at = ends[-1]
    while at >= 0:
        path.append(at)
        at = before[at]
    return i[path[::-1]], j[path[::-1]]


def aligned(a: Aligned, b: Aligned) -> float:
    """Similarity of two texts in words, 0 if it is below ``SIMILARITY`` or that of their k-mers is below ``RUN_SIMILARITY``.

    An alignment that reaches the threshold leaves at most ``band`` words unmatched and so strays no further from the diagonal.
    """
    both = len(a.words) + len(b.words)
    band = int(both * (1 - SIMILARITY) / (1 + SIMILARITY) + 1e-9)
    least = (both - band) / 2
    if min(len(a.words), len(b.words)) < least or not len(a.kmers) or not len(b.kmers):
        return 0.0
    i, j = _chain(a.kmers, b.kmers, band)
    if len(i) < RUN_SIMILARITY * (len(a.kmers) + len(b.kmers) - len(i)) - 1e-9:
        return 0.0
    if len(np.intersect1d(a.bag, b.bag, assume_unique=True)) < least:
        return 0.0
    first = np.flatnonzero(np.append(True, (np.diff(i) > K) | (np.diff(j - i) != 0)))
    last = np.append(first[1:], len(i)) - 1
    matched = at_a = at_b = 0
    for x, y, size in zip(i[first].tolist(), j[first].tolist(), (i[last] - i[first] + K).tolist(), strict=True):
        late = max(0, at_a - x, at_b - y)
        if late < size:
            matched += common_words(a.words[at_a : x + late].tolist(), b.words[at_b : y + late].tolist()) + size - late
            at_a, at_b = x + size, y + size
    matched += common_words(a.words[at_a:].tolist(), b.words[at_b:].tolist())
    value = matched / (both - matched)
    return value if value >= SIMILARITY - 1e-12 else 0.0


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("words_lo"), batch.column("words_hi")
        values = np.array([aligned(*[Aligned(np.frombuffer(x[i].as_buffer(), np.uint32)) for x in (a, b)]) for i in range(batch.num_rows)])
        linked = pa.array(np.flatnonzero(values > 0))
        yield pa.RecordBatch.from_arrays([batch.column("lo").take(linked), batch.column("hi").take(linked), pa.array(values).take(linked)], ["lo", "hi", "similarity"])


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many words each of the texts ``a`` has in common with each of ``b``; words, with repeats told apart, are numbers from 0 on."""
    total = np.zeros((len(a), len(b)), np.float32)
    common = np.intersect1d(np.concatenate(a), np.concatenate(b))
    for at in range(0, len(common), TILE_WORDS):
        some = common[at : at + TILE_WORDS]
        tables = []
        for texts in (a, b):
            every = np.concatenate(texts)
            place = np.minimum(np.searchsorted(some, every), len(some) - 1)
            there = some[place] == every
            table = np.zeros((len(texts), len(some)), np.float32)
            np.add.at(table, (np.repeat(np.arange(len(texts)), [len(x) for x in texts])[there], place[there]), 1)
            tables.append(table)
        total += tables[0] @ tables[1].T
    return total


def block_links(node: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray, texts: list[Aligned]) -> list[tuple[int, int, float]]:
    """Links that join the labels of texts ``left`` and ``right`` (places in ``node``), which are the same places or have none in common.

    All pairs that have different labels, by then, are compared; those with too few common words for any alignment are not aligned.
    """
    sizes = np.array([len(x.words) for x in texts])
    _, which, times = np.unique(np.concatenate([x.bag for x in texts]), return_inverse=True, return_counts=True)
    held = [x[times[x] > 1] for x in np.split(which, np.cumsum(sizes)[:-1])]
    parent = {x: x for x in label.tolist()}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    same = left is right
    left, right = (x[np.argsort(label[x], kind="stable")] for x in (left, right))
    links = []
    for i in range(0, len(left), TILE_TEXTS):
        a = left[i : i + TILE_TEXTS]
        for j in range(i if same else 0, len(right), TILE_TEXTS):
            b = right[j : j + TILE_TEXTS]
            if label[a[0]] == label[a[-1]] == label[b[0]] == label[b[-1]]:
                continue
            least = SIMILARITY / (1 + SIMILARITY) * (sizes[a][:, None] + sizes[b][None, :]) - 1e-3
            near = (_overlaps([held[x] for x in a], [held[x] for x in b]) >= least) & (label[a][:, None] != label[b][None, :])
            for x, y in np.argwhere(np.triu(near, 1) if same and i == j else near):
                one, two = root(int(label[a[x]])), root(int(label[b[y]]))
                if one != two and (value := aligned(texts[a[x]], texts[b[y]])):
                    parent[max(one, two)] = min(one, two)
                    ends = sorted((int(node[a[x]]), int(node[b[y]])))
                    links.append((*ends, value))
    return links


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each two blocks; the rows of one (sketch, x, y) follow each other."""
    schema = pa.schema([("lo", pa.int64()), ("hi", pa.int64()), ("similarity", pa.float64())])

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        node, label, own = (rows.column(c).to_numpy() for c in ("node", "label", "own"))
        x, y = rows.column("x")[0].as_py(), rows.column("y")[0].as_py()
        left = np.flatnonzero(own == x)
        right = left if x == y else np.flatnonzero(own == y)
        texts = [Aligned(np.frombuffer(v.as_buffer(), np.uint32)) for v in rows.column("words")]
        links = block_links(node, label, left, right, texts) if len(left) and len(right) else []
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in links], schema=schema)

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("sketch", "x", "y")])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            if a == z:
                continue
            key = tuple(keys[:, a].tolist())
            if held and key != last:
                yield found(held)
                held = []
            held.append(batch.slice(a, z - a))
            last = key
    if held:
        yield found(held)


def row_key(id_col: str, text: str) -> Column:
    """A digest of the id and the text of a row; rows alike in both have the same."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("\n"), F.coalesce(F.concat(F.lit("t"), text), F.lit("")))))


def similar_texts(docs: DataFrame, texts: DataFrame, text: str, id_col: str) -> DataFrame:
    """Links ``(lo, hi, similarity)`` between the nodes of ``texts`` that join all candidates which reach the threshold.

    Each node is compared with the first of each of its sketches. What is of two labels after that and has a sketch in common is compared
    in blocks, so every pair of candidates is either compared or linked through others.
    """
    size_fits = F.least("n_lo", "n_hi") + (K - 1) >= SIMILARITY * (F.greatest("n_lo", "n_hi") + (K - 1))
    members = texts.select("node", "n", F.explode("sketches").alias("sketch"))
    centres = members.groupBy("sketch").agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("size")).where("size > 1")
    met = kept(members.join(kept(centres, "centres"), "sketch"), "met")
    ordered = met.where("node <> first.node").select(
        F.least("node", "first.node").alias("lo"), F.greatest("node", "first.node").alias("hi"),
        F.col("n").alias("n_lo"), F.col("first.n").alias("n_hi"),
    )
    pairs = kept(ordered.where(size_fits).select("lo", "hi").distinct(), "pairs")
    crowd = met.where("size > 2").select("sketch", "node", "n")
    nodes = pairs.select(F.explode(F.array("lo", "hi")).alias("node")).unionByName(crowd.select("node")).distinct()
    wanted = kept(texts.join(nodes, "node").select("node", F.col("best.key").alias("wanted")), "wanted")
    own_texts = docs.select(row_key(id_col, text).alias("own"), F.col(text).alias("text")).groupBy("own").agg(F.first("text").alias("text"))
    own_texts = own_texts.join(wanted, F.col("own") == F.col("wanted"))
    words = kept(own_texts.select("node", "text").mapInArrow(_word_bytes, "node long, words binary"), "words")
    both = pairs
    for end in ("lo", "hi"):
        both = both.join(words.withColumnsRenamed({"node": end, "words": f"words_{end}"}), end)
    links = kept(both.select("lo", "hi", "words_lo", "words_hi").mapInArrow(_verified, LINK), "links")
    return links.unionByName(kept(crowd_links(crowd, components(links), words), "links"))


LINK = "lo long, hi long, similarity double"


def crowd_links(crowd: DataFrame, label: DataFrame, words: DataFrame) -> DataFrame:
    """Links between nodes of ``crowd`` (sketch, node, n) that have a sketch in common and, by ``label``, no label.

    Of each sketch the nodes with the label of its first are the main ones, which are not compared with each other. The rest are dealt
    to blocks by a hash, and each block meets each other block and each block of main ones. Where one block holds all there is one.
    """
    crowd = crowd.join(label.select(F.col("hi").alias("node"), F.col("lo").alias("to")), "node", "left")
    crowd = kept(crowd.select("sketch", "node", "n", F.coalesce("to", "node").alias("label")), "crowd")
    held = crowd.groupBy("sketch", "label").agg(
        F.min("node").alias("node"), F.count("*").alias("size"), F.sum("n").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("a"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("b"),
    )
    buckets = held.groupBy("sketch").agg(
        F.min(F.struct("node", "label", "size", "n")).alias("main"), F.min("label").alias("least"), F.max("label").alias("most"),
        F.sum("size").alias("size"), F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
    )

    def blocks(size: Column, n: Column) -> Column:
        return F.least(size, F.ceil(n / BLOCK_KMERS)).cast("int")

    size, n, main = F.col("size"), F.col("n"), F.col("main")
    dealt = [blocks(size, n).alias("all"), blocks(size - main["size"], n - main["n"]).alias("rests"), blocks(main["size"], main["n"]).alias("mains")]
    once = buckets.where("least < most").groupBy("size", "a", "b").agg(F.min(F.struct("sketch", main["label"].alias("main"), *dealt)).alias("bucket"))
    crowd = crowd.join(once.select("bucket.*"), "sketch").withColumn("rest", F.col("label") != F.col("main"))
    turn = F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))).cast("int")
    crowd = crowd.withColumn("own", F.when(F.col("all") == 1, 0).when(F.col("rest"), turn).otherwise(-1 - turn))
    numbers = [F.sequence(F.lit(0), F.col(c) - 1) for c in ("rests", "mains")]
    meets = {
        "rest": F.transform(numbers[0], lambda j: F.struct(F.least("own", j).alias("x"), F.greatest("own", j).alias("y"))),
        "main": F.transform(numbers[1], lambda j: F.struct(F.col("own").alias("x"), (-1 - j).alias("y"))),
        "of main": F.transform(numbers[0], lambda i: F.struct(i.alias("x"), F.col("own").alias("y"))),
    }
    alone = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
    met = F.when(F.col("all") == 1, alone).when(F.col("rest"), F.concat(meets["rest"], meets["main"])).otherwise(meets["of main"])
    met = crowd.select("sketch", "node", "label", "own", F.explode(met).alias("met")).join(words, "node")
    met = met.select("sketch", "met.x", "met.y", "own", "node", "label", "words")
    return met.repartition("sketch", "x", "y").sortWithinPartitions("sketch", "x", "y").mapInArrow(_block_links, LINK)


@tidy
def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<id_col>, key, class_id, first)`` for each row of ``docs``: its near-duplicate class, named by the least id in it.

    Texts are alike from a similarity of 0.8 in aligned words on, if that of their runs of five words is 0.45 or more; a text of fewer
    words is one run, and only like its copies. Very long texts are compared whole. Linked texts are in one class,
    as are the texts linked to them. Other texts without words are in a class if they are equal, null and empty ones in no class but their own. ``key`` is
    a digest of id and text, and ``first`` marks the one key that stands for the class; rows alike in both have the same. A null id
    counts as larger than others. An empty table has no classes.
    """
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["id"], rows.schema["key"], *T.StructType.fromDDL(SKETCHED).fields])
    sketched = kept(rows.mapInArrow(_sketched, schema), "sketches")
    worded = sketched.where("n > 0")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("best")
    texts = worded.groupBy("a", "b").agg(best, F.first("n").alias("n"), F.first("sketches").alias("sketches"))
    texts = kept(texts.select(F.monotonically_increasing_id().alias("node"), "a", "b", "n", "sketches", "best"), "texts")
    label = components(similar_texts(docs, texts, text, id_col))
    named = texts.select("node", "a", "b", "best").join(label.select(F.col("hi").alias("node"), F.col("lo").alias("to")), "node", "left")
    named = kept(named.select("a", "b", "best", F.coalesce("to", "node").alias("label")), "labels")
    names = kept(named.groupBy("label").agg(F.min("best").alias("name")), "names")
    of_text = kept(named.join(names, "label").select("a", "b", "name"), "classes")
    wordless = sketched.where("n = 0 AND a IS NOT NULL").groupBy("a", "b").agg(best.alias("name"))
    found = sketched.where("a IS NOT NULL").join(of_text.unionByName(wordless), ["a", "b"])
    found = found.select(F.col("id").alias(id_col), "key", F.col("name.id").alias("class_id"), (F.col("key") == F.col("name.key")).alias("first"))
    alone = sketched.where("a IS NULL").select(F.col("id").alias(id_col), "key", F.col("id").alias("class_id"), F.lit(True).alias("first"))
    return found.unionByName(alone)


@tidy
def without_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each class, that of the least id. Rows with a null or empty text stay; of rows alike in id and text one does."""
    return with_old(docs, (id_col, text), lambda plain: _firsts(plain, id_col, text))


def _firsts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    chosen = kept(classes(docs, id_col, text).where("first").groupBy("key").agg(F.count("*").alias("n")), "chosen")
    keyed = docs.withColumn("__key", row_key(id_col, text))
    once = keyed.join(chosen.where("n = 1"), F.col("__key") == F.col("key"), "left_semi")
    if chosen.where("n > 1").isEmpty():
        return once.drop("__key")
    again = keyed.join(chosen.where("n > 1"), F.col("__key") == F.col("key"), "left_semi").dropDuplicates(["__key"])
    return once.unionByName(again).drop("__key")
