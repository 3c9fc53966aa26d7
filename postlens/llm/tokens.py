"""Token counts: an exact histogram of encoded lengths, and what follows from it for every context limit.

A document is encoded once and only its length stays. The histogram has one row for each length that occurs, and its
running sums answer how many documents and tokens a context limit keeps, at every limit, without another look at the texts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import with_new

#: Fixed value: the pattern that the public byte-level vocabularies split text with before they merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths in a block of the running sums.
BLOCK = 1024


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(docs: DataFrame, vocabulary: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """The other columns of ``docs`` with ``name``, the number of tokens of ``text``; a null text has none.

    ``vocabulary``: path, on the driver, of a rank file; its bytes (under 1 MB for the public ones) go to the tasks.
    Whole texts are encoded, and strings of special tokens are ordinary text.
    """
    with open(vocabulary, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def build(plain: DataFrame) -> DataFrame:
        return _counted(plain, ranks, text, name)

    return with_new(docs, (text,), build)


def _counted(docs: DataFrame, ranks: Broadcast, text: str, name: str) -> DataFrame:
    kept = [c for c in docs.columns if c.lower() != text.lower()]
    rows = docs.select(*kept, F.col(text).alias("__text"))
    schema = rows.drop("__text").schema.add(name, "long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks.value).encode_ordinary
        for batch in batches:
            lengths = pa.array([len(encode(t)) if t else 0 for t in (x.as_py() for x in batch.column(len(kept)))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], lengths], [*kept, name])

    return rows.mapInArrow(counted, schema)


def length_histogram(counts: DataFrame, name: str = "n_tokens") -> DataFrame:
    """``(n_tokens, documents)``: how many documents have each length; summed in the tasks before the shuffle."""
    return counts.groupBy(F.col(name).alias("n_tokens")).agg(F.count("*").alias("documents"))


def limits(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, as a context limit, what it keeps.

    ``documents`` of that length, ``documents_within`` and ``documents_longer`` than it, ``share_within`` (so the length is the
    quantile of every share up to it), ``tokens_within`` of the documents it holds whole, ``tokens_kept`` if longer ones are
    truncated, ``tokens_cut`` by that. A limit L between two lengths a < b keeps tokens_kept(a) + (L - a) * documents_longer(a).
    The sums have two levels, blocks of lengths and lengths in a block. An empty histogram gives no rows.
    """
    h = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("documents"))
    blocks = h.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    everything = Window.partitionBy()
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    blocks = blocks.select("block", before("d").alias("d0"), before("t").alias("t0"), F.sum("d").over(everything).alias("d1"), F.sum("t").over(everything).alias("t1"))
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    h = h.withColumn("d", F.sum("documents").over(inside)).withColumn("t", F.sum("tokens").over(inside)).join(blocks, "block")
    within, tokens = F.col("d0") + F.col("d"), F.col("t0") + F.col("t")
    longer = F.col("d1") - within
    kept = tokens + F.col("n_tokens") * longer
    return h.select(
        "n_tokens", "documents", within.alias("documents_within"), longer.alias("documents_longer"), (within / F.col("d1")).alias("share_within"),
        tokens.alias("tokens_within"), kept.alias("tokens_kept"), (F.col("t1") - kept).alias("tokens_cut"),
    )


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """``(share, n_tokens)``: the smallest length within which lies ``share`` of the documents of a table of limits."""
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    return table.select(wanted, "n_tokens", "share_within").where("share_within >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
