"""How filters interact: what each step of every order of five filters removes.

Two of the filters need counts of words and of different words. They are the row sums and the nonzero counts of a sparse matrix of
documents by terms, which is built in shards: each holds the rows of some documents in compressed form (``indptr``, ``indices``,
``counts``) over its own words, and the words carry their number in a dictionary of all texts. The dictionary gathers the words of
the shards, each once, so a shuffle moves words by shard and never by document.

A word's number is its 64-bit hash, which every shard can work out alone. The dictionary then proves that no two words share one;
those that do get numbers of their own, so numbers are one-to-one whatever the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import written
from .components import kept
from .words import pieces

#: Bytes of text in a shard, at most (or one text). A shard is a row and is held whole, by workers and by Spark, so it bounds the memory of a task.
SHARD_BYTES = 4 << 20
#: How the matrix is written: a writer or reader of Parquet holds a row group, of by default 100 rows and more, so each has one shard. Words of a
#: shard are different ones, a dictionary of Parquet for them only takes memory.
MATRIX_FILES = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary#words.list.element": "false"}
#: Words that share a hash, at most; 10**10 different words have about three pairs.
MOST_CLASHES = 10_000
# The filters, in order; each has the bit of its place in the set of failures of a document.
FILTERS = "ABCDE"
FAIL_A, FAIL_B = "n_words < 50", "100 * n_distinct < 65 * n_words"
FAIL_C = "100L * regexp_count(text, '[A-Z]') > 5L * char_length(text)"
FAIL_D, FAIL_E = "text rlike '[#$%&*|]'", "coalesce(doc_id > least, false)"


@contextmanager
def batches_of_a_shard(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark sends rows to workers in batches of a shard's bytes (or one row): a task holds a batch in Spark and in its worker."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(SHARD_BYTES))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def matrix_shards(docs: DataFrame) -> DataFrame:
    """``(shard, rows, words)``: documents by words, for ``docs`` with a column ``text``, which must not be null.

    ``rows`` has for each document its other columns, ``places`` of its words in ``words``, and ``counts`` of these. Lists of lists are compressed
    sparse rows in Arrow and Parquet: the offsets of the inner lists are the row pointers. Words are longest runs without ASCII white
    space. Write the shards before use: their numbers follow the tasks that made them.
    """
    own = [c for c in docs.columns if c != "text"]
    rows = docs.select("text", *own)
    row = T.StructType([*rows.schema.fields[1:], *T.StructType.fromDDL("places array<int>, counts array<int>")])
    schema = T.StructType().add("shard", "long").add("rows", T.ArrayType(row)).add("words", T.ArrayType(T.StringType()))

    def shard(number: int, piece: pa.RecordBatch, arrow: pa.Schema) -> pa.RecordBatch:
        split = pc.ascii_split_whitespace(piece.column("text").cast(pa.large_string()))
        found = pc.list_flatten(split)
        real = pc.not_equal(found, "")
        doc, coded = pc.list_parent_indices(split).filter(real).to_numpy(), found.filter(real).dictionary_encode()
        width = max(1, len(coded.dictionary))
        cells, counts = np.unique(doc.astype(np.int64) * width + coded.indices.to_numpy(), return_counts=True)
        pointers = pa.array(np.searchsorted(cells, np.arange(piece.num_rows + 1) * width), pa.int32())
        lists = [pa.ListArray.from_arrays(pointers, pa.array(v, pa.int32())) for v in (cells % width, counts)]
        fields = list(arrow.field("rows").type.value_type)
        columns = [c.cast(f.type) for c, f in zip([*piece.columns[1:], *lists], fields)]
        table, words = pa.StructArray.from_arrays(columns, fields=fields), coded.dictionary.cast(pa.string())
        whole = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v).cast(arrow.field(n).type) for n, v in (("rows", table), ("words", words))]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *whole], schema=arrow)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, arrow = TaskContext.get().partitionId() << 32, to_arrow_schema(schema)
        for i, piece in enumerate(pieces(batches, "text", SHARD_BYTES)):
            yield shard(first + i, piece, arrow)  # what it holds besides the shard goes before the next

    return rows.mapInArrow(shards, schema)


def dictionary(shards: DataFrame, number: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``(word, id)``, a row for each word of the shards; ``id`` is ``number`` of the word. Each shard sends a word once."""
    return shards.select(F.explode("words").alias("word")).distinct().select("word", number(F.col("word")).alias("id"))


def numbered_apart(words: DataFrame) -> dict[str, int]:
    """Ids of their own for the words of a dictionary that share an id with another, counted down from -1; as a rule there are none.

    An id in that range is not used as it is.
    """
    met = words.groupBy("id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("id").between(-MOST_CLASHES, -1))
    ids = [r.id for r in met.select("id").limit(MOST_CLASHES + 1).collect()]
    clashing = words.where(F.col("id").isin(ids)).select("word").orderBy("word").limit(MOST_CLASHES + 1).collect() if ids else []
    if len(clashing) > MOST_CLASHES:
        raise ValueError(f"more than {MOST_CLASHES} words share a number")
    return {r.word: -1 - i for i, r in enumerate(clashing)}


def term_matrix(shards: DataFrame, words: DataFrame, number: Callable[[Column], Column] = F.xxhash64) -> tuple[DataFrame, DataFrame]:
    """The shards with ``ids``, the numbers of their words, and the dictionary ``(word, id)``, in which no two words have one number."""
    apart = numbered_apart(words)
    if not apart:
        return shards.withColumn("ids", F.transform("words", lambda w: number(w))), words
    own = F.create_map(*[F.lit(x) for pair in apart.items() for x in pair])
    ids = F.transform("words", lambda w: F.coalesce(F.try_element_at(own, w), number(w)))
    return shards.withColumn("ids", ids), words.select("word", F.coalesce(F.try_element_at(own, F.col("word")), F.col("id")).alias("id"))


def row_counts(matrix: DataFrame) -> DataFrame:
    """The columns handed on with ``n_words``, the sum of each row of the matrix, and ``n_distinct``, the number of its entries.

    Numbers are one-to-one, so an entry of a row is a different word.
    """
    each = matrix.select(F.explode("rows").alias("r")).select("r.*")
    n_words = F.aggregate("counts", F.lit(0).cast("long"), lambda total, n: total + n)
    return each.select("*", n_words.alias("n_words"), F.size("counts").cast("long").alias("n_distinct")).drop("places", "counts")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, fails, good, toxic, n)``: documents by source, set of filters they fail, and labels; written to the shared folder.

    ``docs`` has ``doc_id``, ``text`` and ``source``, ``labels`` has ``doc_id``, ``quality`` and ``toxic``. A null text is empty, a null source is the part
    of an empty one. Copies are texts with one SHA-256; a row without an id is never a later copy and has no labels, rows of one id
    are not later than each other. Of several labels of an id one that says good, or toxic, is enough. Whole texts count.

    The least id of each group of copies and the labels are tables of their own, so that both sides of a join come from an exchange
    and Spark can split the rows of a text, or of missing ids, that very many documents have.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "part", F.expr(FAIL_C).alias("c"), F.expr(FAIL_D).alias("d"), F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    with batches_of_a_shard(docs.sparkSession), written(matrix_shards(rows), "matrix", MATRIX_FILES) as shards, written(dictionary(shards), "dictionary") as words:
        matrix, _ = term_matrix(shards, words)
        each = row_counts(matrix)
        copies = each.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
        with written(copies, "copies") as copies, written(marks, "marks") as marks:
            told = each.join(copies, "digest", "left").join(marks, "doc_id", "left")
            fails = sum(F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate((F.expr(FAIL_A), F.expr(FAIL_B), F.col("c"), F.col("d"), F.expr(FAIL_E))))
            known = [F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")]
            return kept(told.select("part", fails.alias("fails"), *known).groupBy("part", "fails", "good", "toxic").agg(F.count("*").alias("n")), "failures")


def interactions(counts: DataFrame) -> DataFrame:
    """What every step of every order of the filters does in each part, from the counts of ``failures``.

    ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``: documents that stay after the step, that
    it removes, that fail its filter but are gone before, that fail its filter alone; removed ones labelled good, or toxic; and what its
    filter removes in all orders together. A document that fails k filters is removed by each of them in one k-th of the orders. No
    documents give no rows.
    """
    sets = range(1 << len(FILTERS))

    def by_set(rows: Column) -> Column:
        return F.array(*[F.sum(F.when((F.col("fails") == m) & rows, F.col("n")).otherwise(0)) for m in sets])

    parts = counts.groupBy("part").agg(by_set(F.lit(True)).alias("every"), by_set(F.col("good")).alias("good"), by_set(F.col("toxic")).alias("toxic"))
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = f"shiftleft(1, instr('{FILTERS}', {{}}) - 1)"
    steps = steps.withColumn("own", F.expr(bit.format("substr(filter_order, step, 1)")))
    steps = steps.withColumn("before", F.expr(f"aggregate(split(left(filter_order, step), ''), 0, (s, f) -> s | {bit.format('f')}) - own"))

    def documents(column: str, condition: str, times: str = "1L") -> Column:
        return F.expr(f"aggregate({column}, named_struct('total', 0L, 'm', 0), (s, n) -> named_struct('total', s.total + IF({condition}, n * {times}, 0L), 'm', s.m + 1), s -> s.total)")

    here = "s.m & own <> 0 AND s.m & before = 0"
    return steps.select(
        "part", "filter_order", "step",
        documents("every", "s.m & (own | before) = 0").alias("kept"),
        documents("every", here).alias("removed"),
        documents("every", "s.m & own <> 0 AND s.m & before <> 0").alias("redundant"),
        documents("every", "s.m = own").alias("unique_fails"),
        documents("good", here).alias("good_lost"),
        documents("toxic", here).alias("toxic_lost"),
        documents("every", "s.m & own <> 0", "CAST(120 div bit_count(s.m) AS BIGINT)").alias("shapley"),
    )
