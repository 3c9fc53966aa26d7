"""Delete later copies of runs of lines, with a suffix array over line ids by distributed prefix doubling.

The lines of all documents are sequences of line ids. Round k ranks the suffixes by their first 2 ** k lines: pairs of ranks 2 ** (k - 1)
lines apart are counted, range-sorted and numbered in that order, so that equal ranks are equal prefixes and ranks sort like suffixes. A suffix
whose prefix occurs once leaves the array, as no repeated run begins with it.

The suffixes that agree in their first m lines are an interval of the array with a longest common prefix of m or more, found as those with the same
pair of overlapping ranks. A run counts if it has ``min_words`` words, so for each line two intervals are asked for: that of
the shortest such run which begins with the line, and of the shortest which ends with it. Members of an interval behind its first are later
copies. Every line of a longer repeated run lies in one of these shortest runs, so the union of the copies is that of the maximal runs.
All steps are DataFrame and SQL functions, and each round is a table in the shared folder. Joins are sort-merge joins at every size: the tables
grow with the documents, and Spark splits the partitions of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import with_new
from .components import kept, tidy

#: Fixed value: what separates lines.
LINE_END = "\n"


def _ranked(keys: DataFrame, *columns: str) -> DataFrame:
    """``rank`` of each row of ``keys``, growing with ``columns``: partition and place in it after a range sort."""
    sorted_ = keys.repartitionByRange(*columns).sortWithinPartitions(*columns)
    return kept(sorted_.select(*columns, F.monotonically_increasing_id().alias("rank")), "ranks")


def _repeated(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1").select(*columns)


def _shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """``(row, start, size)``: for each line of ``lines`` the shortest runs of ``min_words`` words that begin and that end with it.

    Every line has a word, so ``min_words`` lines are enough.
    """
    island = Window.partitionBy("row").orderBy("x")
    lines = lines.withColumn("island", F.col("x") - F.row_number().over(island))
    order = Window.partitionBy("row", "island").orderBy("x")
    enough = f"""aggregate(%s, named_struct('words', 0L, 'size', 0),
        (a, w) -> IF(a.words >= {min_words}, a, named_struct('words', a.words + w, 'size', a.size + 1)))"""
    lines = lines.withColumn("on", F.collect_list("words").over(order.rowsBetween(0, min_words - 1)))
    lines = lines.withColumn("back", F.reverse(F.collect_list("words").over(order.rowsBetween(1 - min_words, 0))))
    lines = lines.withColumn("f", F.expr(enough % "on")).withColumn("b", F.expr(enough % "back"))
    begin = lines.where(f"f.words >= {min_words}").selectExpr("row", "x AS start", "f.size AS size")
    end = lines.where(f"b.words >= {min_words}").selectExpr("row", "x - b.size + 1 AS start", "b.size AS size")
    return begin.unionByName(end).distinct()


def _copies(runs: DataFrame, ranks: DataFrame, reach: int) -> DataFrame:
    """``(row, first, last)`` of the runs of ``reach`` to 2 * ``reach`` - 1 lines that occur before, by two ranks of ``reach`` lines."""
    one = ranks.select("row", F.col("x").alias("start"), F.col("rank").alias("r1"))
    two = ranks.select("row", F.col("x").alias("rest"), F.col("rank").alias("r2"))
    ranked = runs.where(F.col("size").between(reach, 2 * reach - 1)).withColumn("rest", F.col("start") + F.col("size") - reach)
    ranked = kept(ranked.join(one.hint("merge"), ["row", "start"]).join(two.hint("merge"), ["row", "rest"]), "runs")
    interval = ["size", "r1", "r2"]
    place = F.struct("row", "start")
    heads = ranked.groupBy(*interval).agg(F.min(place).alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    return ranked.join(kept(heads, "heads").hint("merge"), interval).where(place > F.col("head")).selectExpr("row", "start AS first", "start + size - 1 AS last")


def _merged(spans: Column | str) -> Column:
    return F.expr(f"""aggregate(array_sort({spans}), CAST(array() AS ARRAY<STRUCT<first: INT, last: INT>>),
        (a, x) -> IF(size(a) > 0 AND x.first <= a[size(a) - 1].last + 1,
            slice(a, 1, size(a) - 1) || array(named_struct('first', a[size(a) - 1].first, 'last', greatest(a[size(a) - 1].last, x.last))), a || array(x)))""")


@tidy
def without_repeated_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with later copies of repeated runs of lines deleted from ``text``; ``n_lines`` it had and ``removed`` spans (first, last).

    A run is one or more lines with ``min_words`` words or more together; lines are equal if they are so without blanks at their ends. Blank
    lines do not interrupt a run, and go if both their neighbours do. Copies within a text and across texts count alike, also where they overlap; the first is that of the
    least id (null last, then by the digest of the text). A text all of whose lines are copies becomes empty. Null texts stay null. Rows alike
    in id and text are one document and get the same result. Columns with one of the new names are replaced.
    """
    return with_new(docs, (id_col, text), lambda plain: _cleaned(plain, min_words, id_col, text))


def _cleaned(docs: DataFrame, min_words: int, id_col: str, text: str) -> DataFrame:
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(LINE_END), F.col(text)))
    line = "struct(i AS line, xxhash64(trim(BOTH ' \\t\\r' FROM l)) AS a, xxhash64(7, trim(BOTH ' \\t\\r' FROM l)) AS b, regexp_count(l, '\\\\S+') AS words)"
    lines = F.expr(f"filter(transform(split(__text, '\\n', -1), (l, i) -> {line}), s -> s.words > 0)")
    rows = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), key.alias("key"), F.col(text).alias("__text"))
    rows = rows.select("id", "key", lines.alias("lines")).groupBy("key").agg(F.first("id").alias("id"), F.first("lines").alias("lines"))
    rows = rows.repartitionByRange(F.col("id").asc_nulls_last(), "key").sortWithinPartitions(F.col("id").asc_nulls_last(), "key")
    rows = kept(rows.select(F.monotonically_increasing_id().alias("row"), "key", "lines"), "lines")

    every = rows.select("row", F.posexplode("lines").alias("x", "l")).select("row", "x", "l.a", "l.b", "l.words")
    ids = _ranked(_repeated(every, "a", "b"), "a", "b")
    active = kept(every.join(ids.hint("merge"), ["a", "b"]).select("row", "x", F.col("words").cast("long").alias("words"), "rank"), "suffixes")
    runs = kept(_shortest_runs(active.drop("rank"), min_words), "shortest")
    ranks, reach, copies = active.select("row", "x", "rank"), 1, []
    while True:
        copies.append(kept(_copies(runs, ranks, reach), "copies"))
        if 2 * reach > min_words:
            break
        behind = Window.partitionBy("row").orderBy("x").rangeBetween(reach, reach)
        pairs = kept(ranks.withColumn("next", F.max("rank").over(behind)).where("next IS NOT NULL").withColumnRenamed("rank", "own"), "pairs")
        numbers = _ranked(_repeated(pairs, "own", "next"), "own", "next")
        ranks, reach = kept(pairs.join(numbers.hint("merge"), ["own", "next"]).select("row", "x", "rank"), "suffixes"), 2 * reach

    found = copies[0]
    for more in copies[1:]:
        found = found.unionByName(more)
    spans = found.distinct().groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans")).withColumn("spans", _merged("spans"))
    numbered = F.expr("transform(spans, s -> named_struct('first', lines[s.first].line, 'last', lines[s.last].line))")
    spans = kept(spans.join(rows.hint("merge"), "row").select(F.col("key").alias("__of"), numbered.alias("removed")), "spans")
    lines = f"split(`{text}`, '\\n', -1)"
    rest = F.expr(f"array_join(filter({lines}, (l, i) -> NOT exists(removed, s -> i BETWEEN s.first AND s.last)), '\\n')")
    out = docs.withColumn("__key", key)
    out = out.join(spans.hint("merge"), F.col("__key") == F.col("__of"), "left").drop("__key", "__of").withColumn("n_lines", F.expr(f"size({lines})"))
    return out.withColumn(text, F.when(F.col("removed").isNull(), F.col(text)).otherwise(rest)).withColumn("removed", F.coalesce("removed", F.array()))
