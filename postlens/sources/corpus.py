"""From XML documents and truth files to posts."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean_field, strip
from ..functions.text import UNICODE_SPACE
from ..schema import DOCUMENT, RAW_POSTS
from ..session import scratch_path


# A leaf may repeat and hold markup; its text comes as the pieces between the markup.
_LEAF = "array<struct<_VALUE: array<string>>>"
_FIELDS = DOCUMENT["WRITING"].dataType.elementType.fieldNames()
_PARSED = f"ID {_LEAF}, WRITING array<struct<{', '.join(f'{name}: {_LEAF}' for name in _FIELDS)}>>, broken string"

_WRITINGS = f"array<struct<{', '.join(f'{name}: string' for name in _FIELDS)}>>"

# The encodings of XML files that can be decoded, and how a file names its own.
ENCODINGS = ("UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16", "UTF-16BE", "UTF-16LE")
ENCODING = r"""^\s*<\?xml[^>]*encoding\s*=\s*["']([A-Za-z0-9._-]+)"""
HEAD_BYTES = 200


def _first_text(leaf: Column) -> Column:
    """The text of the first child of a name, up to markup inside it."""
    return F.get(F.get(leaf, 0)["_VALUE"], 0)


def parse_documents(df: DataFrame, col: str = "value") -> DataFrame:
    """Parse one XML document per row, whatever its root tag; malformed rows are dropped whole.

    Where an element repeats that is expected once, the first counts, and of an element with markup inside the
    text before the markup (that behind it if there is none before).
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    # A generator, so that the optimizer does not repeat the parsing for each filter above, that of a join on the id included.
    parsed = df.select(F.inline(F.array(F.from_xml(col, _PARSED, options)))).where("broken IS NULL")
    writing = F.transform(
        "WRITING", lambda w: F.struct(*[_first_text(w[name]).alias(name) for name in _FIELDS])
    )
    docs = parsed.select(_first_text(F.col("ID")).alias("ID"), writing.alias("WRITING"))
    return docs.where(F.col("ID").isNotNull())


def _declared(head: Column) -> Column:
    """The encoding that the head of a file declares, upper case; empty if none."""
    return F.upper(F.regexp_extract(head, ENCODING, 1))


def _refused(encoding: Column) -> Column:
    return F.raise_error(F.concat(F.lit("XML encoding not supported: "), encoding))


def _whole_files(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    content = spark.read.format("binaryFile").options(**options).load(path).select("content")
    head = F.decode(F.substring("content", 1, HEAD_BYTES), "ISO-8859-1")
    marks = F.hex(F.substring("content", 1, 2))
    encoding = F.when(marks.isin("FEFF", "FFFE"), "UTF-16").otherwise(_declared(head))
    value = F.when(encoding == "", F.decode("content", "UTF-8"))
    for name in ENCODINGS:
        value = value.when(encoding == name, F.decode("content", name))
    value = F.ltrim(value.otherwise(_refused(encoding)), F.lit("\ufeff"))
    return content.select(value.alias("value"))


def _packed_files(spark: SparkSession, path: str, options: dict[str, str], tag: str) -> DataFrame:
    end = f"</{tag}>"
    pieces = spark.read.options(**options).option("lineSep", end).text(path)
    encoding = _declared(F.substring(F.ltrim("value", F.lit("\ufeff")), 1, HEAD_BYTES))
    read = F.when(encoding.isin("", "UTF-8", "US-ASCII"), F.col("value")).otherwise(_refused(encoding))
    document = F.regexp_extract(read, rf"(?s).*(<{re.escape(tag)}[\s>].*)", 1)
    documents = pieces.select(F.explode(F.array(document)).alias("value"))
    return documents.where("value <> ''").select(F.concat("value", F.lit(end)).alias("value"))


def read_documents(spark: SparkSession, path: str, row_tag: str | None = None) -> DataFrame:
    """Documents from the ``*.xml`` files of a folder tree.

    Without ``row_tag`` a file is one document under any root tag, in the encoding it declares, and a file that
    does not parse is dropped whole. With it a file may hold many documents, each in an element of that name: the way to
    keep a large corpus, since it needs no file per user. Such a file is read in splits, cut behind each end tag, and a
    document that does not parse is dropped alone. The end tag is then written without blanks, the tag is not nested in
    itself, and the file is UTF-8; one that declares another encoding is an error.
    """
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.xml"}
    if row_tag is None:
        return parse_documents(_whole_files(spark, path, options))
    return parse_documents(_packed_files(spark, path, options, row_tag))


def read_documents_in_splits(spark: SparkSession, path: str) -> DataFrame:
    """What ``read_documents`` gives of files with one document each, of any size: ``(ID, WRITING)`` with a row for a few writings at a time.

    A file is cut behind each ``</WRITING>``, so many tasks share a large one. What stands outside the writings, the head with the id and the end tag, is put
    together for each file and must be well-formed without them, as must every writing; else the document is dropped whole. A document
    without writings gives no row. Files are UTF-8 (others are an error), the end tag is written without blanks and, as a text, in no
    comment or CDATA section. Writings are parsed once, at the call, into a table in the shared folder; what is
    shuffled is one row for each file.
    """
    end = "</WRITING>"
    pieces = spark.read.options(recursiveFileLookup="true", pathGlobFilter="*.xml").option("lineSep", end).text(path)
    order = F.struct(F.col("_metadata.file_block_start").alias("offset"), F.monotonically_increasing_id().alias("row"))
    encoding = _declared(F.substring(F.ltrim("value", F.lit("\ufeff")), 1, HEAD_BYTES))
    head = (F.col("order.offset") == 0) & ~encoding.isin("", "UTF-8", "US-ASCII")
    pieces = pieces.select(F.col("_metadata.file_path").alias("file"), order.alias("order"), "value")
    read = F.when(head, _refused(encoding)).otherwise(F.ltrim("value", F.lit("\ufeff")))
    hollow = F.lit(r"<WRITING(?:\s[^<>]*)?/>")
    cut = pieces.select("file", "order", F.regexp_count(read, hollow).alias("hollow"), F.regexp_replace(read, hollow, F.lit("")).alias("value"))
    cut = cut.withColumn("start", F.regexp_instr("value", F.lit(r"<WRITING[\s>]")))
    opened = F.col("start") > 0
    outside = F.when(opened, F.expr("substring(value, 1, start - 1)")).otherwise(F.col("value"))
    body = F.when(opened, F.concat(F.lit("<D>"), F.expr("substring(value, start)"), F.lit(f"{end}</D>")))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    fields = _PARSED.replace(f"ID {_LEAF}, ", "")
    parsed = cut.select("file", "order", opened.alias("opened"), outside.alias("outside"), "hollow", F.from_xml(body, fields, options).alias("d"))
    writing = F.transform("d.WRITING", lambda w: F.struct(*[_first_text(w[name]).alias(name) for name in _FIELDS]))
    nothing = F.struct(*[F.lit(None).cast("string").alias(name) for name in _FIELDS])
    writing = F.concat(F.coalesce(writing, F.array().cast(_WRITINGS)), F.array_repeat(nothing, F.col("hollow")))
    kept = scratch_path(spark, "writings")
    parsed.select("file", "order", "opened", "outside", F.col("d.broken").isNotNull().alias("broken"), writing.alias("WRITING")).write.parquet(kept)
    rows = spark.read.parquet(kept)

    told = (F.trim("outside") != "") | ~F.col("opened")
    rest = F.struct("order", "opened", "outside")
    files = rows.groupBy("file").agg(
        F.max("order").alias("last"),
        F.max_by("opened", "order").alias("unended"),
        # The last piece has no end tag behind it; a broken one there is told by being open.
        F.max(F.when(F.col("broken"), F.col("order"))).alias("broken"),
        F.array_sort(F.collect_list(F.when(told, rest))).alias("rest"),
    )
    closed = F.transform("rest", lambda r: F.when(r["opened"] | (r["order"] == F.col("last")), r["outside"]).otherwise(F.concat(r["outside"], F.lit(end))))
    frame = files.where("NOT unended AND broken IS NULL").select("file", F.concat_ws("", closed).alias("value"))
    known = frame.select("file", F.from_xml("value", _PARSED, options).alias("d")).where("d.broken IS NULL")
    ids = scratch_path(spark, "document-ids")
    known.select("file", _first_text(F.col("d.ID")).alias("ID")).where("ID IS NOT NULL").write.parquet(ids)
    writings = rows.where("size(WRITING) > 0").select("file", "WRITING")
    return writings.join(spark.read.schema("file string, ID string").parquet(ids), "file").select("ID", "WRITING")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """``(id, raw_label)`` from lines ``id label``; the last line of an id wins.

    Shorter lines are skipped and further tokens ignored; a missing file gives no rows. Line order
    is (file name, offset of the file split, row number within it), so files are read in
    splits and the choice of the last line is an aggregate with map-side combine.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "id string, raw_label string")
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("row"),
    )
    tokens = F.split(strip(F.col("value")), f"[{UNICODE_SPACE}]+")
    return (
        lines.select(tokens.alias("tokens"), order.alias("line"))
        .where(F.size("tokens") >= 2)
        .select(F.col("tokens")[0].alias("id"), F.col("tokens")[1].alias("raw_label"), "line")
        .groupBy("id")
        .agg(F.max_by("raw_label", "line").alias("raw_label"))
    )


def task_label(raw_label: Column, task: str) -> Column:
    """The class of a truth value: depression keeps it, anorexia turns 1 into 2 and the rest into 0."""
    value = raw_label.try_cast("int")
    if task == "depression":
        return value
    if task == "anorexia":
        return F.when(value == 1, 2).when(value.isNotNull(), 0)
    raise ValueError(f"unknown task {task!r}")


def flatten_documents(docs: DataFrame, truth: DataFrame, task: str) -> DataFrame:
    """One post per writing of every document whose user has a valid truth label.

    The join carries no broadcast hint: Spark broadcasts the truth table when its measured size
    allows and otherwise joins by shuffle, splitting a user with many documents at run time.
    """
    return _labelled_posts(docs, _task_labels(truth, task))


def _task_labels(truth: DataFrame, task: str) -> DataFrame:
    return truth.select("id", task_label(F.col("raw_label"), task).alias("label")).where(F.col("label").isNotNull())


def _labelled_posts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A post per writing and label of its user."""
    labelled = docs.withColumn("id", strip(F.col("ID"))).join(labels, "id").select("id", "label", F.explode("WRITING").alias("w"))
    return labelled.select(
        "id",
        clean_field(F.col("w.TITLE")).alias("title"),
        strip(F.col("w.DATE")).alias("date"),
        clean_field(F.col("w.TEXT")).alias("text"),
        strip(F.col("w.INFO")).alias("info"),
        "label",
    )


def build_corpus(
    spark: SparkSession, parts: Iterable[tuple[str, str, str]], row_tag: str | None = None
) -> DataFrame:
    """The bag union of the posts of several ``(documents path, truth path, task)``.

    Documents that several parts share are read and parsed once, and meet the labels of all those parts in one join.
    """
    labels: dict[str, DataFrame] = {}
    for documents, truth, task in parts:
        known = _task_labels(read_truth(spark, truth), task)
        labels[documents] = labels[documents].unionByName(known) if documents in labels else known
    corpus = None
    for documents, known in labels.items():
        posts = _labelled_posts(read_documents(spark, documents, row_tag), known)
        corpus = posts if corpus is None else corpus.unionByName(posts)
    if corpus is None:
        raise ValueError("a corpus needs at least one part")
    return corpus.select(*RAW_POSTS.fieldNames())
