"""Posts per label over a folder that files keep arriving in."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_posts
from ..schema import LABEL_COUNTS, RAW_POSTS
from ..sources.posts import csv_read_options
from ..sources.snapshots import read_version, write_version


def stream_posts(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Raw posts from the CSV files of ``path``, at most ``max_files`` to a micro-batch."""
    reader = spark.readStream.schema(RAW_POSTS).options(**csv_read_options())
    return reader.option("maxFilesPerTrigger", max_files).csv(path)


def running_label_counts(raw: DataFrame) -> DataFrame:
    """Posts per valid label. The state is one counter per label."""
    return clean_posts(raw).groupBy("label").count()


def stream_label_counts(
    spark: SparkSession,
    source: str,
    name: str = "real_time_counts",
    checkpoint: str | None = None,
    trigger: dict[str, Any] | None = None,
    max_files: int = 1,
    state_partitions: int = 4,
) -> StreamingQuery:
    """Start the running count into the in-memory table ``name``, one row per label.

    With ``checkpoint`` a restarted query goes on from its counts. ``trigger`` takes the arguments
    of ``DataStreamWriter.trigger``, such as ``{"availableNow": True}``. For another sink, write
    ``running_label_counts(stream_posts(...))`` over a ``stream_session``.
    """
    own = stream_session(spark, state_partitions)
    counts = running_label_counts(stream_posts(own, source, max_files))
    writer = counts.writeStream.outputMode("complete").format("memory").queryName(name)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    query = writer.start()
    # The sink's table belongs to the stream's session; a global view carries it over to the caller's.
    own.table(name).createOrReplaceGlobalTempView(name)
    shared = own.conf.get("spark.sql.globalTempDatabase", "global_temp")
    spark.table(f"{shared}.`{name}`").createOrReplaceTempView(name)
    return query


def stream_session(spark: SparkSession, state_partitions: int = 4) -> SparkSession:
    """A session of its own for a running count, with few state partitions.

    Each scan task sends one row per label, so the session's number of shuffle partitions,
    meant for large shuffles, would only add empty state files to every micro-batch. The setting of ``spark`` itself,
    which other threads may be planning with, stays as it is.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def read_counts(spark: SparkSession, name: str = "real_time_counts") -> DataFrame:
    """The current counts; no rows while the stream has not started."""
    try:
        return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})
    except AnalysisException as e:
        if e.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        return spark.createDataFrame([], LABEL_COUNTS)


def save_counts(batch: DataFrame, number: int, path: str) -> None:
    """Put the changed counts of micro-batch ``number`` into the saved ones, as a new version of a table of one row per label.

    The base is the newest version before ``number``, so a micro-batch that is repeated after a fault gives the same version again. Readers
    meet whole versions only, and all but the two newest are deleted.
    """
    spark = batch.sparkSession
    changed = batch.select(*LABEL_COUNTS.fieldNames())
    before = read_version(spark, path, "counts", number)
    if before is not None:
        changed = before.join(changed, "label", "left_anti").unionByName(changed)
    write_version(spark, path, number, {"counts": changed.coalesce(1)})


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    """The counts up to the newest micro-batch that ``save_counts`` finished; no rows while there is none."""
    saved = read_version(spark, path, "counts")
    return spark.createDataFrame([], LABEL_COUNTS) if saved is None else saved


def save_label_counts(
    spark: SparkSession, source: str, out: str, checkpoint: str, trigger: dict[str, Any] | None = None, max_files: int = 1
) -> StreamingQuery:
    """Start the running count into the saved table ``out``, which outlives the session; ``read_saved`` reads it.

    A micro-batch hands on only the labels that it changed. The query goes on where it stopped, from its checkpoint.
    """
    own = stream_session(spark)
    counts = running_label_counts(stream_posts(own, source, max_files))
    writer = counts.writeStream.outputMode("update").foreachBatch(lambda batch, number: save_counts(batch, number, out))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer if trigger is None else writer.trigger(**trigger)).start()
