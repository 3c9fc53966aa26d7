"""Schemas and the label dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A posts file as written: every column is text.
RAW_POSTS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("id", "title", "date", "text", "info", "label")
    ]
)

# One source document: a user id and that user's writings.
DOCUMENT = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField(
            "WRITING",
            T.ArrayType(
                T.StructType(
                    [T.StructField(name, T.StringType()) for name in ("TITLE", "DATE", "TEXT", "INFO")]
                )
            ),
        ),
    ]
)

TOPICS = T.StructType(
    [T.StructField("topic_id", T.IntegerType()), T.StructField("terms", T.StringType())]
)

IMPORTANCE = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("coefficient", T.DoubleType()),
        T.StructField("class", T.StringType()),
    ]
)

LABEL_COUNTS = T.StructType(
    [T.StructField("label", T.IntegerType()), T.StructField("count", T.LongType())]
)

# The display name of each class.
LABEL_NAMES = {0: "Control (Sani)", 1: "Depression", 2: "Anorexia"}


def label_name(label: Column) -> Column:
    """Display name of an integer or text label; unknown labels give NULL."""
    names = F.create_map(*[F.lit(part) for pair in LABEL_NAMES.items() for part in pair])
    return F.try_element_at(names, label.try_cast("int"))


def with_label_name(df: DataFrame, col: str = "label") -> DataFrame:
    return df.withColumn("label_name", label_name(F.col(col)))


def label_dimension(spark: SparkSession) -> DataFrame:
    """The label dimension as a table, for joins written in SQL."""
    rows = ", ".join(f"({value}, '{name}')" for value, name in LABEL_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS names(label, label_name)")
