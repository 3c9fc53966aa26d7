"""Saved models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession


def read_model(spark: SparkSession, path: str) -> PipelineModel:
    """Load a saved pipeline model; a path without one raises ``FileNotFoundError``, other faults stay as they are."""
    try:
        spark.read.text(f"{path}/metadata")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no model at {path}; train one first") from e
    return PipelineModel.load(path)
