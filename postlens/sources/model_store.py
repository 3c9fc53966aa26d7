"""Trained models by what they were trained on: the same rows and parameters give the saved model, others train."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .snapshots import MARKER, _path


def fingerprint(rows: DataFrame, **params: Any) -> str:
    """A name for the rows of a table, in any order and partitioning, and for parameters.

    Rows are summed up by their number and by two independent 64-bit hashes, each added up without overflow; repeated rows count. One
    pass, and a few numbers for each task. Column names and types are part of it.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    hashes = [F.xxhash64(F.lit(seed), *[x for c in columns for x in (c.isNull(), c)]).cast("decimal(38,0)") for seed in (1, 2)]
    found = rows.agg(F.count("*"), *[F.coalesce(F.sum(h), F.lit(0)).cast("string") for h in hashes]).first()
    told = json.dumps([list(found), rows.dtypes, sorted(params.items())], default=str)
    return hashlib.sha256(told.encode()).hexdigest()


def stored_model(rows: DataFrame, store: str, train: Callable[..., PipelineModel], **params: Any) -> PipelineModel:
    """``train(rows, **params)``, or the model that was stored for equal rows and parameters below the folder ``store``.

    A model counts once its marker stands, which is written last, so a run that fails leaves none. Models stay until the caller deletes them.
    """
    spark = rows.sparkSession
    path = f"{store}/{fingerprint(rows, train=f'{train.__module__}.{train.__qualname__}', **params)}"
    marker = f"{path}-{MARKER}"
    files, mark = _path(spark, marker)
    if not files.exists(mark):
        model = train(rows, **params)
        model.write().overwrite().save(path)
        files.create(mark, True).close()
    return PipelineModel.load(path)
