"""Columns that an operator only hands on, whatever their names are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Build = Callable[[DataFrame], DataFrame]


def _plain(docs: DataFrame, used: tuple[str, ...]) -> list[str]:
    """Names of the columns, with numbers for those that are not ``used``: they clash with none and hold no dots."""
    known = {c.lower() for c in used}
    return [c if c.lower() in known else f"__{i}" for i, c in enumerate(docs.columns)]


def with_new(docs: DataFrame, used: tuple[str, ...], build: Build) -> DataFrame:
    """``build`` of ``docs``: the old columns it hands on under their names, except those whose name a new one has, and the new ones."""
    plain = _plain(docs, used)
    made = build(docs.toDF(*plain))
    new = [c for c in made.columns if c not in plain]
    taken = {c.lower() for c in new}
    old = [F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True) if p in made.columns and c.lower() not in taken]
    return made.select(*old, *new)


def with_old(docs: DataFrame, used: tuple[str, ...], build: Build) -> DataFrame:
    """The rows of ``build`` of ``docs`` with the columns of ``docs``, as they were."""
    plain = _plain(docs, used)
    made = build(docs.toDF(*plain))
    return made.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)])
