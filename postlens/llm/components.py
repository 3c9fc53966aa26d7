"""Connected components of links, by alternating stars."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_folder, scratch_path

_made = threading.local()
#: Edges that a task of a round handles, and tasks at least: small rounds do not start a task for each shuffle partition.
EDGES_PER_TASK, LEAST_TASKS = 200_000, 8


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, which cuts its lineage. Inside a ``tidy`` function it goes with the end of that, unless its result reads it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if getattr(_made, "paths", None) is not None:
        _made.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(build: Callable[..., Any]) -> Callable[..., Any]:
    """``build`` with the tables that it wrote by ``kept`` deleted at its end, but for those that the DataFrame it returns reads."""

    @wraps(build)
    def tidied(df: DataFrame, *args: Any, **options: Any) -> Any:
        outer, _made.paths = getattr(_made, "paths", None), []
        needed: set[str] = set()
        try:
            result = build(df, *args, **options)
            if isinstance(result, DataFrame):
                files = {part for file in result.inputFiles() for part in file.split("/")}
                needed = {path for path in _made.paths if path.rsplit("/", 1)[1] in files}
            return result
        finally:
            for path in set(_made.paths) - needed:
                drop_folder(df.sparkSession, path)
            if outer is not None:
                outer.extend(needed)
            _made.paths = outer

    return tidied


@tidy
def _round(edges: DataFrame, count: int) -> DataFrame:
    tasks = max(LEAST_TASKS, 2 * count // EDGES_PER_TASK)
    return _star(_star(edges, False, tasks), True, tasks)


def _star(edges: DataFrame, small: bool, tasks: int) -> DataFrame:
    """Link the larger (or smaller) neighbours of each node, and the node, to the least of them all.

    The least neighbours are a table of their own, so that the join with the edges has an exchange on either side and Spark can
    split the edges of a node with very many.
    """
    both = edges if small else edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
    node, other = ("hi", "lo") if small else ("lo", "hi")
    least = both.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("least"))
    least = kept(least.select("node", F.least("node", "least").alias("least")).coalesce(tasks), "least")
    joined = both.join(least, both[node] == least["node"])
    if small:
        ends = F.explode(F.array("node", other)).alias("hi")
        moved = joined.select(F.col("least").alias("lo"), ends)
    else:
        moved = joined.where(F.col(other) > F.col("node")).select(F.col("least").alias("lo"), F.col(other).alias("hi"))
    return kept(moved.where("lo < hi").coalesce(tasks).distinct().coalesce(tasks), "edges")


@tidy
def components(links: DataFrame) -> DataFrame:
    """``(hi, lo)``: for each node of ``links`` (lo, hi), lo < hi, but the least of its component, that least node.

    Large and small stars alternate until the edges stay as they are, after a number of rounds logarithmic in the nodes;
    every round is written to the shared folder, where only the last stays. No links give no rows.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())

    edges = kept(links.select("lo", "hi").where("lo < hi").distinct(), "edges")
    now = state(edges)
    while True:
        edges = _round(edges, now[0])
        before, now = now, state(edges)
        if now == before:
            return edges
