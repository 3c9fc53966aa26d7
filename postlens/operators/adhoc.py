"""Ad-hoc SQL over the posts table."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import DataFrame, SparkSession

PLANS = "org.apache.spark.sql.catalyst.plans.logical."
# Plan nodes that change something or run a program, and functions that call any method of a class.
ACTS = tuple(PLANS + name for name in ("Command", "ParsedStatement", "InsertIntoDir", "ScriptTransformation", "CompoundPlanStatement", "Call"))
CALLS = ("reflect", "java_method", "try_reflect")


def _each(items: JavaObject) -> Iterator[JavaObject]:
    for i in range(items.size()):
        yield items.apply(i)


def acts(spark: SparkSession, text: str) -> str | None:
    """The first part of a statement that does more than read, as Spark's parser sees it; none for a query."""
    gateway = spark.sparkContext._gateway
    todo = [spark._jsparkSession.sessionState().sqlParser().parsePlan(text)]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if "ExecuteImmediate" in name or any(is_instance_of(gateway, node, kind) for kind in ACTS):
            return name
        if name == "UnresolvedFunction" and node.nameParts().last().lower() in CALLS:
            return node.nameParts().last()
        todo += _each(node.children())
        todo += _each(node.innerChildren())
        if is_instance_of(gateway, node, "org.apache.spark.sql.catalyst.plans.QueryPlan"):
            todo += _each(node.expressions())
        elif is_instance_of(gateway, node, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
            todo.append(node.plan())
    return None


def adhoc_sql(posts: DataFrame, text: str, **params: Any) -> DataFrame:
    """Run the query ``text`` over ``{posts}``; ``:name`` markers are bound, never spliced in.

    The table is known to this call alone, so two callers do not disturb each other. The statement is parsed first, and refused
    if any part of its plan is a command, writes, or runs a program or a method of a class.
    """
    spark = posts.sparkSession
    found = acts(spark, text.replace("{posts}", "posts"))
    if found:
        raise ValueError(f"only queries are run, not {found}")
    return spark.sql(text, args=params or None, posts=posts)
