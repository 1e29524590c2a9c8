"""Stored intermediate tables and connected components, as Spark jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A component of this many hops or more would need more rounds; labels jump, so rounds grow with the log.
MAX_ROUNDS = 60


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it; a local session may have none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def stored(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read again: its lineage ends there."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of edges (a, b); component is the smallest id reachable.

    A round points every node to its smallest neighbour and that one's smallest neighbour, then
    replaces the ends of the edges by what they point to: equal edges fold, loops go, and only the
    edges between different groups are left for the next round. At the end the rounds' pointers are
    followed one after the other. Neighbours are folded by node before each shuffle, so that a node
    with very many edges is no larger task than others.

    Nulls are no nodes; loops and repeated edges add nothing, but a node that only has a loop is no
    node here. No edges give no rows.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    left = stored(edges.where("a <> b").select(*ends).distinct())
    steps: list[DataFrame] = []
    while not left.isEmpty():
        if len(steps) == MAX_ROUNDS:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
        both = left.select("a", "b").union(left.select("b", "a"))
        nearest = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("to")))
        onward = nearest.select(F.col("id").alias("to"), F.col("to").alias("further"))
        step = stored(nearest.join(onward, "to").select("id", F.col("further").alias("to")))
        steps.append(step)
        moved = left.join(step.select(F.col("id").alias("a"), F.col("to").alias("c")), "a")
        moved = moved.join(step.select(F.col("id").alias("b"), F.col("to").alias("d")), "b")
        left = stored(moved.where("c <> d").select(F.greatest("c", "d").alias("a"), F.least("c", "d").alias("b")).distinct())
    if not steps:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found = steps[0].withColumnRenamed("to", "component")
    for step in steps[1:]:
        further = step.select(F.col("id").alias("component"), "to")
        found = found.join(further, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return stored(found)
