"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import dropped, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each vertex to its smallest neighbour."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each vertex and its smaller neighbours to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each vertex of edges (u, v: long) that isn't the smallest of its component; component: the smallest.

    Large and small stars in turn until nothing changes (Kiveris et al. 2014): a logarithmic number of rounds in practice. Each vertex's
    smallest neighbour is a partial aggregate and a table of its own, so that both sides of the join with it are plain and a hub's rows can be split among tasks;
    each round is a table in the shared folder.
    """
    now = written(edges.where("u <> v").distinct(), "edges")
    state = None
    while True:
        then = written(_small_star(_large_star(now)), "edges")
        dropped(edges.sparkSession, now)
        now = then
        new = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if new == state or not new["n"]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = new
