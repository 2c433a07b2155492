"""Connected components of a graph given as edges, by alternating stars; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pavilion.session import materialize

ROUNDS = 60
# Links that a task of a round handles, where there are more than one for each core.
TASK_LINKS = 200_000


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.filter("u <> v").distinct()


def _tasks(spark: SparkSession, links: int) -> int:
    """Tasks for so many links: a round has many short stages, and the driver keeps track of each task of them."""
    return max(spark.sparkContext.defaultParallelism, -(-links // TASK_LINKS))


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link each node's larger neighbours to the least of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "c")
    near = both.join(least, F.col("u") == F.col("c")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _distinct(near.coalesce(tasks)).coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them; here v < u in every edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
    near = edges.join(least, F.col("u") == F.col("c")).select("v", "m")
    own = least.select("c", "m")
    return _distinct(near.union(own).toDF("u", "v").coalesce(tasks)).coalesce(tasks)


def _state(links: DataFrame) -> tuple[int, bool]:
    """(number of links, whether they are stars): no node with two smaller neighbours, or with a smaller and a larger one."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    n, most = nodes.agg(F.sum("up"), F.max(F.when(F.col("up") > 0, F.col("up") + F.col("down")))).first()
    return n or 0, (most or 0) <= 1


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in an edge (u, v); root is the component's least node.

    Each round is written to the shared folder, so a lost executor costs one round at most. The rounds grow with the
    logarithm of the longest path, and end when all links are stars; edges never outnumber the given ones. Its tasks follow
    the number of links, not that of the shuffles' partitions.
    """
    spark = edges.sparkSession
    oriented = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = materialize(_distinct(oriented), "links")
    for _ in range(ROUNDS):
        n, stars = _state(now)
        tasks = _tasks(spark, n)
        if stars:
            # A node below a root is in one link, and a root in none as such.
            roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).coalesce(tasks)
        now = materialize(_small_star(_large_star(now, tasks), tasks), "links")
    raise RuntimeError("the components did not settle")
