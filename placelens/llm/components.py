"""Connected components of a graph given as an edge table, by alternating star operations.

Every node ends up linked to the smallest node it can reach. A large-star step links each node's larger neighbours to the
smallest node next to it, a small-star step its smaller neighbours; both never part what is connected, and the number of
rounds grows with the logarithm of the longest path. Every round is two aggregations and two joins, and its edges are
stored, so a lost executor costs no more than a round. A node that is linked to a third of all nodes is no single
task's work: minima are combined before the shuffle, and the joins split busy keys.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.llm.common import measured_join, stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """`edges`: (a, b), each link once, a > b."""
    if larger:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        linked = measured_join(sides.where("b > a"), low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("low"))
        joined = measured_join(edges, low, "a")
        down = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        linked = down.unionByName(low.select("a", F.col("low").alias("b")))
    return linked.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """One row per node that has a link: node, root (the smallest node it can reach). `edges`: columns a, b, of one orderable type."""
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    total = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    mark = now.agg(F.count("*"), total).first()
    while mark[0]:
        now = stored(_star(_star(now, True), False), "edges")
        last, mark = mark, now.agg(F.count("*"), total).first()
        if mark == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
