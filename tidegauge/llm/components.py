"""Connected components of an edge list, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of the component) of all ends of ``edges`` (a, b).

    Each round points every node at its smallest neighbour, and that one's, and replaces
    edges by edges between the nodes pointed at. At least half of the nodes that still have
    edges vanish in a round, so the rounds are as the logarithm of the largest component.
    Sums and minima meet on the map side; no component is gathered in one place. Loops, null
    ends and repeated edges do no harm; an empty list gives no rows.
    """
    ends = edges.where("a is not null and b is not null").select("a", "b")
    left = stored(ends.where("a <> b").distinct(), "edges")
    roots = stored(ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("up"))
        up = stored(up, "up")
        above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        top = stored(up.join(above, "up").select("node", "top"), "top")
        roots = stored(
            roots.join(top.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots"
        )
        tops = [top.select(F.col("node").alias(c), F.col("top").alias(f"top_{c}")) for c in "ab"]
        moved = left.join(tops[0], "a").join(tops[1], "b").select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))
        left = stored(moved.where("a <> b").distinct(), "edges")
    return roots
