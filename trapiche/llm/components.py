"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trapiche.sinks.writers import store


def connected_components(links: DataFrame) -> DataFrame:
    """`links(a, b)` -> `(node, root)`: the smallest node that each linked node can reach.

    Every round takes the smallest root among a node and its neighbours, then the root of that
    root, so the number of rounds grows with the logarithm of the longest path in common cases.
    Each round is written to the shared folder, which cuts the lineage; the driver sees one
    number a round. Neighbours are aggregated before the shuffle, and the joins are plain
    equi-joins whose hot keys adaptive execution splits.
    """
    both = store(
        links.select("a", "b").union(links.selectExpr("b AS a", "a AS b")).where("a <> b").distinct()
    )
    nodes = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = store(nodes.selectExpr("node", "least(node, root) AS root"))
    while True:
        near = (
            both.join(roots, both["b"] == roots["node"])
            .groupBy(F.col("a").alias("near_to"))
            .agg(F.min("root").alias("near_root"))
        )
        hooked = roots.join(near, F.col("node") == F.col("near_to")).selectExpr(
            "node", "root AS old", "least(root, near_root) AS root"
        )
        hooked = store(hooked)
        far = hooked.selectExpr("node AS mid", "root AS far_root")
        jumped = store(
            hooked.join(far, F.col("root") == F.col("mid")).selectExpr(
                "node", "old", "least(root, far_root) AS root"
            )
        )
        if jumped.where("root <> old").isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")
