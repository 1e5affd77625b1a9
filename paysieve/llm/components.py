"""Connected components of a table of links, by minimum labels and pointer jumping.

Every round a node takes the smallest label among its own and its neighbours'
and then its label's label.  Rounds grow with the logarithm of a
component's longest path in practice; each one is written to the shared folder, so
lineage stays short.  A node with very many links is an aggregate with partial
sums on one side and a join that adaptive execution splits on the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.llm.common import stored


def connected_components(links: DataFrame, *, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): the smallest node that can be reached.

    ``links`` has two columns of one orderable type; direction, repeats and
    self-links do not matter, and links with a NULL end are ignored.  Only nodes with a link appear.
    """
    there = stored(
        links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL"), "links"
    )
    flipped = there.select(F.col("b").alias("a"), F.col("a").alias("b"))
    edges = there.unionByName(flipped).where("a <> b")
    nodes = there.select(F.col("a").alias("node")).unionByName(there.select(F.col("b").alias("node"))).distinct()
    first = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = stored(
        nodes.join(first, "node", "left").select("node", F.least("node", "least").alias("component")), "labels"
    )
    while True:
        near = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        taken = stored(
            labels.join(near, "node", "left").select(
                "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
            ),
            "labels",
        )
        ahead = taken.select(F.col("node").alias("at"), F.col("component").alias("further"))
        jumped = stored(
            taken.join(ahead, taken["component"] == ahead["at"], "left").select(
                "node", "before", F.least("component", "further").alias("component")
            ),
            "labels",
        )
        labels = jumped.select("node", "component")
        if jumped.where("component <> before").isEmpty():
            return labels
