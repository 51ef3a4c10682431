"""Connected components of an edge table, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import drop_table, write_table


def components(edges: DataFrame, src: str = "u", dst: str = "v") -> DataFrame:
    """(node, component): the smallest node that each node of an edge can reach.

    Every round contracts: a node takes the smallest label among its neighbours', labels are
    followed one step (pointer jumping), and edges are rewritten between labels, so that edges
    inside a component disappear. Rounds grow with the logarithm of a component's diameter. Only
    a count comes to the driver. Rows with a null end are no links; a self link makes its node a
    component. Repeated links don't matter; an empty table has no nodes.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).na.drop()
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    labels = write_table(nodes.withColumn("component", F.col("node")), "labels")
    live = write_table(pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # every label that still has links hooks onto its smallest neighbour if that is smaller
        hooked = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("to"))
        hooked = write_table(hooked, "hooks")
        for _ in range(2):
            onward = hooked.select(F.col("a").alias("to"), F.col("to").alias("beyond"))
            jumped = hooked.join(onward, "to", "left").select("a", F.coalesce("beyond", "to").alias("to"))
            jumped = write_table(jumped, "hooks")
            drop_table(hooked)
            hooked = jumped
        relabelled = labels.join(hooked.withColumnRenamed("a", "component"), "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
        fresh = write_table(relabelled, "labels")
        ends = live.join(hooked, "a").select(F.col("to").alias("x"), "b")
        ends = ends.join(hooked.select(F.col("a").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
        rest = write_table(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        for old in (labels, live, hooked):
            drop_table(old)
        labels, live = fresh, rest
    return labels
