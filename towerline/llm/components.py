"""Connected components over an edge table, by propagating the smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges: (u, v), any orderable type, in either direction -> (node, root): the smallest
    node that can be reached, for every node that has an edge.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so the number of rounds follows the logarithm of a component's length.  Labels
    are written to the shared folder after each round; only a count comes to the driver.
    """
    both = durable(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u <> v").distinct())
    labels = durable(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near")).select("node", F.least("node", "near").alias("root")))
    for _ in range(rounds):
        near = (
            both.join(labels.select(F.col("node").alias("v"), "root"), "v")
            .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        )
        # a label that hangs below another one pulls it down as well
        pulled = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        hung = pulled.groupBy(F.col("old").alias("node")).agg(F.min("root").alias("hung"))
        step = pulled.join(hung, "node", "left").select("node", "old", F.least("root", F.coalesce("hung", "root")).alias("root"))
        top = step.select(F.col("node").alias("root"), F.col("root").alias("top"))
        nxt = durable(step.join(top, "root", "left").select("node", "old", F.coalesce("top", "root").alias("root")))
        changed = nxt.filter("root <> old").limit(1).count()
        labels = nxt.select("node", "root")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
