"""Connected components of an edge table, as repeated joins.

Every node points at a smaller or equal node. A round replaces each pointer
by the smallest of: the pointer's own pointer, the grandparents of the node's
neighbours, and what the nodes that point at it were offered (hooking). Rounds
follow the logarithm of the longest path, not its length. Each round is
written to the shared scratch folder and read back, so a lost executor costs
one round at most, and the joins on a hot pointer (the centre of a big star)
are plain shuffles of tables, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges`` (a, b: long, never null) -> one row (node, label) per node of an
    edge; the label is the smallest node that can be reached."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.write(both.where("a <> b").distinct(), "both")
    labels = scratch.write(both.groupBy(F.col("a").alias("node"))
                           .agg(F.least(F.col("node"), F.min("b")).alias("f")), "labels-0")
    turn = 0
    while True:
        turn += 1
        parent = labels.select(F.col("node").alias("p"), F.col("f").alias("gf"))
        state = scratch.write(labels.join(parent, F.col("f") == F.col("p")).drop("p"), f"state-{turn}")
        offered = scratch.write(
            both.join(state.select("node", "gf"), F.col("b") == F.col("node"))
            .groupBy("a").agg(F.min("gf").alias("offer")), f"offers-{turn}")
        with_offer = state.join(offered, F.col("node") == F.col("a")).drop("a")
        hooks = with_offer.groupBy(F.col("f").alias("h")).agg(F.min("offer").alias("hook"))
        moved = (with_offer.join(hooks, F.col("node") == F.col("h"), "left")
                 .select("node", F.least("f", "gf", "offer", "hook").alias("new"), "f"))
        written = scratch.write(moved, f"labels-{turn}")
        changed = not written.where("new <> f").limit(1).isEmpty()
        for name in (f"labels-{turn - 1}", f"state-{turn}", f"offers-{turn}"):
            scratch.drop(name)
        labels = written.select("node", F.col("new").alias("f"))
        if not changed:
            scratch.drop("both")
            return labels.withColumnRenamed("f", "label")
