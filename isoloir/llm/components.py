"""Connected components of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoloir.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``comp`` (the smallest node reachable) of every node of ``links(a, b)``.

    Every node points to its smallest neighbour or itself; each round, what it points to is
    replaced by the smallest that it and its neighbours point to, and then by what that
    points to. The number of rounds grows with the logarithm of the longest path. A node
    with very many neighbours is pre-aggregated where the links are.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "links")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("comp")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        hooked = labels.select("node", "comp").join(least, "node").select(
            "node", "comp", F.least("comp", "near").alias("next")
        )
        # What a node's label is now told by any of its nodes holds for the label too. Both
        # sides of the join are stored, so that Spark can split a label of very many nodes.
        hooked = stored(hooked, "hooked")
        told = stored(hooked.groupBy("comp").agg(F.min("next").alias("told")), "told")
        moved = hooked.join(told, "comp").select("node", "comp", F.least("next", "told").alias("next"))
        jumped = moved.select("node", F.col("next").alias("at"), F.col("comp").alias("old")).join(
            moved.select(F.col("node").alias("at"), F.col("next").alias("further")), "at"
        )
        after = stored(jumped.select("node", "old", F.least("at", "further").alias("comp")), "labels")
        # The next labels are files of their own; what they were made of is of no more use.
        discard(labels, hooked, told)
        labels, done = after, after.where("comp <> old").isEmpty()
        if done:
            discard(both)
            return after.select("node", "comp")
