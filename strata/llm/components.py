"""Connected components by contraction, on Spark.

Each round joins every component to its smallest neighbour, follows those
pointers to their ends by doubling, and rewrites the links between components;
links inside one disappear. Links shrink round by round; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import staged


def roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node reachable.

    Repeated links, loops and both directions are allowed.
    """
    links = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = None
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        up = staged(up, "pointers")
        while True:  # to the end of each chain of pointers
            for _ in range(2):
                jump = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
                up = up.join(jump, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
            up = staged(up, "pointers")
            if up.where("moved").isEmpty():
                break
            up = up.select("node", "root")
        up = up.select("node", "root")
        if labels is None:
            labels = up
        else:
            moved = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = staged(labels.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        left = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = links.join(left, "a").join(right, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        links = staged(links, "links")
        if links.isEmpty():
            return labels
