"""Connected components by min-label propagation with pointer jumping, native Spark.

Each round every node takes the smallest label among its own and its
neighbours', then the label of that label. Labels are aggregated map-side, so a
node with a great many links costs one row per task. A round's table is written
to the shared folder, which cuts the lineage; the loop ends when no label
changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.llm.common import stored


def components(edges: DataFrame, src: str, dst: str, name: str = "components") -> DataFrame:
    """(node, component) for every node of an edge; component: its smallest node.

    Null ends, loops and repeated edges have no effect on the labels; no edges
    give an empty table. Nodes compare as their type does.
    """
    links = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    both = stored(links.union(links.select("b", "a")).distinct(), f"{name}-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("component")), name)
    while True:
        seen = (both.join(labels, both.b == labels.node).groupBy("a")
                .agg(F.min("component").alias("near")))
        taken = (labels.join(seen, labels.node == seen.a)
                 .select("node", F.col("component").alias("old"),
                         F.least("component", "near").alias("new")))
        # pointer jumping: the label of the label, known from the round before
        jump = labels.select(F.col("node").alias("l"), F.col("component").alias("far"))
        after = stored(taken.join(jump, taken.new == jump.l, "left")
                       .select("node", "old", F.least("new", F.coalesce("far", "new")).alias("component")), name)
        changed = after.where("component <> old").limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels
