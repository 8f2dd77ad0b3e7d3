"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.texts import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b), both long; label is some node of its component.

    Each round points every node to its smallest neighbour or itself, follows the pointers to their
    roots by doubling, and goes on with the edges between different roots. Every root that has an
    edge left has a smaller neighbour in the next round, so the rounds are few. All steps are joins
    and aggregates with a partial phase, written to the shared folder; nothing is collected.
    """
    rounds = []
    edges = edges.where(F.col("a") != F.col("b")).select("a", "b")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        point = saved(point.select("node", F.least("node", "b").alias("label")), "components-point")
        while True:
            onward = point.select(F.col("node").alias("label"), F.col("label").alias("root"))
            step = saved(
                point.join(onward, "label").select("node", F.col("root").alias("label"), (F.col("root") != F.col("label")).alias("moved")),
                "components-jump",
            )
            point = step.select("node", "label")
            if step.where("moved").isEmpty():
                break
        rounds.append(point)
        ends = [point.select(F.col("node").alias(c), F.col("label").alias(f"{c}_root")) for c in ("a", "b")]
        rest = edges.join(ends[0], "a").join(ends[1], "b").where("a_root != b_root")
        rest = rest.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
        edges = saved(rest.distinct(), "components-edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    label = rounds[0]
    for later in rounds[1:]:
        onward = later.select(F.col("node").alias("label"), F.col("label").alias("root"))
        label = label.join(onward, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    return label
