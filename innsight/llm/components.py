"""Connected components of a written edge table, by contracting to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.tables import stored


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is one node of its component.

    Each round maps every node to its smallest neighbour (or itself), replaces the ends of
    the edges by their images and drops loops and repeats, so the graph shrinks until no
    edge is left. Nodes should be hashes: then the number of rounds is logarithmic. Every
    round is written to the shared folder, which cuts the lineage and outlives executors.
    Null ends are ignored; an empty table gives an empty result.
    """
    left = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct()
    left = stored(left, f"{label}-edges")
    roots = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("to"))
        step = stored(step, f"{label}-step")
        first, second = step.select("a", F.col("to").alias("x")), step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        moved = left.join(first, "a").join(second, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        if roots is None:
            roots = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            again = step.select(F.col("a").alias("root"), "to")
            roots = roots.join(again, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        roots = stored(roots, f"{label}-roots")
        left = stored(moved.distinct(), f"{label}-edges")
    if roots is None:
        roots = left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
