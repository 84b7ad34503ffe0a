"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versus.session import materialize


def connected(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (x, y): the smallest id reachable.

    Every round each node points to its smallest neighbour, pointers are followed once more, and
    links are drawn between the nodes pointed to; only local minima remain. A node with very many
    links is grouped by its partial minima and joined where it is skewed; each round is stored.
    """
    edges = materialize(
        links.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .where("x <> y")
        .distinct()
    )
    mapping = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        hook = materialize(
            both.groupBy("x").agg(F.min("y").alias("low")).select(
                F.col("x").alias("id"), F.least("x", "low").alias("to")
            )
        )
        further = hook.select(F.col("id").alias("to"), F.col("to").alias("far"))
        parent = materialize(hook.join(further, "to").select("id", F.col("far").alias("to")))
        if mapping is None:
            mapping = parent.select("id", F.col("to").alias("component"))
        else:
            step = parent.select(F.col("id").alias("component"), "to")
            mapping = materialize(
                mapping.join(step, "component", "left").select(
                    "id", F.coalesce("to", "component").alias("component")
                )
            )
        px = parent.select(F.col("id").alias("x"), F.col("to").alias("px"))
        py = parent.select(F.col("id").alias("y"), F.col("to").alias("py"))
        edges = materialize(
            edges.join(px, "x")
            .join(py, "y")
            .where("px <> py")
            .select(F.least("px", "py").alias("x"), F.greatest("px", "py").alias("y"))
            .distinct()
        )
    if mapping is None:
        return edges.select(F.col("x").alias("id"), F.col("y").alias("component"))
    return mapping
