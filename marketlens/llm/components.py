"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node of the links ``a`` - ``b``; any orderable type.

    Each round, every node points to its smallest neighbour, pointers are followed to their roots, and links between roots remain for
    the next round: at least half of the nodes with links go each round. Every round's tables are written, so joins on a root that very many nodes point to
    read both sides by shuffles that Spark can split. Links with a null end and loops are ignored.
    """
    edges = written(links.where("a is not null and b is not null and a != b").select("a", "b").distinct(), "cc-links")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
        pointers = written(both.groupBy("a").agg(F.min("b").alias("low"))
                           .selectExpr("a as node", "least(a, low) as root"), "cc-pointers")
        while True:
            up = pointers.selectExpr("node as root", "root as higher")
            jumped = written(pointers.join(up, "root").select("node", F.col("higher").alias("root"), (F.col("higher") < F.col("root")).alias("moved")), "cc-jump")
            pointers = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        rounds.append(pointers)
        ends = pointers.selectExpr("node as a", "root as ra"), pointers.selectExpr("node as b", "root as rb")
        edges = written(edges.join(ends[0], "a").join(ends[1], "b").where("ra != rb").selectExpr("ra as a", "rb as b").distinct(), "cc-links")
    if not rounds:
        return edges.selectExpr("a as node", "b as component")  # empty
    # A round's roots are the next round's nodes: follow them down from the first round.
    found = rounds[0]
    for later in rounds[1:]:
        found = written(found.join(later.selectExpr("node as root", "root as next"), "root", "left")
                        .select("node", F.coalesce("next", "root").alias("root")), "cc-found")
    return found.withColumnRenamed("root", "component")
