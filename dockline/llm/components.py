"""Connected components of a link table, as joins and grouped minima."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the smallest node of its component, for every node with a link.

    Each round every node of the graph is merged with its smallest neighbour, if that is
    smaller, and that one's; links inside a merged node go, and equal links become
    one. At least half the nodes that still have links go in a round. Every round is
    written out, so that neither lineage nor plans grow."""
    e = C.materialize(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).distinct(), "cc-links")
    cur = C.materialize(e.select(F.explode(F.array("x", "y")).alias("node")).distinct().withColumn("label", F.col("node")), "cc-labels")
    e = e.filter("x != y")
    while e.limit(1).count():
        near = (e.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))).alias("p"))
                .groupBy(F.col("p.x").alias("n")).agg(F.min("p.y").alias("near")).select("n", F.least("n", "near").alias("to")))
        near = C.materialize(near, "cc-near")
        up = near.select(F.col("n").alias("n2"), F.col("to").alias("up"))
        to = C.materialize(near.join(up, F.col("to") == F.col("n2")).select("n", F.col("up").alias("to")), "cc-to")
        cur = C.materialize(cur.join(to, F.col("label") == F.col("n"), "left").select("node", F.coalesce("to", "label").alias("label")), "cc-labels")
        e = (e.join(to, F.col("x") == F.col("n")).select(F.col("to").alias("x"), "y")
             .join(to, F.col("y") == F.col("n")).select("x", F.col("to").alias("y"))
             .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).filter("x != y").distinct())
        e = C.materialize(e, "cc-links")
    return cur
