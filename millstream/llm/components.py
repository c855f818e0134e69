"""Connected components of a graph given by its links, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millstream.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(s, c): each node of a link with the smallest node that it is connected to.

    Every round a node takes the smallest label among its own and its neighbours', and then its label's label, so that
    the way to the smallest node is halved. Labels are written as a table each round. Nulls and loops are left out.
    """
    both = links.filter(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = stored(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "graph-edges")
    labels = stored(edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("s"), F.least("u", "v").alias("c")), "graph-labels")
    while True:
        near = edges.join(labels.withColumnsRenamed({"s": "v", "c": "n"}), "v").groupBy("u").agg(F.min("n").alias("n"))
        mine = labels.join(near.withColumnRenamed("u", "s"), "s").select("s", "c", F.least("c", "n").alias("n"))
        jump = labels.select(F.col("s").alias("n"), F.col("c").alias("far"))
        # The label that is left behind learns of the smaller one too.
        told = mine.filter("n < c").groupBy(F.col("c").alias("s")).agg(F.min("n").alias("told"))
        step = mine.join(jump, "n").join(told, "s", "left").select("s", "c", F.least("far", "n", "told").alias("n"))
        step = stored(step, "graph-labels")
        labels = step.select("s", F.col("n").alias("c"))
        if step.filter("n < c").isEmpty():
            return labels
