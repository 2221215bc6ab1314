"""Connected components of a table of links, by least-label spreading with pointer jumping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for the nodes of links (a, b); other nodes are their own.

    Labels live in tables; each round takes the least label among neighbours and then the label of
    that label, so chains halve. Groups combine before the shuffle, and joins are between plain tables,
    which lets adaptive execution split a node with very many links.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        better = stored(
            labels.join(near, labels["node"] == near["a"], "left").select(
                "node", F.least("label", F.coalesce("near", "label")).alias("label"), (F.col("near") < F.col("label")).alias("moved")
            )
        )
        if better.where("moved").isEmpty():
            return labels.withColumnRenamed("label", "component")
        of = better.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = stored(better.join(of, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label")))
