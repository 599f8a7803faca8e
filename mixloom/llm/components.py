"""Connected components of a link table, by smallest label, without the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.storage import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node it can reach.

    Each round gives a node the smallest label among its neighbours and then the label of
    that label, so the number of rounds grows with the logarithm of a chain's length. Labels
    are written between the rounds; joins read plain tables, so hot nodes are split, and
    minima are taken before rows move. Only the count of changed labels reaches the driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staged(both.filter("a <> b").distinct(), "links")
    labels = staged(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        heard = edges.join(labels, edges["b"] == labels["node"]).select(F.col("a").alias("node"), "label")
        lowest = staged(heard.unionByName(labels).groupBy("node").agg(F.min("label").alias("label")), "labels")
        further = lowest.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = lowest.join(further, "label").select("node", F.least("label", "next").alias("label"))
        before = labels.select("node", F.col("label").alias("before"))
        labels = staged(jumped.join(before, "node"), "labels")
        changed = labels.filter("label <> before").limit(1).count()
        labels = labels.select("node", "label")
        if not changed:
            return labels
