"""Connected components of links, by spreading the smallest label and jumping over it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def connected(links: DataFrame) -> DataFrame:
    """node, label for all ends of the links a, b: the smallest node of the component.

    Each round takes the smallest label among a node and its neighbours, then the label of
    that label, so rounds grow with the logarithm of a component's width. Sums of labels
    are combined before the shuffle; every round is a table in the shared folder, from
    which the next starts. Without links the result is empty.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = common.checkpointed(both.where("a <> b").distinct(), "links")
    labels = common.checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    before = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before or total is None:
            return labels
        before = total
        known = labels.select(F.col("node").alias("a"), "label")
        told = both.join(known, "a").select(F.col("b").alias("node"), "label").unionByName(labels)
        least = common.checkpointed(told.groupBy("node").agg(F.min("label").alias("label")), "labels")
        further = least.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = least.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label"))
        labels = common.checkpointed(jumped, "labels")
