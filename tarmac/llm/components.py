"""Connected components of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in `links` (a, b); the label is the least node it reaches.

    Each round takes the least label around a node and then the label's own label, so the
    number of rounds grows with the logarithm of a chain's length. Rounds are written to the
    shared folder; the only value that comes to the driver is how many labels changed.
    """
    both = stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(),
        "links",
    )
    labels = stored(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
        .select(F.col("a").alias("node"), "label"),
        "labels",
    )
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy("a").agg(F.min("label").alias("least"))
        )
        nearer = labels.join(around.select(F.col("a").alias("node"), "least"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "least").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stored(
            nearer.join(jump, "label", "left").select(
                "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")
            ),
            "labels",
        )
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels
