"""Connected components of a graph of links, with nothing brought to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link (a, b); label is the least of its nodes.

    In each round a node takes the least label among itself and its neighbours, then the
    label which that label has itself, so a path is halved rather than walked. Rounds end
    when none changes. Labels go through a stored table each round, which cuts the lineage.
    """
    both = stored(links.union(links.select("b", "a")).distinct().filter("a <> b"), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("label")
    ), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        after = stored(
            step.join(jump, "next", "left").select(
                "node", "label", F.least("next", F.coalesce("beyond", "next")).alias("next")
            ),
            "labels",
        )
        changed = after.filter("label <> next").limit(1).count()
        labels = after.select("node", F.col("next").alias("label"))
        if not changed:
            return labels
