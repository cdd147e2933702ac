"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rillwork.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b: bigint); the label is the smallest node that
    can be reached.

    Each round every node takes the smallest label among its neighbours' and then its label's
    label, so chains shorten by powers of two. Rounds are written tables; only the number of changes
    reaches the driver. Rows with a null end are no links; repeated rows and loops do no harm; an empty
    table gives an empty one.
    """
    links = links.where("a is not null and b is not null")
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                     .select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node"))
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        took = (labels.join(near, "node")
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = written(took.join(up, "label").select(
            "node", F.least("label", "above").alias("label"),
            (F.col("old") != F.least("label", "above")).alias("changed")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("changed").isEmpty():
            return labels
