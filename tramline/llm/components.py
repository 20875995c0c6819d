"""Connected components of a link table, by minimum labels and pointer jumping.

Every round takes the least label among a node's neighbours and its label's
own label, so chains shorten by half or better. Each round is written to the
shared scratch folder; labels and links never come to the driver, only the
number of nodes that changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import files_for, settle


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the least node of its component.

    Null nodes are ignored; repeated links and loops do no harm; no links give no rows.
    """
    links = links.filter("a is not null and b is not null").select("a", "b")
    both = settle(links.union(links.select("b", "a")).distinct(), "links")
    files = files_for(links.sparkSession, both.count())
    labels = settle(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.min("a")).alias("label"))
                    .withColumn("changed", F.lit(True)).coalesce(files), "labels")
    while labels.filter("changed").limit(1).count():
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = settle(
            labels.select("node", "label").join(near, "node").join(up, "label")
            .select("node", F.least("label", "near", "up").alias("new"), "label")
            .select("node", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("changed")).coalesce(files), "labels")
    return labels.select("node", "label")
