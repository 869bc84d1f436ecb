"""Connected components of a link table, by minimum labels and pointer jumping.

Rounds are joins and partial minimum aggregates; each round's labels are cut to the shared folder. Only nodes that have
links take part. Ids and links never pass through the driver; it sees one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (node long, root long), root being the smallest node reachable."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("seen"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "seen").alias("root"))
        step = cut(step)
        up = step.select(F.col("node").alias("up"), F.col("root").alias("up_root"))
        step = cut(step.join(up, step["root"] == up["up"]).select("node", "old", F.least("root", "up_root").alias("root")))
        moved = step.filter("root <> old").limit(1).count()
        labels = step.select("node", "root")
        if not moved:
            return labels
