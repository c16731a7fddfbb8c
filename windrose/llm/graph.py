"""Connected components of links, as rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, comp): each node of the links (a, b) and the smallest node it reaches.

    Every round takes the smallest label among a node's neighbours and the label
    of its own label, so chains shrink by jumps; rounds go on until no label
    changes.  Rounds are written to the shared folder, nothing is collected but
    the number of changes.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.filter("a <> b").distinct(), "links")
    labels = materialise(edges.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.min("b"), F.col("a")).alias("comp")), "labels")
    while True:
        seen = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        grown = (labels.join(seen, "node").join(jump, "comp", "left")
                 .select("node", F.least("comp", "near", "far").alias("comp"), F.col("comp").alias("was")))
        grown = materialise(grown, "labels")
        if grown.filter("comp <> was").isEmpty():
            return grown.select("node", "comp")
        labels = grown.select("node", "comp")
