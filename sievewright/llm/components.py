"""Connected components over any number of links, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import discard, fresh_path, write_at


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); root is the smallest node of the component.

    Each pass takes the least label among a node's neighbours and then the label of that
    label, so the passes grow with the logarithm of a path's length. Every pass is written to
    the shared folder, and takes the place of the one before. Sums over a hub's links are
    partial before they are shuffled.
    """
    # Once: another evaluation may choose other links of a class, and each is needed in both directions.
    spark = links.sparkSession
    single, double, before = (fresh_path(spark, x) for x in ("links", "links", "labels"))
    links = write_at(links.select("a", "b"), single)
    both = write_at(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), double)
    discard(spark, single)
    labels = write_at(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")), before)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        path = fresh_path(spark, "labels")
        passed = write_at(hooked.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("root")), path)
        labels = passed.select("node", "root")
        discard(spark, before)
        before = path
        if passed.where("root != old").isEmpty():
            discard(spark, double)
            return labels
