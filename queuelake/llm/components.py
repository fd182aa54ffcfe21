"""Connected components of an edge table, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelake.llm.frames import written


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of ``edges`` (a, b): the least vertex reachable.

    Every step takes the least label among a vertex and its neighbours (a
    partial aggregate, so a hub of any degree is summed up before it is
    shuffled), then the label's label.  Steps are written to the shared folder;
    only a count of changed labels reaches the driver.
    """
    both = written(edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a")).distinct(), "edges")
    labels = both.groupBy("v").agg(F.min("w").alias("m")).select("v", F.least("v", "m").alias("root"))
    while True:
        ends = labels.select(F.col("v").alias("w"), F.col("root").alias("seen"))
        near = both.join(ends, "w").groupBy("v").agg(F.min("seen").alias("near"))
        step = labels.join(near, "v").select("v", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = step.select(F.col("v").alias("root"), F.col("root").alias("far"))
        labels = written(step.join(jump, "root", "left").select("v", "old", F.least("root", F.coalesce("far", "root")).alias("root")), "labels")
        if labels.where("old <> root").limit(1).count() == 0:
            return labels.select("v", "root")
        labels = labels.select("v", "root")
