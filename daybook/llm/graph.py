"""Connected components of an edge table, as joins and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the edges (a, b): comp is the smallest node of its component.

    Every round a node takes the smallest label among its neighbours, then the
    label of that label (pointer jumping), until nothing changes; each round is
    written to the shared folder, so no lineage builds up and a lost executor
    costs at most one round.  Nothing is collected but one change count a round.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = materialise(both, "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        stepped = labels.join(near, "node").select("node", F.col("comp").alias("was"),
                                                   F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        after = materialise(stepped.join(jump, "comp", "left")
                            .select("node", "was", F.least("comp", F.coalesce("next", "comp")).alias("comp")), "labels")
        changed = after.where("comp <> was").limit(1).count()
        labels = after.select("node", "comp")
        if not changed:
            return labels
