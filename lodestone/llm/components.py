"""Connected components over a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the component's smallest node.

    Each round takes for every node the smallest label among its neighbours' and its own, and then
    that label's own label, so that labels cover distances that double. Only edges and labels are
    shuffled; nothing reaches the driver but the number of nodes that changed. Each round's
    labels are written to the shared checkpoint folder.
    """
    both = checkpointed(edges.select("a", "b").where("a <> b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("root")))
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        nearer = labels.join(around, F.col("node") == F.col("a")).select("node", F.col("root").alias("was"), F.least("root", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("_at"), F.col("root").alias("_to"))
        after = checkpointed(nearer.join(jump, F.col("mid") == F.col("_at"), "left").select("node", "was", F.least("mid", F.coalesce("_to", "mid")).alias("root")))
        changed = after.where("was <> root").limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels
