"""Connected components of a link table, by hooking and pointer jumping on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jouleloom.session import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of `links`: the label is the smallest node that can be reached.

    Each round a node and the root it points to take the smallest label among their neighbours, then every
    label is replaced by its own label. Rounds grow with the logarithm of the longest path. Labels are
    written after each round; joins are on nodes, whose links are spread, or on labels, where a hot one is
    split by adaptive execution.
    """
    pair = [F.col(a).alias("node"), F.col(b).alias("other")], [F.col(b).alias("node"), F.col(a).alias("other")]
    both = written(links.select(*pair[0]).union(links.select(*pair[1])), "component-links")
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "component-labels")
    while True:
        other = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        near = both.join(other, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        seen = labels.join(near, "node")
        hooks = seen.where("theirs < label").select(F.explode(F.array("node", "label")).alias("node"), "theirs")
        best = hooks.groupBy("node").agg(F.min("theirs").alias("theirs"))
        hooked = labels.join(best, "node", "left").select(
            "node", F.least("label", F.coalesce("theirs", "label")).alias("label"), (F.col("theirs") < F.col("label")).alias("moved")
        )
        hooked = written(hooked.withColumn("moved", F.coalesce("moved", F.lit(False))), "component-hooks")
        root = hooked.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = written(hooked.join(root, "label").select("node", F.col("root").alias("label")), "component-labels")
        if hooked.where("moved").isEmpty():
            return labels
