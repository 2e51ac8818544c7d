"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmap.llm.common import parked


#: Rows of the edge table for each task, at least: the rounds are many, and mostly small.
TASK_ROWS = 250_000


def components(edges: DataFrame) -> DataFrame:
    """``node long, label long`` for the ends of all edges ``a, b``; the label is the component's smallest node.

    In each round every node takes the smallest label around it, and labels then follow the label of
    their own label, so that long chains halve; rounds end when no label changes.
    """
    both = parked(edges.select("a", "b").unionByName(edges.selectExpr("b AS a", "a AS b")).distinct())
    tasks = max(1, both.count() // TASK_ROWS)
    nearest = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = parked(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("label")).coalesce(tasks))
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearest = labels.join(around, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = nearest.select(F.col("node").alias("label"), F.col("label").alias("next"))
        # A label is a node of the same component, and so has a row.
        found = nearest.join(jump, "label").select("node", "was", F.least("label", "next").alias("label"))
        found = parked(found.coalesce(tasks))
        changed = found.filter("label <> was").limit(1).count()
        labels = found.select("node", "label")
        if not changed:
            return labels
