"""Connected components of links held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.job import Job
from silverlode.operators.joins import balanced_join, number_rows


def components(job: Job, links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the least node reached.

    Each round maps every node to the least of itself and its neighbours and then does the same
    to the links, so links shrink until none joins two labels. Rounds are written tables. A node's
    neighbours are only ever reduced to their minimum, and the links of a node with very many are
    spread over tasks to meet it. `links` is a stored table or a row-wise selection of one.
    """
    links = links.select("a", "b").filter("a <> b")
    labels = None
    while True:
        both = links.union(links.select("b", "a"))
        parents = job.stage(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.least(F.col("a"), F.min("b")).alias("parent")).select("node", "parent"),
            "parents",
        )
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            step = parents.select(F.col("node").alias("label"), "parent")
            labels = labels.join(step, "label", "left").select(
                "node", F.coalesce("parent", "label").alias("label")
            )
        moved = number_rows(links)
        for end, name in (("a", "x"), ("b", "y")):
            side = parents.select(F.col("node").alias(f"of_{end}"), F.col("parent").alias(name))
            moved = balanced_join(job, moved, side, end, f"of_{end}", "inner", left_source=links)
        links = job.stage(
            moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "links",
        )
        if links.isEmpty():
            return labels
