"""Connected components over links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """(node, component) for all nodes of ``links`` (a, b): the component is the smallest node that can
    be reached.

    Each round every node takes the smallest label among its own and its neighbours', then the label
    of that label, so chains shorten by halves. Rounds are written to the shared folder, each replacing the
    last; only whether a label changed comes to the driver.
    """
    scratch = Scratch(links.sparkSession)
    edges = scratch.cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = scratch.cut(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")).select("node", "component"), "labels-0")
    for nth in range(1, most_rounds + 1):
        seen = labels.select(F.col("node").alias("b"), F.col("component").alias("other"))
        lower = edges.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("least"))
        new = labels.join(lower, "node").select("node", "component", F.least("component", "least").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        new = scratch.cut(new.join(jump, "next").select("node", F.col("component").alias("was"), F.least("next", "far").alias("component")), f"labels-{nth}")
        scratch.free(f"labels-{nth - 1}")
        if new.where("was <> component").isEmpty():
            break
        labels = new.select("node", "component")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    scratch.free("edges")
    return new.select("node", "component")
