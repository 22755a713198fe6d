"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlog.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """v, label for each end of `links` (a, b): label is the smallest vertex reachable.

    Every round each vertex takes the smallest label among its neighbours and then that
    label's own label, so the rounds grow with the logarithm of the longest path.  Labels
    are written to the shared folder after each round.
    """
    both = links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(
        links.select("b", "a")).where("u <> v")
    labels = staged(both.groupBy("v").agg(
        F.least(F.min("u"), F.col("v")).alias("label")), "components")
    while True:
        near = both.join(labels.select(F.col("v").alias("u"), F.col("label").alias("l")), "u")
        step = labels.join(near.groupBy("v").agg(F.min("l").alias("l")), "v").select(
            "v", F.least("label", "l").alias("new"), "label")
        jump = step.select(F.col("v").alias("new"), F.col("new").alias("further"))
        after = staged(step.join(jump, "new").select(
            "v", F.least("new", "further").alias("label"),
            (F.least("new", "further") != F.col("label")).alias("moved")), "components")
        if after.where("moved").isEmpty():
            return after.select("v", "label")
        labels = after.select("v", "label")
