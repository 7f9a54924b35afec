"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``comp`` (smallest id reachable) of every id in ``links`` (``a``, ``b``).

    Every round takes the smallest label among the neighbours and then the label
    of that label, so that the rounds grow with the logarithm of a chain's
    length. Minima are taken before each shuffle; no list of neighbours is made.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut(both.where("a <> b").distinct(), "links")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp")), "labels")
    while True:
        offered = both.join(labels, both["b"] == labels["id"]).select(both["a"].alias("id"), "comp")
        least = offered.unionAll(labels).groupBy("id").agg(F.min("comp").alias("comp"))
        over = labels.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        new = cut(least.join(over, "comp").select("id", F.least("comp", "next").alias("comp")), "labels")
        old = labels.select("id", F.col("comp").alias("old"))
        # labels only ever fall, so equal sums are equal labels
        if new.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first() == old.agg(F.sum(F.col("old").cast("decimal(38,0)"))).first():
            return new
        labels = new
