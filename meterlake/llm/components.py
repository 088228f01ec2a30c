"""Connected components of links, by contraction, with every round in a table of the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes in ``links`` (a, b), which are random 64-bit numbers.

    In each round every node moves to the least of itself and its neighbours, and the links between what
    is left are drawn anew. Since the numbers are random, the rounds grow with the logarithm of the
    number of nodes. The component is one of its nodes. Nothing but a flag reaches the driver.
    """
    found = None
    links = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        moved = stored(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select(
                "node", F.least("node", "to").alias("component")
            ),
            "moved",
        )
        spent = [links]
        if found is None:
            found = moved
        else:
            spent += [moved, found]
            step = moved.select(F.col("node").alias("component"), F.col("component").alias("next"))
            found = stored(
                found.join(step, "component", "left").select(
                    "node", F.coalesce("next", "component").alias("component")
                ),
                "components",
            )
        for end in ("a", "b"):
            to = moved.select(F.col("node").alias(end), F.col("component").alias("to"))
            links = links.join(to, end).drop(end).withColumnRenamed("to", end)
        links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
        discard(*spent)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")) if found is None else found
