"""Connected components over a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.tables import materialise, scratch


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, label), label being the least node of the component.

    In each round every node points to its least neighbour, or to itself if that is no less; pointers are doubled until all of them
    end at such a local minimum, and the edges between different minima are what the next round works on, half of the nodes at
    most. Rounds are written to the shared folder; only whether anything is left comes back to the driver.
    """
    with scratch(edges.sparkSession):
        left = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
        labels = None
        while labels is None or not left.isEmpty():
            both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
            ends = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("up")), "pointers")
            while True:
                further = ends.select(F.col("node").alias("n"), F.col("up").alias("end")).hint("merge")
                jumped = materialise(ends.join(further, F.col("up") == F.col("n")).select("node", F.col("up").alias("was"), F.col("end").alias("up")), "pointers")
                ends = jumped.select("node", "up")
                if jumped.filter("was <> up").isEmpty():
                    break
            of = lambda side: ends.select(F.col("node").alias(f"n{side}"), F.col("up").alias(f"u{side}")).hint("merge")
            moved = left.join(of("a"), F.col("a") == F.col("na")).join(of("b"), F.col("b") == F.col("nb")).filter("ua <> ub")
            left = materialise(moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
            if labels is None:
                labels = ends.select("node", F.col("up").alias("label"))
            else:
                labels = materialise(labels.join(of("l"), F.col("label") == F.col("nl"), "left").select("node", F.coalesce("ul", "label").alias("label")), "labels")
        return materialise(labels, "components", keep=True)
