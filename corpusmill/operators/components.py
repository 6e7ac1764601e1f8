"""Connected components by alternating large-star and small-star steps.

Every step is a grouped aggregation whose groups are combined map-side; a
hub with a third of all edges never becomes one task's list. Lineage is cut by
tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.scratch import discard, materialize


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(id, label): every id of edges (a, b) with the smallest id of its component.

    Self-loops and repeated edges are harmless; null ends are dropped. Raises
    RuntimeError if the components haven't settled after most_rounds rounds.
    """
    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    now = materialize(now, "edges")
    before = None
    for _ in range(most_rounds):
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: larger neighbours move to the smallest of the neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: smaller neighbours and the node itself move to the smallest
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        last, now = now, materialize(small, "edges")
        discard(last)  # two rounds' tables at most are there at a time
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            members = now.select(F.col("b").alias("id"), F.col("a").alias("label"))
            return members.unionByName(now.select(F.col("a").alias("id"), F.col("a").alias("label"))).distinct()
        before = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
