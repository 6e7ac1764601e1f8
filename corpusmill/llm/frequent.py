"""Most frequent items of columns with hundreds of millions of distinct values.

Exact spillable aggregation: one hash aggregation with map-side combining (a
hot value is one row per map task by then), hash partitions that spill, a local
top-k in every partition and one final ordered limit. Nothing grows with the
number of distinct values except the spilled hash partitions.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_items(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(attr, item, n): rows of df per value of each named column; null values are not counted."""
    pairs = F.array(*[F.struct(F.lit(name).alias("attr"), c.cast("string").alias("item")) for name, c in columns.items()])
    return (
        df.select(F.explode(pairs).alias("p"))
        .select("p.attr", "p.item")
        .where(F.col("item").isNotNull())
        .groupBy("attr", "item")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequent_items(df: DataFrame, columns: dict[str, tuple[Column, str]]) -> DataFrame:
    """(attr, item, n, total): values that hold at least their column's share of the rows with a value.

    columns: name -> (column, share as a decimal string such as "0.005").
    At most 1/share values can reach a share, so k = ceil(1/share) rows pass
    the limit and none that qualifies is lost. Nulls count neither as items
    nor in total; ties at the limit can't occur among qualifying values. An
    empty table gives no rows; other columns are ignored.
    """
    shares = {name: Fraction(share) for name, (_, share) in columns.items()}
    if not all(0 < s <= 1 for s in shares.values()):
        raise ValueError("shares must lie in (0, 1]")
    counts = count_items(df, {name: c for name, (c, _) in columns.items()})
    totals = counts.groupBy("attr").agg(F.sum("n").alias("total"))  # a row per column: safe to broadcast
    by_count = Window.partitionBy("attr").orderBy(F.desc("n"), "item")
    ranked = counts.withColumn("rank", F.row_number().over(by_count))
    limit = F.lit(None).cast("int")
    reached = F.lit(False)
    for name, share in shares.items():
        here = F.col("attr") == name
        limit = F.when(here, F.lit(ceil(1 / share))).otherwise(limit)
        reached = F.when(here, F.col("n") * share.denominator >= F.col("total") * share.numerator).otherwise(reached)
    largest = max(ceil(1 / s) for s in shares.values())
    # the constant bound is what the planner turns into a local limit before the shuffle
    top = ranked.where(F.col("rank") <= largest).where(F.col("rank") <= limit)
    return top.join(F.broadcast(totals), "attr").where(reached).select("attr", "item", "n", "total")
