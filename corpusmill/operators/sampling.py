"""Deterministic sampling and splitting by hashed order: the same rows at any number of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hashed(seed: int, *columns: Column) -> Column:
    """Order key of a row for a seed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("nan")) for c in columns]))


def group_positions(df: DataFrame, group: Column, order: Column) -> DataFrame:
    """df with _group, _order, _position (from 1, by hashed order within the group) and _size of the group.

    order must be hashed(...). Rows are ranked within (group, first digits of
    the order), and the counts of those give the position before each: a group
    with a third of all rows isn't sorted in one task. Null is a group.
    """
    rows = df.withColumn("_group", group).withColumn("_order", order).withColumn("_prefix", F.substring("_order", 1, 3))
    sizes = rows.groupBy("_group", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    by_group = Window.partitionBy("_group")  # at most 4096 rows
    before = F.coalesce(F.sum("_n").over(by_group.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col("_group").alias("_g"), F.col("_prefix").alias("_p"), before.alias("_before"), F.sum("_n").over(by_group).alias("_size"))
    rank = F.row_number().over(Window.partitionBy("_group", "_prefix").orderBy("_order"))
    ranked = rows.withColumn("_rank", rank)
    placed = ranked.join(offsets, ranked["_group"].eqNullSafe(offsets["_g"]) & (ranked["_prefix"] == offsets["_p"]))
    return placed.withColumn("_position", F.col("_before") + F.col("_rank")).drop("_g", "_p", "_prefix", "_rank", "_before")


_HELP = ("_group", "_order", "_position", "_size")


def sample_per_group(df: DataFrame, group: Column, key: Column, n: int, seed: int = 42, columns: list[str] | None = None) -> DataFrame:
    """At most n rows: the first of every group by hashed order (n // groups + 20 at most), rows with nulls dropped, capped at n."""
    groups = df.select(group.alias("g")).distinct().count()
    limit = min(n // max(groups, 1) + 20, n)
    kept = group_positions(df, group, hashed(seed, key)).where(F.col("_position") <= limit)
    kept = kept.dropna(subset=columns or df.columns)
    return kept.orderBy("_order").limit(n).drop(*_HELP)


def bin_of(prob: Column, width: str = "0.3", bins: int = 10) -> Column:
    """Number from 1 of the right-closed bin (a, b] of a value; null outside (0, width * bins]."""
    k = F.ceil(prob.cast("decimal(20,10)") / F.lit(width).cast("decimal(20,10)"))
    return F.when((prob > 0) & k.between(1, bins), k.cast("int"))


def bin_counts(df: DataFrame, prob: Column, n: int, width: str = "0.3", bins: int = 10) -> DataFrame:
    """(bin, rows, quota) of every bin, empty ones too; the quotas add up to n, the first n % bins get one more."""
    counts = df.select(bin_of(prob, width, bins).alias("bin")).where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    all_bins = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    quota = F.lit(n // bins) + (F.col("bin") <= n % bins).cast("int")
    return all_bins.join(F.broadcast(counts), "bin", "left").select("bin", F.coalesce("rows", F.lit(0)).alias("rows"), quota.cast("long").alias("quota"))


def stratified_sample(df: DataFrame, prob: Column, key: Column, n: int, seed: int = 42, redistribute: bool = False, width: str = "0.3", bins: int = 10) -> DataFrame:
    """About n rows, as many of every bin; a bin short of rows repeats them (sampling with replacement).

    The quota of empty bins is lost, or spread over the others if redistribute
    is set. Values outside the bins are dropped.
    """
    quotas = bin_counts(df, prob, n, width, bins).where("rows > 0")
    if redistribute:
        rows = quotas.sort("bin").collect()  # at most bins rows
        each, more = divmod(n, max(len(rows), 1))
        quotas = df.sparkSession.createDataFrame([(r.bin, r.rows, each + (i < more)) for i, r in enumerate(rows)], "bin int, rows long, quota long")
    binned = df.withColumn("bin", bin_of(prob, width, bins)).where(F.col("bin").isNotNull())
    placed = group_positions(binned, F.col("bin"), hashed(seed, key))
    joined = placed.join(F.broadcast(quotas.drop("rows")), "bin").where(F.col("_position") <= F.col("quota"))  # at most bins rows
    # row r of a bin of m rows stands for the draws r, r + m, r + 2m, ... up to the quota
    times = F.floor((F.col("quota") - F.col("_position")) / F.col("_size")).cast("int") + 1
    return joined.withColumn("draw", F.explode(F.sequence(F.lit(1), times))).drop(*_HELP, "quota")


def train_val_split(df: DataFrame, label: Column, key: Column, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """df with column split (train or val): per label, the first round(share * n) rows by hashed order are train."""
    placed = group_positions(df, label, hashed(seed, key))
    split = F.when(F.col("_position") <= F.round(F.col("_size") * train_share), "train").otherwise("val")
    return placed.select(*df.columns, split.alias("split"))
