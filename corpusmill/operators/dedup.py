"""Exact deduplication. Nulls are equal to each other; "first" follows an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.filters import MAX_CHARS, MIN_CHARS


def digest(*columns: Column) -> Column:
    """A 128-bit key (struct of two longs) of the columns, so that long texts are never shuffled as keys.

    Null differs from every value; a null and a value may stand in any of the columns.
    """
    marks = [c.isNull() for c in columns]
    return F.struct(F.xxhash64(*columns, *marks).alias("d1"), F.xxhash64(F.lit("second"), *marks, *columns).alias("d2"))


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest order per key; of several with that order, all.

    A hot key needs no window over all its copies: the aggregate combines
    them map-side, and rows join back on the digest of their key and order.
    """
    keyed = df.withColumn("_digest", digest(*[F.col(k) for k in keys]))
    first = keyed.groupBy("_digest").agg(F.min(order).alias(order)).where(F.col(order).isNotNull())
    return keyed.join(first, ["_digest", order], "left_semi").select(*df.columns)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct whole rows. NaN is a missing value like null: both come out as null, and rows that differ in nothing else are one."""
    numbers = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in numbers else F.col(c) for c in df.columns]).distinct()


def dedup_metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    """(total, duplicated, remain): one row; null keys count as one value."""
    sizes = df.groupBy(digest(*[F.col(k) for k in keys])).agg(F.count(F.lit(1)).alias("n"))
    total, remain = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return sizes.agg(total.alias("total"), (total - remain).alias("duplicated"), remain.alias("remain"))


def new_records(df: DataFrame, key: Column, order: str, known: DataFrame | None = None, low: int = MIN_CHARS, high: int = MAX_CHARS) -> DataFrame:
    """df with record_key: rows strictly within the length bounds, first of their key, not among known (record_key)."""
    rows = df.where((F.length("text") > low) & (F.length("text") < high)).withColumn("record_key", key)
    rows = keep_first(rows, ["record_key"], order)
    return rows if known is None else rows.join(known.select("record_key"), "record_key", "left_anti")


def dedup_stats(df: DataFrame, key: Column, low: int = MIN_CHARS, high: int = MAX_CHARS) -> DataFrame:
    """(processed, length_errors, duplicates, unique_rows, rate): one row over all input."""
    within = F.coalesce((F.length("text") > low) & (F.length("text") < high), F.lit(False))
    keyed = df.select(within.alias("ok"), F.when(within, key).alias("k"))
    by_key = keyed.groupBy("ok", "k").agg(F.count(F.lit(1)).alias("n"))
    counted = by_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0)).alias("length_errors"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.count_if("ok").alias("unique_rows"),
    )
    rate = F.round(F.coalesce(F.try_divide("duplicates", F.col("processed") - F.col("length_errors")), F.lit(0.0)), 6)
    return counted.withColumn("rate", rate)


def union_by_name(*tables: DataFrame) -> DataFrame:
    """All rows; columns are matched by name and missing ones filled with null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def remove_overlap(df: DataFrame, other: DataFrame, left: Column, right: Column) -> DataFrame:
    """Rows of df whose left value isn't among other's right values; null counts as a value like any other."""
    keys = other.select(digest(right).alias("_digest")).distinct()
    return df.withColumn("_digest", digest(left)).join(keys, "_digest", "left_anti").drop("_digest")


def rank_in_group(group: list[str], *order: Column) -> Column:
    """Row number from 1 within the group in the given order."""
    return F.row_number().over(Window.partitionBy(*group).orderBy(*order))
