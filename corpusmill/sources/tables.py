"""Parquet tables of a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Table ``name`` of ``directory``: one Parquet file or folder named ``<name>.parquet``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame, most: int = 16) -> DataFrame:
    """df on as many partitions as there are cores, up to most, if its scan has fewer.

    A table of one row group is one task however many cores wait; a large
    table is split by its files and row groups and comes back unchanged.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, most)
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def load_texts(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A table whose rows are costly, spread over the cores."""
    return spread(load(spark, directory, name))
