"""Registry of known keys: a Parquet table of keys by shard, exact where a filter service would only estimate.

Adding is an anti-join and an append, checking a left join; both shuffle by
key and spill, so the registry may be far larger than memory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.hashing import SHARDS, shard_of


def check(keys: DataFrame, known: DataFrame) -> DataFrame:
    """keys (key, ...) with column known: whether the key stands in known (key). A null key is unknown."""
    there = known.select("key").where(F.col("key").isNotNull()).distinct().withColumn("_there", F.lit(True))
    return keys.join(there, "key", "left").withColumn("known", F.coalesce("_there", F.lit(False))).drop("_there")


def new_keys(keys: DataFrame, known: DataFrame) -> DataFrame:
    """(key): the distinct non-null keys that aren't known yet."""
    return keys.select("key").where(F.col("key").isNotNull()).distinct().join(known.select("key"), "key", "left_anti")


def status(known: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(shard, keys): keys of each shard that has any."""
    return known.select(shard_of(F.col("key"), shards).alias("shard")).where(F.col("shard").isNotNull()).groupBy("shard").agg(F.count(F.lit(1)).alias("keys"))


class KeyRegistry:
    """A persistent registry in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, shards: int = SHARDS, folders: int = 16):
        self.spark, self.path, self.shards, self.folders = spark, path.rstrip("/"), shards, folders
        self._schema = "key string, shard long, part int"

    def keys(self) -> DataFrame:
        """(key, shard) of all keys."""
        try:
            return self.spark.read.schema(self._schema).parquet(self.path).select("key", "shard")
        except Exception as error:  # nothing added so far
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], "key string, shard long")

    def add(self, keys: DataFrame) -> None:
        """Add the keys (key) that aren't there; repeats and nulls are left out."""
        shard = shard_of(F.col("key"), self.shards)
        fresh = new_keys(keys, self.keys()).select("key", shard.alias("shard"), (shard % self.folders).cast("int").alias("part"))
        fresh.repartition("part").write.mode("append").partitionBy("part").parquet(self.path)

    def check(self, keys: DataFrame) -> DataFrame:
        return check(keys, self.keys())

    def status(self) -> DataFrame:
        return status(self.keys(), self.shards)

    def clear(self, shard: int | None = None) -> None:
        """Remove all keys, or those of one shard."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        system = path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if shard is None:
            system.delete(path(self.path), True)
            return
        part = f"{self.path}/part={shard % self.folders}"
        if not system.exists(path(part)):
            return
        # what is kept is complete before the part is taken away, and the part is there until the rest has its place
        beside, before = (f"{self.path}/_{uuid.uuid4().hex}" for _ in range(2))
        self.spark.read.schema("key string, shard long").parquet(part).where(F.col("shard") != shard).write.parquet(beside)
        system.rename(path(part), path(before))
        system.rename(path(beside), path(part))
        system.delete(path(before), True)
