"""Incremental deduplication of a stream of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.dedup import keep_first


def dedup_stream(stream: DataFrame, key: Column, order: str, path: str, checkpoint: str, known: DataFrame | None = None) -> StreamingQuery:
    """Start a query that appends the records with unseen string keys to path/records (Parquet), their keys to path/keys.

    known: (key), keys that count as seen from the beginning. Both tables have
    a folder per micro-batch, and a batch looks only at the keys of earlier
    ones, so that a batch run again after a failure writes the same rows.
    Null keys are never duplicates.
    """
    spark = stream.sparkSession

    def batch(rows: DataFrame, epoch: int) -> None:
        keyed = rows.withColumn("_key", key)
        fresh = keep_first(keyed.where(F.col("_key").isNotNull()), ["_key"], order)
        if epoch > 0:
            seen = spark.read.schema("key string, epoch long").parquet(f"{path}/keys").where(F.col("epoch") < epoch)
            fresh = fresh.join(seen.select(F.col("key").alias("_key")), "_key", "left_anti")
        if known is not None:
            fresh = fresh.join(known.select(F.col("key").alias("_key")), "_key", "left_anti")
        fresh = fresh.unionByName(keyed.where(F.col("_key").isNull())).persist()
        try:
            fresh.drop("_key").write.mode("overwrite").parquet(f"{path}/records/epoch={epoch}")
            fresh.select(F.col("_key").alias("key")).where(F.col("key").isNotNull()).write.mode("overwrite").parquet(f"{path}/keys/epoch={epoch}")
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
