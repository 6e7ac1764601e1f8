"""Intermediate tables in the folder that all executors share.

A table written here cuts lineage and survives the loss of executors, which a
local checkpoint does not. The folder is the one the cluster names in
``spark.checkpoint.dir``; only a local session without that setting gets a
temporary folder of its own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, without a trailing slash.

    Raises RuntimeError on a cluster that names none: a machine-local folder
    would be unreadable for the other machines.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and return a reader of it.

    Rows, nulls and column order stay as they are. The table is removed by
    ``clear`` or when Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(table: DataFrame) -> None:
    """Remove a table that materialize returned and nothing will read any more."""
    path = table.scratch_path
    for entry in [e for e in _WRITTEN if e[1] == path]:
        _WRITTEN.remove(entry)
        _delete(*entry)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear() -> int:
    """Remove every table that materialize wrote in this process; returns their number."""
    removed = 0
    while _WRITTEN:
        try:
            _delete(*_WRITTEN.pop())
            removed += 1
        except Exception:  # the session has ended, and its folder with it
            pass
    return removed


atexit.register(clear)
