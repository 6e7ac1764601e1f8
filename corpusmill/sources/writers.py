"""Writers: formats by name, numbered files, rolling shards, rejects by stage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import labels
from corpusmill.sources import readers

#: Quotes doubled, blanks at the ends of texts kept.
_CSV = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: Rolling shards: n-th file of a job goes to one of so many folders.
FOLDERS = 10


def write(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Write df as csv, jsonl or parquet; other formats raise ValueError. zstd for JSON lines goes through write_jsonl_zst."""
    if fmt not in ("csv", "jsonl", "parquet"):
        raise ValueError(f"unknown format {fmt!r}")
    if fmt == "jsonl" and compression == "zstd":
        return write_jsonl_zst(df, path, mode)
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        writer.csv(path, header=True, **_CSV)
    elif fmt == "jsonl":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        writer.parquet(path)
    return None


def _hadoop(spark: SparkSession, path: str):
    """(file system, path object) of a path as the session's Hadoop settings see it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _prepared(spark: SparkSession, path: str, mode: str) -> str | None:
    """The path with its file system, after mode has been applied as Spark's writers do; None if nothing is to be written."""
    if mode not in ("errorifexists", "error", "overwrite", "append", "ignore"):
        raise ValueError(f"unknown mode {mode!r}")
    system, target = _hadoop(spark, path)
    if mode != "append" and system.exists(target):
        if mode == "ignore":
            return None
        if mode != "overwrite":
            raise FileExistsError(path)
        system.delete(target, True)
    system.mkdirs(target)
    uri = system.makeQualified(target).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file:///") else uri


def _zst_files(base: str, run: str):
    """An Arrow function of (name, value) rows sorted by name: each name's lines as one .jsonl.zst file below base.

    Files are written beside their place and renamed when complete, so a task
    that is run again replaces its own files and every row is there once. The
    file system is that of base, which pyarrow must know; a machine's own disk
    is never taken for it.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import contextlib

        import zstandard
        from pyarrow import fs
        from pyspark import TaskContext

        system, root = fs.FileSystem.from_uri(base)
        task = TaskContext.get()
        part = f"part-{task.partitionId():05d}-{run}"
        now, rows, stack = None, 0, contextlib.ExitStack()

        def close() -> None:
            stack.close()
            if now is not None:
                system.move(f"{now}.{task.taskAttemptId()}.tmp", now)

        for batch in batches:
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = f"{root}/{name or part}.jsonl.zst"
                if place != now:
                    close()
                    now = place
                    system.create_dir(now.rsplit("/", 1)[0], recursive=True)
                    file = stack.enter_context(system.open_output_stream(f"{now}.{task.taskAttemptId()}.tmp", compression=None))
                    out = stack.enter_context(zstandard.ZstdCompressor().stream_writer(file, closefd=False))
                out.write(line.encode() + b"\n")
            rows += batch.num_rows
        close()
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], names=["rows"])

    return save


def _save_zst(lines: DataFrame, path: str, mode: str) -> None:
    spark = lines.sparkSession
    base = _prepared(spark, path, mode)
    if base is not None:
        lines.mapInArrow(_zst_files(base, uuid.uuid4().hex[:8]), "rows long").agg(F.sum("rows")).collect()
        system, done = _hadoop(spark, f"{base}/_SUCCESS")
        system.create(done, True).close()


def _as_line(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")


def write_jsonl_zst(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines in .jsonl.zst files, one per partition, which Spark's own writer doesn't offer.

    mode as in Spark's writers. path is written through its own file system.
    """
    _save_zst(df.select(F.lit(None).cast("string").alias("name"), _as_line(df.columns)), path, mode)


def write_shards(df: DataFrame, path: str, rows: int, *order: str, mode: str = "errorifexists") -> None:
    """df in rolling shards of rows rows in the given total order: files shard_NN/shard_NNNNN.jsonl.zst below path.

    Each shard is one file, written by one task.
    """
    placed = with_position(df, *order)
    number = F.floor((F.col("position") - 1) / rows).cast("int")
    last = placed.agg(F.max("position")).first()[0] or 0
    shards = placed.repartitionById(max(-(-last // rows), 1), number).sortWithinPartitions("position")
    _save_zst(shards.select(shard_path(F.col("position"), rows, "").alias("name"), _as_line(df.columns)), path, mode)


def _position(df: DataFrame, *order: Column) -> DataFrame:
    """df with its exact position from 1 in the given order, without sorting in one task.

    Rows are range-partitioned and sorted; the offset of each partition is the
    sum of the sizes before it, so only partition sizes meet in one place.
    """
    from corpusmill.scratch import materialize

    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    # the sampled range bounds must not change between the two reads below
    placed = materialize(placed, "positions")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # one row per partition
    offsets = sizes.select("_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").withColumn("position", F.col("_before") + F.col("_id") - F.col("_first") + 1).drop("_part", "_id", "_first", "_before")


def with_position(df: DataFrame, *order: str | Column) -> DataFrame:
    """df with column position: 1 for the first row in the given order, which must be total."""
    return _position(df, *[F.col(o) if isinstance(o, str) else o for o in order])


def file_number(position: Column, rows: int) -> Column:
    """Number from 1 of the file of rows rows each that holds the row."""
    return (F.floor((position - 1) / rows) + 1).cast("long")


def even_part(position: Column, rows: int, parts: int) -> Column:
    """Number from 1 of the part that holds the row; sizes differ by at most one, the first parts are larger."""
    small, larger = divmod(rows, parts)
    edge = larger * (small + 1)
    inside = F.floor((position - 1) / (small + 1)) + 1
    return F.when(position <= edge, inside).otherwise(F.floor((position - 1 - edge) / max(small, 1)) + 1 + larger).cast("int")


def shard_path(position: Column, rows: int, suffix: str = "jsonl.zst") -> Column:
    """Path of the rolling shard that holds the row: file n is shard_{n % 10 + 1}/shard_{n // 10 + 1}."""
    n = F.floor((position - 1) / rows).cast("int")
    return F.format_string("shard_%02d/shard_%05d" + (f".{suffix}" if suffix else ""), n % FOLDERS + 1, F.floor(n / FOLDERS).cast("int") + 1)


def write_numbered(df: DataFrame, path: str, rows: int, *order: str, fmt: str = "jsonl") -> None:
    """df in folders file_no=N of one file with rows rows each, in the given total order."""
    numbered = with_position(df, *order).withColumn("file_no", file_number(F.col("position"), rows))
    files = numbered.agg(F.max("file_no")).first()[0] or 1
    # a file's rows meet in one task, which writes them as one file
    numbered = numbered.repartitionById(files, (F.col("file_no") - 1).cast("int")).sortWithinPartitions("position").drop("position")
    writer = numbered.write.partitionBy("file_no")
    writer.json(path) if fmt == "jsonl" else writer.csv(path, header=True, **_CSV) if fmt == "csv" else writer.parquet(path)


def write_rejects(df: DataFrame, path: str, *columns: str) -> None:
    """JSON lines (gzip) in one folder per value of the columns, such as folder and reject_stage or language."""
    df.write.partitionBy(*columns).option("compression", "gzip").json(path)


def write_by_label(df: DataFrame, path: str, positive: Column) -> None:
    """df as two JSON line outputs: path/positive and path/negative; a null condition counts as negative."""
    named = df.withColumn("_side", F.when(positive, "positive").otherwise("negative")).persist()
    try:
        for side in ("positive", "negative"):
            named.where(F.col("_side") == side).drop("_side").write.option("compression", "gzip").json(f"{path}/{side}")
    finally:
        named.unpersist()


def write_label_lines(df: DataFrame, path: str) -> None:
    """Text file of label lines from (label, text)."""
    df.select(labels.label_line(F.col("label"), F.col("text")).alias("value")).write.text(path)


def convert(spark: SparkSession, source: str, schema: str, target: str, fmt: str, compression: str | None = None) -> None:
    """Read a table by the format its path tells and write it in another format or compression."""
    write(readers.read_any(spark, source, T.StructType.fromDDL(schema)), target, fmt, compression=compression)
