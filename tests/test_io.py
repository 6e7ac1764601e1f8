import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources import readers, writers
from corpusmill.streaming.incremental import dedup_stream

ROWS = [(1, 'a "quoted"\nline, é'), (2, " spaces "), (3, None), (4, "")]
SCHEMA = "i long, t string"


@pytest.mark.parametrize("fmt, codec", [("jsonl", "gzip"), ("jsonl", "zstd"), ("parquet", "zstd")])
def test_round_trip(spark, frame, rows, tmp_path, fmt, codec):
    path = f"file://{tmp_path}/x"
    writers.write(frame(ROWS, SCHEMA), path, fmt, compression=codec)
    schema = T.StructType.fromDDL(SCHEMA)
    back = spark.read.parquet(path) if fmt == "parquet" else readers.read_jsonl(spark, path, schema)
    assert rows(back) == sorted(ROWS, key=str)


def test_csv_round_trip(spark, frame, rows, tmp_path):
    path = f"file://{tmp_path}/x"
    writers.write(frame(ROWS[:2], SCHEMA), path, "csv")
    assert rows(readers.read_csv(spark, path, SCHEMA)) == ROWS[:2]
    with pytest.raises(ValueError):
        writers.write(frame(ROWS, SCHEMA), path, "excel")


def test_bad_lines_stay_observable(spark, rows, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"i": 1, "t": "a"}\n{"i": 2,\n\n{"i": 3}\n')
    good, bad = readers.read_jsonl_tolerant(spark, f"file://{tmp_path}/x.jsonl", T.StructType.fromDDL(SCHEMA))
    assert rows(good) == [(1, "a"), (3, None)] and rows(bad) == [('{"i": 2,',)]


def test_label_lines(frame, rows):
    lines = frame([("__label__1 a b",), ("__label__0",), ("x y",), ("  ",), (None,)], "value string")
    assert rows(readers.parse_label_lines(lines)) == [("__label__0", None, False), ("__label__1", "a b", True), ("x", "y", False)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_positions_files_and_shards(frame, partitions):
    df = writers.with_position(frame([(i,) for i in range(1, 26)], "i long", partitions), "i")
    got = {r.i: (r.position, r.f, r.s) for r in df.select("i", "position", writers.file_number(F.col("position"), 10).alias("f"), writers.shard_path(F.col("position"), 1).alias("s")).collect()}
    assert all(got[i][0] == i for i in got) and [got[i][1] for i in (1, 10, 11, 25)] == [1, 1, 2, 3]
    expected = {0: "shard_01/shard_00001", 9: "shard_10/shard_00001", 10: "shard_01/shard_00002", 23: "shard_04/shard_00003"}
    assert {n: got[n + 1][2] for n in expected} == {n: f"{s}.jsonl.zst" for n, s in expected.items()}


def test_numbered_files_hold_exactly_their_rows(spark, frame, tmp_path):
    writers.write_numbered(frame([(i,) for i in range(25)], "i long", 4), f"file://{tmp_path}/n", 10, "i")
    got = spark.read.json(f"file://{tmp_path}/n").groupBy("file_no").agg(F.count("*").alias("n"), F.min("i").alias("low")).collect()
    assert {(r.file_no, r.n, r.low) for r in got} == {(1, 10, 0), (2, 10, 10), (3, 5, 20)}


def test_warc(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:1>\r\nWARC-Target-URI: http://a.b/\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(record * 2 + record[:-8]))
    got = readers.read_any(spark, f"file://{tmp_path}/x.warc.gz", T.StructType()).collect()
    assert len(got) == 2 and got[0].url == "http://a.b/" and bytes(got[0].content) == b"hello"


def test_manifest(spark, frame, rows, tmp_path):
    files = frame([("a",), ("b",)], "path string")
    manifest = f"file://{tmp_path}/done"
    assert rows(readers.unprocessed(spark, files, manifest)) == [("a",), ("b",)]
    files.where("path = 'a'").write.parquet(manifest)
    assert rows(readers.unprocessed(spark, files, manifest)) == [("b",)]


def test_incremental_stream(spark, frame, rows, tmp_path):
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    batches = ([(1, "a"), (2, "a"), (3, None)], [(4, "a"), (5, "b"), (6, None), (7, "known")])
    for n, batch in enumerate(batches):
        frame(batch, SCHEMA, 1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        dedup_stream(stream, F.col("t"), "i", out, f"file://{tmp_path}/check", frame([("known",)], "key string")).awaitTermination()
    assert rows(spark.read.schema(SCHEMA).option("basePath", f"{out}/records").parquet(f"{out}/records"), "i") == [(1,), (3,), (5,), (6,)]


@pytest.mark.parametrize("n, parts, sizes", [(10, 4, [3, 3, 2, 2]), (3, 3, [1, 1, 1]), (2, 5, [1, 1])])
def test_even_parts(frame, n, parts, sizes):
    df = frame([(i,) for i in range(1, n + 1)], "position long")
    got = df.groupBy(writers.even_part(F.col("position"), n, parts).alias("p")).count().sort("p").collect()
    assert [r["count"] for r in got] == sizes


def test_zst_writer_keeps_to_the_mode(spark, frame, rows, tmp_path):
    path, schema = f"file://{tmp_path}/z", T.StructType.fromDDL(SCHEMA)
    df = frame(ROWS, SCHEMA)
    for mode, times in (("errorifexists", 1), ("append", 2), ("ignore", 2), ("overwrite", 1)):
        writers.write(df, path, "jsonl", mode=mode, compression="zstd")
        assert rows(readers.read_jsonl(spark, path, schema)) == sorted(ROWS * times, key=str)
    with pytest.raises(FileExistsError):
        writers.write(df, path, "jsonl", compression="zstd")
    with pytest.raises(ValueError):
        writers.write(df, path, "jsonl", mode="sometimes", compression="zstd")


def test_rolling_shards_are_files(spark, frame, tmp_path):
    writers.write_shards(frame([(i, f"t{i}") for i in range(25)], SCHEMA, 4), f"file://{tmp_path}/s", 2, "i")
    files = sorted(str(p.relative_to(tmp_path / "s")) for p in (tmp_path / "s").rglob("*.zst"))
    assert len(files) == 13 and files[0] == "shard_01/shard_00001.jsonl.zst" and "shard_03/shard_00002.jsonl.zst" in files
    one = readers.read_jsonl(spark, f"file://{tmp_path}/s/shard_01/shard_00002.jsonl.zst", T.StructType.fromDDL(SCHEMA))
    assert [r.i for r in one.collect()] == [20, 21]
    writers.write_shards(frame([], SCHEMA), f"file://{tmp_path}/none", 2, "i")


def test_numbered_files_are_single(frame, tmp_path):
    writers.write_numbered(frame([(i,) for i in range(25)], "i long", 4), f"file://{tmp_path}/n", 10, "i")
    assert [len(list((tmp_path / f"n/file_no={k}").glob("*.json"))) for k in (1, 2, 3)] == [1, 1, 1]


def test_malformed_csv_rows_stay_observable(spark, rows, tmp_path):
    (tmp_path / "x.csv").write_text("i,t\n1,a\nx,b\n3,c\n")
    good, bad = readers.read_csv_tolerant(spark, f"file://{tmp_path}/x.csv", T.StructType.fromDDL(SCHEMA))
    assert rows(good) == [(1, "a"), (3, "c")] and rows(bad) == [("x,b",)] and good.count() == 2 and bad.count() == 1


def test_broken_files_are_reported(spark, rows, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"i": 1}\n\n{"i": 2}\n')
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress(b'{"i": 3}\n')[:-6])
    (tmp_path / "c.jsonl.zst").write_bytes(b"none")
    good, failed = readers.read_jsonl_by_file(spark, f"file://{tmp_path}", T.StructType.fromDDL("i long"))
    assert rows(good, "i") == [(1,), (2,)] and sorted(r.path.rsplit("/", 1)[-1] for r in failed.collect()) == ["b.jsonl.gz", "c.jsonl.zst"]


def test_csv_entry_points(spark, frame, rows, tmp_path):
    from corpusmill.plans import pipelines

    (tmp_path / "in/a/b").mkdir(parents=True)
    (tmp_path / "in/x.csv").write_text("i,t\n1,same text\n2,same text\n")
    (tmp_path / "in/a/b/y.csv").write_text("i,t\n3,other\n4,\n")
    root = f"file://{tmp_path}"
    assert rows(pipelines.merge_csv(spark, f"{root}/in", SCHEMA, f"{root}/merged")) == [(2, 4)]
    assert readers.read_csv(spark, f"{root}/merged", SCHEMA).count() == 4
    assert rows(pipelines.dedup_csv(spark, f"{root}/in", SCHEMA, f"{root}/once", ["t"])) == [(4, 1, 3)]
    assert 1 in {r.i for r in readers.read_csv(spark, f"{root}/once", SCHEMA).collect()}


def test_a_discarded_table_is_gone(spark, frame):
    from corpusmill import scratch

    one, two = (scratch.materialize(frame(ROWS, SCHEMA), "gone") for _ in range(2))
    scratch.discard(one)
    assert two.count() == 4
    with pytest.raises(Exception):  # noqa: B017
        spark.read.schema(SCHEMA).parquet(one.scratch_path).count()
